import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tradeloom.operators.layout import plan_text
from tradeloom.sources import paths
from tradeloom.sources.versioned import VersionedTable, merge_frames


def frame(spark, data):
    return spark.createDataFrame(list(data), "k int, v string")


def put(table, data, **more):
    return table.upsert(frame(table.spark, data), ["v"], ["k"], **more)


@pytest.fixture
def table(spark, folder):
    t = VersionedTable(spark, f"{folder}/t", ["k"])
    put(t, [(1, "a"), (2, "b")])
    put(t, [(2, "B"), (3, "c")])
    return t


def history(table):
    return [tuple(r) for r in table.history().drop("committed_at").orderBy("version").collect()]


def test_upsert_and_read(table, rows):
    assert rows(table.read()) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(table.read_as_of(0)) == [(1, "a"), (2, "b")]
    assert history(table) == [(0, "upsert", 2, 0, 0), (1, "upsert", 1, 1, 0)]


def test_replay_changes_nothing(table, rows):
    assert put(table, [(2, "B"), (3, "c")], version=1) == 1
    assert rows(table.read()) == [(1, "a"), (2, "B"), (3, "c")]
    assert history(table) == [(0, "upsert", 2, 0, 0), (1, "upsert", 1, 1, 0)]


def test_an_upsert_equals_union_of_updates_and_the_rest(spark, rows):
    target, updates = frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(2, "B"), (3, "c")])
    assert rows(merge_frames(target, updates, ["k"])) == [(1, "a"), (2, "B"), (3, "c")]


def test_duplicates_in_a_batch_become_one_row(table, rows):
    put(table, [(9, "z"), (9, "y")])
    assert rows(table.read().filter("k = 9")) == [(9, "y")]


def test_uncommitted_version_is_not_read(table, rows):
    frame(table.spark, [(7, "x")]).withColumn("_deleted", F.lit(False)).write.parquet(f"{table.path}/changes/version=2")
    assert table.latest() == 1 and rows(table.read()) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(ValueError):
        table.read_as_of(2)


def test_missing_table_and_bad_version(spark, folder, table):
    with pytest.raises(ValueError):
        VersionedTable(spark, f"{folder}/none", ["k"]).read()
    with pytest.raises(ValueError):
        table.read_as_of(-1)


def test_rollback_is_a_new_version(table, rows):
    assert table.rollback(0) == 2
    assert rows(table.read()) == [(1, "a"), (2, "b")]
    assert rows(table.read_as_of(1)) == [(1, "a"), (2, "B"), (3, "c")]
    assert history(table)[-1] == (2, "rollback to 0", 0, 1, 1)
    put(table, [(3, "new")])
    assert history(table)[-1] == (3, "upsert", 1, 0, 0)


def test_compact_keeps_later_reads_and_removes_older_files(table, rows):
    put(table, [(1, "A")])
    table.rollback(0)
    put(table, [(5, "e")])
    before = [rows(table.read_as_of(v)) for v in (2, 3, 4)]
    table.compact(2)
    assert [rows(table.read_as_of(v)) for v in (2, 3, 4)] == before
    with pytest.raises(ValueError):
        table.read_as_of(1)
    left = {kind: sorted(f.rsplit("=", 1)[1] for f in paths.subfolders(table.spark, f"{table.path}/{kind}"))
            for kind in ("changes", "commits", "bases")}
    assert left == {"changes": ["3", "4"], "commits": ["2", "3", "4"], "bases": ["2"]}
    assert [h[0] for h in history(table)] == [2, 3, 4]
    table.compact(4)
    assert rows(table.read()) == before[-1]
    put(table, [(6, "f")])
    assert rows(table.read()) == sorted(before[-1] + [(6, "f")])


def test_as_of_reads_only_the_folders_it_needs(table):
    plan = plan_text(table.read_as_of(1))
    assert any("PartitionFilters" in line and "version" in line and "<= 1" in line for line in plan.splitlines())


def test_another_writer_is_refused(spark, folder):
    table = VersionedTable(spark, f"{folder}/s", ["k"])
    put(table, [(1, "a")], version=0, writer="q1")
    put(table, [(2, "b")], version=1, writer="q1")
    with pytest.raises(ValueError):
        put(table, [(3, "c")], version=0, writer="q2")


def test_other_columns_are_refused_not_lost(table, rows):
    more = frame(table.spark, [(4, "d")]).withColumn("w", F.lit(1))
    with pytest.raises(ValueError, match="w"):
        table.upsert(more, ["v"], ["k"])
    table.upsert(frame(table.spark, [(4, "d")]).select("v", "k"), ["v"], ["k"])
    assert table.read().columns == ["k", "v"] and (4, "d") in rows(table.read())


def test_a_stream_goes_on_after_a_rollback(spark, folder, rows):
    table = VersionedTable(spark, f"{folder}/s", ["k"])
    assert put(table, [(1, "a")], version=0, writer="q") == 0
    assert put(table, [(1, "b")], version=1, writer="q") == 1
    assert table.rollback(0) == 2
    assert put(table, [(2, "c")], version=2, writer="q") == 3
    assert put(table, [(2, "c")], version=2, writer="q") == 3  # the replay of a batch
    assert rows(table.read()) == [(1, "a"), (2, "c")]


steps = st.lists(st.one_of(
    st.tuples(st.just("upsert"), st.dictionaries(st.integers(0, 5), st.sampled_from("abc"), min_size=1, max_size=4)),
    st.tuples(st.just("rollback"), st.integers(0, 3)), st.tuples(st.just("compact"), st.integers(0, 3))), min_size=1, max_size=5)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(steps)
def test_any_history_equals_a_dictionary(spark, rows, tmp_path_factory, steps):
    table = VersionedTable(spark, str(tmp_path_factory.mktemp("v")), ["k"])
    put(table, [(0, "z")])
    states, oldest = [{0: "z"}], 0
    for kind, value in steps:
        if kind == "upsert":
            put(table, list(value.items()))
            states.append({**states[-1], **value})
            continue
        version = oldest + value % (len(states) - oldest)
        if kind == "rollback":
            table.rollback(version)
            states.append(states[version])
        else:
            table.compact(version)
            oldest = version
    assert table.latest() == len(states) - 1
    for version in range(oldest, len(states)):
        assert rows(table.read_as_of(version)) == sorted(states[version].items())
    kept = {h[0]: h[2:] for h in history(table)}
    assert sorted(kept) == list(range(oldest, len(states)))
    for version in range(oldest + 1, len(states)):
        before, after = states[version - 1], states[version]
        assert kept[version][0] == len(after.keys() - before.keys())
        assert kept[version][2] == len(before.keys() - after.keys())
