"""What lies on disk while raw files are landed, cleaned and split."""

import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from registry import landing
from tradeloom.operators import joins, layout, quality
from tradeloom.plans import silver
from tradeloom.session import SHUFFLES_GO, build_session
from tradeloom.sources.files import CORRUPT

LINES = "product_id string, product_name string, category string, sub_category string, brand string, list_price string, _ingested_at timestamp, " \
        f"_source_file string, {CORRUPT} string"


def lines(spark):
    """400 products in two copies each, 50 lines without a key, and 50 broken lines that name a product."""
    row = lambda key, name, broken=None: (key, name, "c", "s", "b", "1.50", None, "f", broken)
    return spark.createDataFrame([row(str(i), f"copy {n}") for i in range(400) for n in range(2)] + [row(None, f"none {i}") for i in range(50)]
                                 + [row(str(i), None, f"{i},short") for i in range(50)], LINES)


def shuffle_files(folder):
    return list(Path(folder).rglob("shuffle_*.data"))


def clean_in_parts(folder):
    """Parts in a session with a disk of its own; no part finds the shuffle files of the one before."""
    spark = build_session("parts", "local[2]", 2, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.local.dir": f"{folder}/local"})
    lines(spark).write.parquet(f"{folder}/raw")
    silver.PART_BYTES = 1

    def cleaned():
        for n, part in enumerate(silver.by_key(spark.read.parquet(f"{folder}/raw"), ["product_id"])):
            for _ in range(100):
                if not shuffle_files(f"{folder}/local"):
                    break
                time.sleep(0.1)
            assert not shuffle_files(f"{folder}/local")
            yield silver.products(part)
        assert n == silver.PARTS - 1

    quality.land_split(cleaned(), f"{folder}/sides")
    assert spark.conf.get(SHUFFLES_GO) == "false"
    spark.stop()


def test_a_part_leaves_no_shuffle_files(spark, folder, rows):
    root = Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", f"import sys; sys.path[:0] = [{str(root)!r}, {str(root / 'tests')!r}]\n"
                    f"import test_landing_disk; test_landing_disk.clean_in_parts({folder!r})"], check=True, timeout=300)
    good, bad = quality.read_split(spark, f"{folder}/sides")
    whole = silver.products(lines(spark))
    assert rows(good, "product_id", "product_name") == rows(quality.accepted(whole), "product_id", "product_name")
    assert good.count() == 400
    broken = F.array_join(quality.REASONS, ",")
    assert rows(bad, "product_id", CORRUPT, broken) == rows(quality.rejected(whole), "product_id", CORRUPT, broken)
    assert bad.count() == 100


def test_parts_hold_their_keys_whole(spark, rows, monkeypatch):
    raw = lines(spark)
    monkeypatch.setattr(silver, "PART_BYTES", 1)
    parts = list(silver.by_key(raw, ["product_id"]))
    assert len(parts) == silver.PARTS
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    columns = ("product_id", "product_name", CORRUPT)
    assert rows(every, *columns) == rows(raw, *columns)
    held = [{r[0] for r in part.where(f"product_id IS NOT NULL AND {CORRUPT} IS NULL").select("product_id").collect()} for part in parts]
    assert sum(map(len, held)) == 400 and min(map(len, held)) > 50
    assert min(part.where("product_id IS NULL").count() for part in parts) > 3  # lines without a key are dealt out as well


def test_small_tables_are_cleaned_whole(spark, folder):
    lines(spark).write.parquet(f"{folder}/raw")
    raw = spark.read.parquet(f"{folder}/raw")
    assert [part is raw for part in silver.by_key(raw, ["product_id"])] == [True]


def test_raw_files_go_when_they_have_landed(spark):
    tables = landing._raw_files(spark, "/root/testdata/sf0.001")
    for name in landing.SCHEMAS:
        assert not Path(tables.path("raw", name)).exists()
        assert tables.arrived(name, landing.BATCH).count() > 0


def facts_and_users(spark, folder, users):
    spark.createDataFrame([("1", 10), ("2", 20), ("2", 21), ("8", 30), ("9", 31), (None, 40)], "user_id string, amount int").write.parquet(f"{folder}/facts")
    return spark.read.parquet(f"{folder}/facts"), spark.createDataFrame([(u, "x") for u in users], "user_id string, name string")


@pytest.mark.parametrize("users,unknown", [(["1", "2", "3", "3", None], ["8", "9", None]), (["1", "2", "8", "9"], [None]), (["7"], ["1", "2", "2", "8", "9", None])])
@pytest.mark.parametrize("fits", [(True,), (False, True), (False, False)])
def test_a_large_dimension_gives_way_to_the_keys_it_lacks(spark, folder, rows, monkeypatch, fits, users, unknown):
    facts, known = facts_and_users(spark, folder, users)
    answers = iter(fits)
    monkeypatch.setattr(quality, "broadcastable", lambda table: next(answers))
    dimension = quality.narrowed(known, facts, "user_id")
    assert (dimension is known) == (fits != (False, True))
    tagged = quality.tag_unknown(facts.where("amount < 100"), dimension, "user_id")
    assert rows(tagged, "user_id", "amount") == rows(facts)
    assert rows(quality.rejected(tagged), "user_id") == [(u,) for u in unknown]
    assert tagged.columns == ["user_id", "amount", quality.REASONS]


def test_facts_are_not_shuffled_to_look_up_many_keys(spark, folder, monkeypatch):
    facts, known = facts_and_users(spark, folder, ["1", "2"])
    monkeypatch.setattr(joins.broadcastable, "__defaults__", (20,))  # bytes: the two users do not fit, nor do two lacking keys
    monkeypatch.setattr(joins.lookup_join, "__defaults__", ("inner", 20))
    assert quality.narrowed(known, facts, "user_id") is known
    most = spark.createDataFrame([(u, "x") for u in "1289"], "user_id string, name string")
    lacked = quality.narrowed(most, facts, "user_id")
    plan = layout.plan_text(quality.tag_unknown(facts, lacked, "user_id"), "simple")
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert "hashpartitioning" in layout.plan_text(quality.tag_unknown(facts, most, "user_id"), "simple")
