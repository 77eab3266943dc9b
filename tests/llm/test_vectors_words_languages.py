"""Hard negatives, spelling variants and languages against brute force, and on odd rows."""

import math
import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tradeloom.llm import hard_negatives, language_id, queries, spelling_variants

SF = "/root/testdata/sf0.001"


def vectors(n, seed=0, dims=6):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        centre = r.randrange(4)
        rows.append((i, [r.gauss(3.0 if d == centre else 0.0, 0.7) for d in range(dims)], r.randrange(3)))
    copies = [(n + i, [2.0] * dims, i % 2) for i in range(n // 3)]  # one vector holds a quarter of all rows
    return rows + copies


def mined(spark, rows, every=10):
    df = spark.createDataFrame(rows, "vec_id long, vec array<double>, label int").withColumns({"row": F.lit(1), "cell": F.lit("x"), "score": F.lit(2)})
    usable = hard_negatives.usable(df, "vec_id", "vec", "label")
    return sorted(tuple(r) for r in hard_negatives.mine(usable, F.col("id") % every == 0).collect())


def test_hard_negatives_equal_brute_force(spark):
    rows = vectors(300)
    assert mined(spark, rows) == brute.hard_negatives(rows, every=10)


def test_small_cells_and_steps_change_nothing(spark, monkeypatch):
    rows = vectors(200, seed=3)
    expected = brute.hard_negatives(rows, every=7)
    monkeypatch.setattr(hard_negatives, "CELL", 20)
    monkeypatch.setattr(hard_negatives, "CLUSTER_ANCHORS", 4)
    assert mined(spark, rows, every=7) == expected


def test_a_walk_ends_early(monkeypatch):
    # one direction holds the good candidates, all others point away
    far = [(i, i, 1, [-100, i % 7, 0]) for i in range(1_000)]
    near = [(1_000 + i, 1_000 + i, 1, [100, i, 0]) for i in range(20)]
    cell = hard_negatives._Cell(pd.DataFrame(far + near, columns=["row", "id", "label", "vector"]))
    cell.ordered(np.array([1.0, 0.0, 0.0]), 0.01)
    assert set(cell.order[:20]) == set(range(1_000, 1_020)) and (np.diff(cell.bound) <= 0).all()
    member = pd.DataFrame({"row": [5_000], "id": [5_000], "label": [1], "vector": [[100, 0, 0]], "low": [[hard_negatives.LEAST]],
                           "high": [[hard_negatives.MOST]], "floor": [[hard_negatives.LEAST]]})
    looked, real = [], hard_negatives.scores
    monkeypatch.setattr(hard_negatives, "scores", lambda a, b: looked.append(len(b)) or real(a, b))
    monkeypatch.setattr(hard_negatives, "STEP", 20)
    found = cell.walk(member, 5, True)
    assert list(found.found_id) == [1_000, 1_001, 1_002, 1_003, 1_004] and sum(looked) == 20


def test_small_steps_give_the_same_walk(monkeypatch):
    r = random.Random(8)
    rows = pd.DataFrame([(i, r.randrange(90), r.randrange(3), [r.randint(-50, 50) for _ in range(3)]) for i in range(400)],
                        columns=["row", "id", "label", "vector"])
    cell = hard_negatives._Cell(rows)
    cell.ordered(np.array([0.0, 0.0, 1.0]), 1.2)
    members = rows[hard_negatives._angles(cell.units, np.array([[0.0, 0.0, 1.0]]))[:, 0] <= 1.2].iloc[:40]  # those of the cluster
    members = members.assign(low=[[-300, 200]] * 40, high=[[900, 2_000]] * 40, floor=[[-300, 200]] * 40)
    whole = cell.walk(members, 4, False)
    monkeypatch.setattr(hard_negatives, "STEP", 7)
    assert sorted(map(tuple, cell.walk(members, 4, False).values)) == sorted(map(tuple, whole.values)) and len(whole)


def test_hard_negatives_of_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5], 2), (3, None, 1), (4, [1.0, None], 1), (5, [math.nan, 1.0], 1),
            (6, [math.inf, 1.0], 2), (7, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (8, [], 2), (9, [0.0, 0.0], 2), (10, [0.6, 0.0, 3.0], 2)]
    # a shorter vector is filled up with zeros; rows that repeat an id are other rows
    assert mined(spark, rows, every=100) == [(0, 1, 1, 10, 65_536, 39_168), (0, 1, 1, 10, 65_536, 39_168),
                                             (0, 1, 2, 2, 65_536, 32_768), (0, 1, 2, 2, 65_536, 32_768)]
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == [] and mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(0, [1e300], 1), (1, [1e300], 1), (2, [1e30], 2)]) is not None


def in_duckdb(query, *tables):
    db = duckdb.connect()
    for t in tables:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return db.execute(queries.ORACLES[query]).fetchall()


def test_hard_negatives_equal_their_sql(spark):
    got = sorted(tuple(r) for r in queries.QUERIES["op11_hard_negatives"](spark, SF).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == sorted(in_duckdb("op11_hard_negatives", "embeddings")) and got


def grouped(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("x"), "n": F.lit(1), "part": F.lit(2), "longer": F.lit(3)})
    return {r.word: tuple(r)[1:] for r in spelling_variants.grouped(df, **options).collect()}


def misspelt(seed, n_words=60, n_docs=40):
    """Documents of words and variants of them that are one edit away, chains and common beginnings among them."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcé") for _ in range(r.randint(5, 9))) for _ in range(n_words)]
    bag = []
    for w in words:
        times = r.choice([1, 3, 9, 60, 400])
        bag += [w] * times
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(w))
            bag += [r.choice([w[:at] + w[at + 1:], w[:at] + r.choice("abcé") + w[at:], w[:at] + "Z" + w[at + 1:]])] * r.choice([1, 2, 6])
        if times == 400:
            bag += [w + "q"] * 60 + [w + "qq"] * 7
    r.shuffle(bag)
    return [(i, " ".join(bag[i::n_docs]) + ("\n§" + bag[i].upper())) for i in range(n_docs)]


def test_spelling_variants_equal_brute_force(spark):
    rows = misspelt(1)
    got = grouped(spark, rows)
    assert got == brute.spelling_variants(rows)
    assert any(form and form != root for form, root, *_ in got.values())


def test_blocks_of_any_size_meet(spark, monkeypatch):
    rows = misspelt(3, n_words=120)
    monkeypatch.setattr(spelling_variants, "BLOCK", 2)
    assert grouped(spark, rows) == brute.spelling_variants(rows)


def test_single_edits(spark):
    pairs = [("abcdef", "abcdeg", 1), ("abcdef", "abcdefg", 1), ("abcdef", "bcdefg", 0), ("aaaaaa", "aaaaaaa", 1), ("abcdef", "zbcdef", 1),
             ("abcdef", "abzdef", 1), ("abcdef", "abzcdef", 1), ("abcdef", "abczzdef", 0), ("éééééé", "éééeéé", 1), ("abcdef", "badcef", 0),
             ("abababa", "bababab", 0), ("abcdefghi", "abcdefgh", 1), ("abcdefghi", "bcdefghi", 1)]
    for a, b, near in pairs:
        assert brute.one_edit(a, b) == bool(near)
        words = pd.DataFrame([(side, m, part, 0, 0, 0, w, 1) for w in (a, b) for m in (len(w), len(w) + 1)
                              for side, part in (("prefix", w[:m // 2]), ("suffix", w[-(m // 2):]))],
                             columns=["side", "longer", "part", "low", "high", "block", "word", "n"])
        cell = ["side", "longer", "part", "low", "high"]
        found = list(spelling_variants.near_places(words.sort_values(cell), cell))
        assert sum(len(i) for i, _ in found) == near, (a, b)


def test_spelling_variants_of_odd_rows(spark):
    long = "x" * 20_000
    rows = [(1, None), (2, ""), (None, "harbour " * 3), (3, "harbour harbour harbours"), (3, "harbour harbour harbours"), (4, long), (4, long)]
    got = grouped(spark, rows, min_times=2)
    assert got == brute.spelling_variants(rows, min_times=2) and any(len(w) > 19_000 for w in got)
    assert grouped(spark, []) == {}


def test_spelling_variants_equal_their_sql(spark):
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted(str(tuple(r)) for r in queries.QUERIES["op12_spelling_variants"](spark, SF).select(*columns).collect())
    assert got == sorted(map(str, in_duckdb("op12_spelling_variants", "documents"))) and got


def test_gradients_are_those_of_the_loss():
    network = language_id.Network(3, states=4, seed=1)
    drawn = np.random.default_rng(2)
    data, langs = drawn.integers(97, 101, (5, 7)).astype(np.uint8), drawn.integers(3, size=5)
    _, grads = network.loss(data, langs)
    for name, weight in network.weights.items():
        for _ in range(12):
            at = tuple(int(drawn.integers(s)) for s in weight.shape)
            if name == "x":
                at = (at[0], int(drawn.integers(97, 101)), at[2])
            kept, step = weight[at], 1e-5
            weight[at] = kept + step
            above = network.loss(data, langs)[0]
            weight[at] = kept - step
            below = network.loss(data, langs)[0]
            weight[at] = kept
            assert abs((above - below) / (2 * step) - grads[name][at]) < 1e-7


def test_the_reader_is_the_network():
    network = language_id.Network(3, seed=4)
    data = np.random.default_rng(1).integers(0, 256, (9, language_id.STRETCH)).astype(np.uint8)
    length = language_id.STRETCH
    network.weights["v"] *= 3
    whole = np.full(9, length)
    sums = network.reader().sums(data, whole)
    # the mean probability of a language, read from the gradient of the labels' offsets
    for k in range(3):
        _, grads = network.loss(data, np.full(9, k))
        expected = grads["c"] + np.eye(3)[k]
        assert np.allclose(sums.sum(0) / (9 * length), expected, atol=1e-4)
    part = network.reader().sums(data[:1], np.array([10]))
    assert np.isclose(part.sum(), 10, rtol=1e-4)


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op13_language_id"](spark, sf).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(got) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    right = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert sum(right) / len(right) >= 0.97 and all(0 <= r.score <= 1 for r in got)


def test_languages_of_odd_rows(spark):
    rows = [(i, ("the rain on the window " if i % 2 else "der regen an dem fenster ") * 8, "en" if i % 2 else "de") for i in range(60)]
    odd = [(70, None, "en"), (71, "", None), (72, " 12 §$ ", "de"), (None, "the rain on the window", "fr"), (1, rows[1][1], "en"),
           (73, "the rain on the window " * 5_000, None), (74, "Ж", "en")]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumns({"held_out": F.lit("x"), "score": F.lit(1), "p": F.lit(2)})
    got = language_id.identify(df, model=language_id.fit(df, steps=60)).collect()
    found = {r.doc_id: r for r in got}
    assert len(got) == len(rows) + len(odd) and {found[k].lang_pred for k in (70, 71, 72)} == {"und"} and found[70].score == 0
    assert found[73].lang_pred == "en" and found[None].held_out and found[None].lang_pred == "en" and found[74].lang_pred in ("de", "en")
    assert {r.lang_pred for r in got if r.doc_id == 1} == {"en"}
    assert language_id.identify(df.limit(0)).count() == 0
    unlabelled = language_id.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}
