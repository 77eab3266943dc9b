"""The training-text operators on rows that are null, empty, long, tied, repeated or dressed with clashing columns,
and against brute force."""

import array
import functools
import hashlib
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tests.llm import brute  # noqa: E402
from tradeloom.llm import (chat_format, decontamination, main_text, near_dup, personal_data, quality_model,  # noqa: E402
                           quality_rules, queries, shared, substring_dedup, tree_bpe, web_archive)

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
# columns whose names the operators use inside
CLASH = {"words": "x", "h": 1, "key": 2, "nid": 3, "digest": "y", "tokens": "z", "n": 4, "start": 5, "fp": "q", "raw": "r",
         "_row": "s", "_file": "t", "_place": "u", "first": "v", "lowest": "w"}


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 99)) * (r.random() < 0.3) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    long = prose(1, 30_000)
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, prose(2, 60)), (6, prose(2, 60)), (7, prose(3, 40)), (7, prose(3, 40)),
            (None, prose(4, 30)), (8, long), (9, "x" * 20_000), (10, "é😀 ñ" * 30)]


def frame(spark, rows, schema="doc_id long, text string"):
    df = spark.createDataFrame(rows, schema)
    for name, value in CLASH.items():
        df = df.withColumn(name, F.lit(value))
    return df


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return frame(spark, odd_rows)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")


def in_order(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_quality_rules_equal_brute_force(odd, odd_rows):
    got = in_order(quality_rules.judge(odd).select("doc_id", *quality_rules.BASE, "base_failed"))
    assert got == sorted(((k, *brute.base_counts(t)) for k, t in odd_rows), key=str)


def test_order_of_rules_changes_nobody(odd):
    rules = quality_rules.RULES
    assert in_order(quality_rules.judge(odd, rules)) == in_order(quality_rules.judge(odd, rules[::-1])) == in_order(quality_rules.judge(odd))


def test_rules_are_ordered_by_rejections_per_cost(spark):
    shouting = spark.createDataFrame([(i, "STOP!! " * 20 + prose(i, 30)) for i in range(50)], "doc_id long, text string")
    assert quality_rules.ordered_rules(shouting)[0].name in ("exclamations", "capitals")


def test_rules_on_an_empty_table(none):
    assert quality_rules.judge(none).count() == 0


def pages(spark, rows):
    return frame(spark, rows, "page_id long, url string, html string")


def test_archive_round_trip(spark):
    rows = [(1, "u1", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u3", None), (4, "u4", ""), (5, "u5", "x" * 600_000), (6, "u\n6", "one"),
            (6, "u\n6", "one"), (None, "u7", "two")]
    archives = web_archive.bundles(pages(spark, rows)).cache()
    got = {(r.page_id, r.url): r for r in web_archive.read_records(archives).collect()}
    assert got[1, "u1"].record_type == "revisit" and got[1, "u1"].refers_to == 2 and got[2, None].record_type == "response"
    assert got[3, "u3"].refers_to == 4 and got[3, "u3"].payload_bytes == 0
    assert got[6, "u%0A6"].record_type == "response" and got[None, "u7"].record_type == "response"
    assert all(r.digest_ok for r in got.values()) and got[5, "u5"].payload_bytes == 600_000
    assert got[1, "u1"].payload_digest == web_archive.base32_sha1("<p>é</p>".encode())
    found = web_archive.look_up(archives, spark.createDataFrame([("<urn:page:5>",)], "id string")).collect()
    assert [r.page_id for r in found] == [5]
    assert web_archive.bundles(pages(spark, [])).count() == 0


def test_small_payloads_are_responses(spark):
    df = pages(spark, [(1, "a", "same"), (2, "b", "same"), (3, "c", "longer text"), (4, "d", "longer text")])
    got = {r.page_id: r.record_type for r in web_archive.read_records(web_archive.bundles(df, min_bytes=5)).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_frames_are_independent():
    bundle = web_archive._Bundle()
    for i in range(5):
        bundle.add(f"r{i}", bytes([65 + i]) * 200_000)
    row = bundle.row().iloc[0]
    places = web_archive.frame_places(row["data"])
    assert len(places) == 3
    entry = row["records"][4]
    raw = web_archive.read_frame(row["data"], places[entry["frame"]])
    assert raw[entry["offset"]:entry["offset"] + entry["length"]] == b"E" * 200_000


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_main_text(spark, sf):
    own = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").select("page_id", "url", "html")
    got = {r.page_id: r for r in main_text.extract(own).collect()}
    for r in own.collect():
        assert got[r.page_id].text == brute.article(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_main_text_in_containers_of_any_name(spark):
    """Names that say nothing about their blocks, on a page with a menu and a footer."""
    model = main_text.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    blocks = ["The committee met on Tuesday to discuss the plans for the old harbour.", "It was raining.", "Prices rose by 3 percent last year.",
              "Nobody knew when the ferry would come back, said the harbour master."]
    names = ["story-wrap", "c-12", "zq", "wrapper", "lead-in", "xkcd"]
    page = "<div class='menu'><a href=x>Home</a></div><div class='{}'>{}</div><div class='footer'>Copyright</div>"
    rows = [(i, "u", page.format(name, "".join(f"<p>{b}</p>" for b in blocks))) for i, name in enumerate(names)]
    assert {r.text for r in main_text.extract(pages(spark, rows), model).collect()} == {" ".join(blocks)}


def test_blocks_are_read_to_their_end():
    start = "word " * 60
    assert len({main_text.vector((["p"], start + word, 0.0)).tobytes() for word in WORDS}) > 8  # of 16 slots


def test_long_training_pages_are_learnt_to_their_end(spark, monkeypatch):
    learnt = []
    monkeypatch.setattr(main_text.Labeller, "train", lambda self, x, y: learnt.extend(y))
    monkeypatch.setattr(main_text, "LAYOUTS", 0)
    body = "<article>" + "".join(f"<p>Block {i} of it.</p>" for i in range(900)) + "</article><footer>end</footer>"
    main_text.fit(pages(spark, [(1, "u", body)]))
    assert sum(len(y) for y in learnt) == 901 and sum(y.sum() for y in learnt) == 900 and max(map(len, learnt)) == main_text.STRETCH


def test_samples_are_bounded_by_rows_not_keys(spark):
    """A key with a third of all rows, equal and different ones."""
    rows = [(7, "same")] * 3_000 + [(7, f"text {i}") for i in range(3_000)] + [(i, f"text {i}") for i in range(8, 6_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for by in (["doc_id"], ["doc_id", "text"]):
        picked, again = (sorted(map(tuple, shared.bounded_sample(rows, 500, *by).select(*by).collect())) for rows in (df, df.repartition(3)))
        assert 200 <= len(picked) <= 500 and picked == again  # the key with most rows is drawn as a whole or not at all
    assert shared.bounded_sample(df, 20_000, "doc_id").count() == len(rows)
    same = spark.createDataFrame([(7, "same")] * 5_000, "doc_id long, text string")
    assert shared.bounded_sample(same, 100, "doc_id").count() <= 100


def test_quality_model_learns_a_bounded_number_of_rows(spark, monkeypatch):
    """One id holds most documents and most labels, its rows don't multiply."""
    key = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 5)
    docs = spark.createDataFrame([(key, prose(i, 20 + i % 30)) for i in range(600)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(key, 1)] * 400 + [(key, 0)] * 200 + [(None, 1), (key, None)], "doc_id long, quality int")
    learnt, learn = [], quality_model.learn
    monkeypatch.setattr(quality_model, "learn", lambda x, y: learnt.append((x.tolist(), y.tolist())) or learn(x, y))
    quality_model.fit(docs, labels, rows=100)
    quality_model.fit(docs.repartition(5), labels.repartition(3), rows=100)
    assert len(learnt[0][1]) == 100 and set(learnt[0][1]) == {0.0, 1.0} and learnt[0] == learnt[1]
    row = quality_model.classify(docs.where("doc_id is null"), labels).first()
    assert row.held_out is None and 0 <= row.score <= 1


def test_main_text_of_odd_pages(spark):
    own = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    model = main_text.fit(own)
    page = ("<div class=menu>Home</div><article><p>First <b>bold</b>\n part.<p>Second &amp; last.<script>x='</p>'</script>"
            "<div class='ad'>Buy</div></article><div class='comments'><p>Great text!</p></div><footer>end")
    rows = [(1, None, None), (2, "u", ""), (3, "u", page), (3, "u", page), (None, "u", "<"), (4, "u", "<article><p>" + "long text. " * 20_000)]
    got = main_text.extract(pages(spark, rows), model).collect()
    texts = Counter((r.page_id, r.text[:40], r.n_chars) for r in got)
    assert texts[1, "", 0] == 1 and texts[2, "", 0] == 1 and texts[3, "First bold part. Second & last.", 31] == 2
    assert texts[4, ("long text. " * 4)[:40], 219_999] == 1 and len(got) == 6
    assert main_text.extract(pages(spark, []), model).count() == 0 and main_text.extract(pages(spark, [])).count() == 0


def test_personal_data_equals_brute_force(spark, odd, none):
    r = random.Random(7)
    pieces = ["a.b@c.de", "@x.y", "a@b", "1.2.3.4", "256.1.1.1", "+1 (017) 555-7713", "4845168114407329", "4845 1681-14407329", " ", " ", ",",
              "%e@f.g", "0000.1.2.3", "token = " + "ab12" * 10, "GB82 WEST 1234 5698 7654 32", "5", ".", "+", "card ", "é", "x" * 5]
    texts = ["".join(r.choice(pieces) for _ in range(30)) for _ in range(300)]
    df = frame(spark, list(enumerate(texts)))
    got = {row.doc_id: row for row in personal_data.digest(df).collect()}
    for i, text in enumerate(texts):
        base = brute.base_spans(text)
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(sum(s[0] == k for s in base) for k in personal_data.BASE_KINDS)
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(got[i].spans.split(",")) or not base
    assert personal_data.digest(odd).count() == 12 and personal_data.digest(none).count() == 0


def test_context_and_checksums_decide():
    key = "0123456789abcdef0123456789abcdef"
    assert [s[0] for s in personal_data.find_spans(f"token = {key}")] == ["secret"] and not personal_data.find_spans(f"see {key}")
    assert [s[0] for s in personal_data.find_spans("GB82 WEST 1234 5698 7654 32")] == ["iban"]
    assert not personal_data.find_spans("GB83 WEST 1234 5698 7654 32")
    assert personal_data.redacted("to a@b.cd now", personal_data.find_spans("to a@b.cd now")) == "to [EMAIL] now"


def test_linear_on_long_runs():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+" * 200_000, "1 " * 100_000, "a@" * 100_000):
        personal_data.find_spans(text)


QUESTION = "If a train of Anna travels 60 km in 45 minutes, how far does the train go in 3 hours at that same speed in total"


def test_decontamination(spark, odd, none):
    bench = frame(spark, [(1, QUESTION), (2, None), (3, prose(50, 40)), (4, "")], "item_id long, text string")
    other = QUESTION.replace("60", "80").replace("45", "30").replace("Anna", "Berta")
    docs = frame(spark, [(1, prose(5, 50) + " " + QUESTION + " " + prose(6, 50)), (2, "Said before. " + other), (3, prose(7, 300)),
                         (4, QUESTION.split("how")[0]), (5, None), (6, prose(8, 9) + " " + prose(50, 40)), (6, prose(50, 40)), (None, prose(50, 40))])
    got = {(r.doc_id, r.item_id): r for r in decontamination.matches(docs, bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (6, 3), (None, 3)}
    assert got[1, 1].same_values and not got[2, 1].same_values
    kept = decontamination.without_leaks(docs, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5] and kept.columns == docs.columns
    assert decontamination.matches(none, bench).count() == 0 and decontamination.matches(odd, none.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_inconsistent_slots_are_no_match(spark):
    item = "compute 5 plus 5 plus 5 and then add 5 more to what you had before today"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item.replace("5", "9")), (2, item.replace("5", "9", 2))], "doc_id long, text string")
    assert [r.doc_id for r in decontamination.matches(docs, bench).collect()] == [1]


def test_shuffled_and_broadcast_searches_agree(spark, monkeypatch):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = in_order(decontamination.matches(docs, bench))
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert expected and in_order(decontamination.matches(docs, bench)) == expected


def test_windows_in_short_runs_are_found_at_any_offset(spark):
    words = [f"w{chr(97 + i)}" for i in range(21)]
    changed = " ".join(words[:10] + ["other"] + words[11:])  # six of six needed windows, in two runs
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = spark.createDataFrame([(k, " ".join(["x"] * k + [changed] + ["y"] * 9)) for k in range(8)], "doc_id long, text string")
    assert sorted((r.doc_id, r.matched_windows) for r in decontamination.matches(docs, bench).collect()) == [(k, 6) for k in range(8)]


def test_items_of_numbers_and_short_items_are_found(spark):
    numbers = " ".join(str(i * i) for i in range(30))
    bench = spark.createDataFrame([(1, numbers), (2, "Which river is longest"), (3, "What is 12 times 14")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"so {numbers} end"), (2, numbers.replace("4", "5")), (3, prose(5, 20) + " which river is longest? " + prose(6, 20)),
                                  (4, "say what is 17 times 3 of it"), (5, "what is the longest river")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.same_values for r in decontamination.matches(docs, bench).collect()}
    assert got == {(1, 1): True, (3, 2): True, (4, 3): False}


def test_word_for_word_passages_need_no_slots(spark):
    words = [f"w{chr(97 + i)}{chr(97 + i // 2)}" for i in range(26)]
    item = "take 5 and 5 " + " ".join(words) + " so 5 is Anna of Rome, Berta of Oslo"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item.upper()), (2, item.replace("5", "9", 1)), (3, item.replace("5", "9")),
                                  (4, "take 9 and 5 " + " ".join(words[:8]))], "doc_id long, text string")
    got = {r.doc_id: r.same_values for r in decontamination.matches(docs, bench).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_substring_removals_equal_brute_force(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = in_order(substring_dedup.removals(docs).select("doc_id", "start", "end", "first_doc_id", "first_start"))
    rows = sorted((tuple(r) for r in docs.collect()), key=lambda r: r[0])
    assert got and got == sorted((r[1:] for r in brute.removals(rows)), key=str)
    assert in_order(substring_dedup.removals(docs, stored=True).select("doc_id", "start", "end", "first_doc_id", "first_start")) == got
    assert {r.doc_id for r in substring_dedup.removals(odd).collect()} == {6, 7} and substring_dedup.removals(none).count() == 0


@pytest.mark.parametrize("sf, least", [("/root/testdata/sf0.01", 0.98)])
def test_repeats_of_fifty_words_do_not_stay(spark, sf, least):
    rows = sorted((tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()), key=lambda r: r[0])
    gone = {}
    for r in substring_dedup.removals(spark.read.parquet(f"{sf}/documents.parquet"), stored=True).collect():
        gone.setdefault(r.doc_id, []).append((r.start, r.end))
    runs = brute.repeated_runs(rows)
    hit = 0
    for number, first, last in runs:
        key, text = rows[number]
        places = [m.span() for m in brute.WORD.finditer(text)][first:last + 1]
        hit += any(a < end and start < b for a, b in gone.get(key, []) for start, end in places)
    assert len(runs) > 100 and hit >= least * len(runs)


def test_unique_text_stays_and_one_of_equal_rows(spark):
    shared = "This sentence is shared by many documents and has more than ten words."
    rows = [(7, f"Some other opening words stand right here. {shared}"), (7, f"{shared} And this one is unique to the second row.")]
    got = sorted(r.text for r in substring_dedup.deduplicate(frame(spark, rows)).collect())
    assert got == [" And this one is unique to the second row.", rows[0][1]]
    equal = [(5, prose(61, 40))] * 2 + [(None, prose(61, 40))] * 3
    assert [r.text for r in substring_dedup.deduplicate(frame(spark, equal)).collect() if r.text] == [prose(61, 40)]
    inside = prose(62, 60)
    long = frame(spark, [(1, f"{prose(63, 9)} {inside} {prose(64, 9)}"), (2, f"{prose(65, 12)} {inside} {prose(66, 5)}")])
    left = {r.doc_id: len(r.text.split()) for r in substring_dedup.deduplicate(long).collect()}
    assert left[1] == 78 and left[2] < 17 + 25


def test_substring_removal_in_the_middle_of_a_line(spark):
    passage = "This passage of some words is pasted into many documents."
    df = spark.createDataFrame([(1, f"Own start here now. {passage} End."), (2, passage), (3, f"Else. {passage} Rest.")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in substring_dedup.deduplicate(df).collect()}
    assert passage in got[1] and got[2] == "" and got[3] == "Else.  Rest."


def test_quality_model_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality_model.classify(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got.values())
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(p == q for p, q in held) >= 0.97 * len(held)


def test_quality_model_of_odd_rows(odd, none, labels):
    got = quality_model.classify(odd, labels).collect()
    assert len(got) == 12 and all(r.score is not None for r in got)
    assert {r.score for r in quality_model.classify(odd, labels.where("quality is null")).collect()} == {0.5}
    assert quality_model.classify(none, labels).count() == 0


def test_near_duplicates_equal_brute_force(spark, odd, odd_rows, none):
    r, rows = random.Random(3), []
    for group in range(30):  # chains of copies with a few words changed each time
        words = prose(100 + group, r.choice([20, 80, 150])).split()
        for _ in range(r.randint(1, 12)):
            rows.append((len(rows), " ".join(words).upper() if r.random() < 0.2 else " ".join(words)))
            for _ in range(r.randint(0, 2)):
                words[r.randrange(len(words))] = r.choice(WORDS)
    got = {row.doc_id: (row.n_shingles, row.component_id) for row in near_dup.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute.near_components(rows)
    found = in_order(near_dup.near_duplicates(odd).select("doc_id", "component_id", "kept"))
    assert found == sorted([(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True), (6, 5, False), (7, 7, True), (7, 7, True),
                            (None, None, True), (8, 8, True), (9, 9, True), (10, 10, True)], key=str)
    assert near_dup.near_duplicates(none).count() == 0


def test_large_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "ALL_PAIRS", 3)
    r, base = random.Random(9), prose(900, 100).split()
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(r.randint(0, 3)):
            words[r.randrange(len(words))] = r.choice(WORDS) + "x"
        rows.append((i, " ".join(words)))
    got = {row.doc_id: (row.n_shingles, row.component_id) for row in near_dup.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute.near_components(rows)


def test_all_blocks_of_a_large_bucket_meet(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "ALL_PAIRS", 2)
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    r, base, rows = random.Random(11), prose(901, 200).split(), []
    for group in range(100):  # pairs at 0.86; groups lie at 0.77, so they share buckets and no link
        words = list(base)
        words[r.randrange(10, 90)] = f"group{group}"
        for i in range(2):
            for at in (110, 140, 170):
                words[at] = f"own{group}x{i}"
            rows.append((len(rows), " ".join(words)))
    got = {row.doc_id: (row.n_shingles, row.component_id) for row in near_dup.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute.near_components(rows)


def test_rows_are_dropped_by_row_not_by_doc_id(spark):
    copy = prose(51, 60)
    docs = frame(spark, [(1, copy), (7, copy), (7, prose(52, 60)), (None, copy), (8, prose(53, 60))])
    expected = [(1, copy), (7, prose(52, 60)), (8, prose(53, 60))]
    kept = near_dup.without_near_duplicates(docs)
    assert in_order(kept.select("doc_id", "text")) == sorted(expected, key=str) and kept.columns == docs.columns
    assert {r["_row"] for r in kept.collect()} == {"s"}
    words = prose(54, 30).split()
    bench = frame(spark, [(1, " ".join(words)), (None, copy)], "item_id long, text string")
    # halves of an item at the same place of two documents are no leak, in whichever way their ids agree
    rows = [(key, text) for key in (None, 5) for text in (" ".join(words[:11] + ["x"] * 19), " ".join(["y"] * 19 + words[19:]))]
    docs = frame(spark, [*rows, (None, copy), (None, prose(55, 60)), (5, " ".join(words)), (6, prose(56, 60))])
    kept = decontamination.without_leaks(docs, bench)
    assert in_order(kept.select("doc_id", "text")) == sorted([*rows, (None, prose(55, 60)), (6, prose(56, 60))], key=str)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.item_id) for r in decontamination.matches(docs, bench).collect()} == {(None, None), (5, 1)}


def test_one_of_equal_rows_stays_whatever_their_ids(spark):
    copy = prose(57, 40)
    docs = frame(spark, [(7, copy), (7, copy), (7, copy), (None, copy), (None, copy)])
    assert [r.doc_id for r in near_dup.without_near_duplicates(docs).collect()] == [7]
    assert in_order(near_dup.near_duplicates(docs).select("doc_id", "component_id", "kept")) == [
        (7, 7, True)] * 3 + [(None, 7, False)] * 2
    nameless = frame(spark, [(None, copy), (None, copy), (None, "")])
    assert sorted(near_dup.near_duplicates(nameless).select("component_id", "kept").collect()) == [(None, False), (None, True), (None, True)]
    named = spark.createDataFrame([("b", copy), ("a", copy), ("c", prose(58, 40))], "doc_id string, text string")
    assert in_order(near_dup.near_duplicates(named).select("doc_id", "component_id", "kept")) == [
        ("a", "a", True), ("b", "a", False), ("c", "c", True)]


def test_stored_tables_are_numbered_without_a_copy(spark, tmp_path):
    copy = prose(59, 60)
    rows = [(1, copy), (7, copy), (7, prose(60, 60)), (None, copy), (8, None)]
    frame(spark, rows).repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    by_place, number = shared.numbered(docs, stored=True)
    assert by_place.columns == [*docs.columns, number] and number not in docs.columns
    assert by_place.select(number).distinct().count() == 5
    expected = in_order(near_dup.without_near_duplicates(docs))
    assert in_order(near_dup.without_near_duplicates(docs, stored=True)) == expected and len(expected) == 3
    bench = frame(spark, [(1, copy)], "item_id long, text string")
    clean = decontamination.without_leaks(docs, bench, stored=True)
    assert in_order(clean) == in_order(decontamination.without_leaks(docs, bench)) and clean.columns == docs.columns
    # what is no table of files is written, even if it is called one
    assert in_order(near_dup.without_near_duplicates(frame(spark, rows), stored=True).select("doc_id")) == in_order(
        spark.createDataFrame([(1,), (7,), (8,)], "doc_id long"))


def test_many_numbers_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(shared, "BROADCAST_NUMBERS", 0)
    df, number = shared.numbered(frame(spark, [(i, "") for i in range(9)]))
    some = df.where("doc_id % 3 = 0").select(number)
    assert shared.only_rows(df, number, some).count() == 3 and shared.without_rows(df, number, some).count() == 6


def test_registers_estimate_similarity():
    import numpy as np

    r = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.9):
        common, a, b = (r.integers(0, 2**63, n, dtype=np.uint64) for n in (int(2000 * share), int(1000 * (1 - share)), int(1000 * (1 - share))))
        x, y = near_dup.registers(np.concatenate([common, a])), near_dup.registers(np.concatenate([common, b]))
        assert (np.maximum(x, y) == near_dup.registers(np.concatenate([common, a, b]))).all()
        n_a, n_b = np.array([len(common) + len(a)]), np.array([len(common) + len(b)])
        true = len(common) / (len(common) + len(a) + len(b))
        got = near_dup.estimated(np.array([(x == y).sum()]), np.array([(x > y).sum()]), np.array([(x < y).sum()]), n_a, n_b)[0]
        assert abs(got - true) < 0.12


@functools.cache
def library_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def library(text):
    tokenizer = library_tokenizer()
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(array.array("I", ids).tobytes()).hexdigest(),
            hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_tree_bpe_equals_the_library(spark, odd, odd_rows, none):
    got = in_order(tree_bpe.digest(odd, queries.tokenizer_path(), piece_chars=1000))
    assert got == sorted(((k, *library(t)) for k, t in odd_rows), key=str)
    assert tree_bpe.digest(none, queries.tokenizer_path()).count() == 0


def test_joined_pieces_of_unsplit_text():
    r, path = random.Random(2), queries.tokenizer_path()
    alphabet = "abcdefgh'é ñßÉΣ1290.,!😀́  \x1c"
    for k in range(150):
        text = "".join(r.choice(alphabet[:9] if k % 2 else alphabet) for _ in range(r.randint(0, 800)))
        text = text[:200] + "<|endoftext|>" + text[200:] if k % 7 == 0 else text
        expected = library(text)
        assert tree_bpe.summary(path, tree_bpe.encode_texts(path, [text])[0]) == expected
        pieces = [tree_bpe.encode_piece(path, s, t) for s, t in tree_bpe.halves(text, r.choice([30, 100]))]
        assert tree_bpe.summary(path, array.array("I", tree_bpe.join_all(path, pieces)).tobytes()) == expected


def test_halves_of_text_with_breaks():
    r, path = random.Random(7), queries.tokenizer_path()
    words = ["the", "Straße", "don't", "e\u0301", "\u0301", "12,5", "\t", "\x0b", "<|endoftext|>", "a<|endoftext|>b", "😀😀", "", "x" * 90, "ß" * 300]
    texts = [r.choice([" ", "\n", "  "]).join(r.choice(words[:r.randint(2, len(words))]) for _ in range(r.randint(0, 200))) for _ in range(150)]
    texts += ["", " " * 5000, "\n" * 3000, "ab" * 4000, "word " * 1000 + "ab" * 3000 + " word" * 1000, " " + "y" * 2500]
    expected = [library(text) for text in texts]
    for most in (40, 300, tree_bpe.LEAF_CHARS):
        assert [tree_bpe.summary(path, ids) for ids in tree_bpe.encode_halves(path, texts, most)] == expected
    assert all(len(word) <= tree_bpe.WORD_CHARS for word in tree_bpe.tokenizer_of(path)[1][0])


def test_windows_grow_until_both_sides_agree(monkeypatch):
    path, text, reaches = queries.tokenizer_path(), "Some words " + " " * 3000 + "and some more words " * 200, []
    window = tree_bpe._window
    monkeypatch.setattr(tree_bpe, "_window", lambda left, right, reach: reaches.append(reach) or window(left, right, reach))
    assert tree_bpe.summary(path, tree_bpe.encode_halves(path, [text], 1500)[0]) == library(text)
    assert max(reaches) > tree_bpe.WINDOW_CHARS
    # ids that don't agree with the window are never taken over
    left, right = "one two three four five six seven " * 20, "eight nine ten eleven twelve " * 20
    (wrong,), (fine,) = tree_bpe.encode_texts(path, [left.replace("seven", "zebra")]), tree_bpe.encode_texts(path, [right])
    ((both, ids),) = tree_bpe.join_texts(path, [((left, wrong), (right, fine))])
    assert both == left + right and tree_bpe.summary(path, ids) == library(both)


def test_chat_round_trip(spark):
    r, bits = random.Random(4), ["### ", "</turn>", "\\", "#", "<", "/turn>", "\n", " ", ": ", "user", "ok", "## ", "é😀"]
    rows = [(c, t, r.choice(["user", "assistant", "a: b", "### x", None]), None if r.random() < 0.1 else "".join(r.choice(bits) for _ in range(r.randint(0, 25))))
            for c in range(300) for t in range(r.randint(1, 5))] + [(None, None, "user", "x"), (-1, 0, "user", "twice"), (-1, 0, "user", "twice")]
    df = frame(spark, rows, "conv_id long, turn long, role string, text string")
    back = {row.conv_id: row for row in chat_format.read_back(chat_format.format_chats(df)).collect()}
    assert all(row.round_trip for row in back.values()) and len(back[-1].turns) == 2
    for c in range(300):
        source = sorted(((t, role or "", text or "") for k, t, role, text in rows if k == c))
        assert [(t.role, t.text) for t in back[c].turns] == [s[1:] for s in source]
        assert back[c].loss_text == "".join(text for _, role, text in source if role == "assistant")
        marks = len(re.findall("### ", back[c].formatted)), back[c].formatted.count("</turn>")
        assert marks == (len(source), len(source))
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("h", F.lit(1))
    columns = docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    good, single, clean, private = docs, None, None, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, after = good, stage(spark, good, SF).cache()
        assert after.columns == columns
        old, new = {r.doc_id: r.text for r in before.collect()}, {r.doc_id: r.text for r in after.collect()}
        assert set(new) <= set(old)
        if name == "near duplicates":
            expected = brute.near_components(list(old.items()))
            assert set(new) == {k for k, (_, c) in expected.items() if c == k}
        if name == "personal data":
            assert set(new) == set(old) and not any(brute.base_spans(t) for t in new.values())
        good = after
    texts = {r.doc_id: r.text for r in good.collect()}
    got = {r[0]: tuple(r)[1:] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {k: library(t) for k, t in texts.items()}


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_pipeline_stages_on_odd_rows(spark, odd, none, stage):
    out = stage[1](spark, odd.drop("h"), SF)
    assert out.columns == odd.drop("h").columns and out.count() <= 12
    assert stage[1](spark, none, SF).count() == 0


def test_plain_words_are_encoded_in_one_call_without_special_tokens():
    path, seen, r = queries.tokenizer_path(), [], random.Random(5)
    tokenizer, _, _, sizes = tree_bpe.tokenizer_of(path)

    class Watched:
        def __getattr__(self, name):
            return getattr(tokenizer, name)

        def encode_batch_fast(self, texts, **more):
            seen.extend(texts)
            return tokenizer.encode_batch_fast(texts, **more)

    plain = list({"".join(r.choices("abzAZ019.,!'$&~éÀÿßÆ×", k=r.randint(1, 12))) for _ in range(900)}) + ["x's", "a" * 300, "--", "jekyll"]
    odd = ["<|endoftext|>", "a<b", "\u0130x", "e\u0301", "x\u00a0y", "\u4e2d\u6587", "a\tb", "\u1e9e", "\U0001f600", "\u00aa\u00b5", "\x00a"]
    known = {}
    tree_bpe._learn_words(Watched(), sizes, known, plain + odd)
    assert {w: list(array.array("I", known[w])) for w in plain + odd} == {
        w: tokenizer.encode(w, add_special_tokens=False).ids for w in plain + odd}
    assert not [text for text in seen if "<|" in text and any(word in text.split(" ") for word in plain)]
    # a call whose words don't end where their bytes do is left to the other way
    assert tree_bpe._learn_plain(tokenizer, [2] * len(sizes), {}, ["one", "two"]) == ["one", "two"]
