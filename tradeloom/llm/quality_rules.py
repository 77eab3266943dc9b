"""Quality rules as a short-circuit cascade of column expressions.

Every document gets its base counts. The rules that follow are independent verdicts on the text; their cost and
selectivity are estimated on a sample, and they are tried in the order of rejections per cost until one rejects.
The order changes what is computed, never who is kept. ``few_different_words`` sets the different words against at most 1,000
words, as long texts repeat theirs: no text with 100 different words or more is rejected by it, whatever its length.

Null text counts as empty. Rows are judged one by one: repeated rows and ties get equal verdicts, a null doc_id is carried,
an empty table gives no rows, and columns other than the two named ones are never read. A text of any length is one value
of one row; nothing is grouped or shuffled.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.llm.shared import WORD_BREAKS, bounded_sample, text_of, words_of

# What counts as a symbol, the window of a repetition and the limits of the base verdict.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEWEST_WORDS = 10
MOST_REPEATED_PERCENT = 20

SAMPLE_ROWS = 2_000  # the order of the rules is estimated on so many documents
TIMED_ROWS = 10_000  # judged by each rule to take its time
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """``rejects`` sees the columns ``text`` and ``words`` and the base counts."""

    name: str
    rejects: Callable[[], Column]


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def _adjacent_repeats() -> Column:
    words = F.col("words")
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: a == b)
    return F.size(F.filter(pairs, lambda same: same))


def _capital_pairs() -> Column:
    return F.regexp_count("text", F.lit(r"\p{Lu}{2}"))


RULES = [
    Rule("symbols", lambda: _share(F.col("n_symbols"), F.col("n_words")) > 0.25),
    Rule("exclamations", lambda: _share(F.regexp_count("text", F.lit("!")), F.col("n_words")) > 0.3),
    Rule("capitals", lambda: _share(2 * _capital_pairs(), F.col("word_chars")) > 0.5),
    Rule("few_different_words", lambda: (F.col("n_words") >= 50)
         & (_share(F.size(F.array_distinct("words")), F.least(F.col("n_words"), F.lit(1000))) < 0.1)),
    Rule("doubled_words", lambda: _share(_adjacent_repeats(), F.col("n_words")) > 0.3),
    Rule("repeated_lines", lambda: _share(F.col("n_dup_lines"), F.size(F.split("text", "\n"))) > 0.5),
    Rule("long_words", lambda: _share(F.col("word_chars"), F.col("n_words")) > 20),
]


def _windows() -> Column:
    """A 64-bit hash of every window of 5 words, in order: of pairs, of pairs of pairs, and of those with a fifth word."""
    hashes = F.col("word_hashes")
    after = lambda values, steps: F.slice(values, steps + 1, F.greatest(F.size("word_hashes"), F.lit(1)))
    both = lambda a, b: F.xxhash64(a, b)
    pairs = F.zip_with(hashes, after(hashes, 1), both)
    fives = F.zip_with(F.zip_with(pairs, after(pairs, 2), both), after(hashes, 4), both)
    return F.slice(fives, 1, F.greatest(F.size("word_hashes") - (WINDOW - 1), F.lit(0)))


def _repeated_places() -> Column:
    """Starts of windows that occur more than once, in order; sorts only texts in which any window recurs."""
    ordered = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    return F.when(F.size(F.array_distinct("windows")) < F.size("windows"), ordered)


def base_counts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, text, words and the base counts of every document."""
    with_windows = (docs.select(F.col(key), text_of(text).alias("text"))
                    .withColumn("words", words_of(F.col("text")))
                    .withColumn("word_hashes", F.transform("words", lambda word: F.xxhash64(word)))
                    .withColumn("windows", _windows())
                    .withColumn("marks", _repeated_places()))

    def recurs(mark: Column, i: Column) -> Column:
        before, after = F.get(F.col("marks"), i - 1)["h"], F.get(F.col("marks"), i + 1)["h"]
        return F.coalesce(mark["h"] == before, F.lit(False)) | F.coalesce(mark["h"] == after, F.lit(False))

    places = F.array_sort(F.transform(F.filter("marks", recurs), lambda mark: mark["at"]))
    covered = F.aggregate(
        "places", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, at: F.struct((acc["n"] + at + WINDOW - F.greatest(at, acc["end"])).alias("n"), (at + WINDOW).alias("end")),
        lambda acc: acc["n"])
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(WORD_BREAKS)) != "")
    return (with_windows.withColumn("places", places).withColumn("lines", lines).select(
        F.col(key), F.col("text"), F.col("words"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")))


def base_failed() -> Column:
    return (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def estimate(docs: DataFrame, rules: list[Rule], text: str, key: str, sample_rows: int) -> list[tuple[Rule, float, float]]:
    """Each rule with the share it rejects of a sample and the seconds it takes over it, base counts excluded."""
    counted = base_counts(bounded_sample(docs.select(key, text), sample_rows, key), text, key).cache()
    # a job's own time varies by more than a rule takes on a few rows, so each row is judged several times
    often = F.explode(F.sequence(F.lit(1), F.lit(max(TIMED_ROWS // max(counted.count(), 1), 1))))

    def seconds(measure: Column) -> tuple[float, tuple]:
        start = time.perf_counter()
        row = counted.withColumn("_time", often).agg(F.count(F.lit(1)), measure).first()
        return time.perf_counter() - start, row

    plain = F.sum(F.length("text") + F.size("words"))  # reads what the rules read
    seconds(plain)
    rounds = [[seconds(plain), *[seconds(F.count_if(rule.rejects())) for rule in rules]] for _ in range(2)]
    (floor, _), *took = map(min, zip(*rounds))
    counted.unpersist()
    return [(rule, rejected / max(rows, 1), max(s - floor, 1e-3)) for rule, (s, (rows, rejected)) in zip(rules, took)]


def ordered_rules(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text", key: str = "doc_id",
                  sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per cost, best first."""
    found = estimate(docs, rules, text, key, sample_rows)
    return [rule for rule, share, cost in sorted(found, key=lambda x: (-x[1] / x[2], x[2]))]


def judge(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, base counts, ``base_failed`` and ``kept`` of every document.

    A document that fails the base verdict is rejected before any rule; otherwise the first rule that rejects ends the
    cascade, since ``or`` stops at the first true operand.
    """
    cascade = base_failed()
    for rule in rules if rules is not None else ordered_rules(docs, text=text, key=key):
        cascade = cascade | rule.rejects()
    return base_counts(docs, text, key).select(
        F.col(key), *BASE, base_failed().alias("base_failed"), (~cascade).alias("kept"))
