"""Substring deduplication by hashed lines, sentences and pieces of long sentences.

A text is cut into lines, lines into sentences, and a sentence of more than ``LONG`` words into pieces, after words whose hash is
the least among the ``REACH`` words on either side of it. So cuts depend on the words alone: a passage that two long sentences share is
cut alike in both but for its edges, wherever it begins and ends. A piece is normalised (A-Z in lower case, its words in order), its 128-bit
digest is counted over all rows, and the occurrence in the smallest (doc_id, row, start) stays.

Other occurrences are removed where they say enough: pieces that follow each other without a gap are one run, and a run goes if it
has ``RUN_WORDS`` words; a line of ``LINE_WORDS`` or a sentence of ``SENTENCE_WORDS`` goes by itself as well. Shorter repeats, such as common turns of
phrase, are left alone. Removed spans keep their offsets (code points, end exclusive) in the original text.

Every row gets a number first and is judged by itself: of equal rows one stays, whatever their ids. Null and empty texts have no
pieces. Rows without doc_id rank after all others. An empty table gives no rows. Only the two named columns are read. Counts
are combined before the shuffle; the join that finds the other occurrences of a frequent piece is split by Spark. Shuffled rows hold
digests and offsets, never text. The runs of a text are found in one task, as the text is one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tradeloom.llm.shared import ROW, numbered
from tradeloom.session import written

REACH = 6  # words on either side of a cut
LONG = 20  # words; longer sentences are cut
LINE_WORDS, SENTENCE_WORDS, RUN_WORDS = 5, 10, 16
PIECE_SCHEMA = f"{ROW} bigint, id string, place int, high bigint, low bigint, start int, `end` int, n_words int, alone boolean"

_SEED = np.random.default_rng(606)
_FACTORS = _SEED.integers(1, 2**63, size=6, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LAST = np.uint64(2**64 - 1)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _FACTORS[0]
    x = (x ^ (x >> np.uint64(29))) * _FACTORS[1]
    return x ^ (x >> np.uint64(32))


def pieces_of(text: str) -> pd.DataFrame:
    """``place`` in the text, digest (``high``, ``low``), ``start``, ``end``, ``n_words`` and ``alone`` (the piece may go by itself) of the pieces."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return pd.DataFrame({c: [] for c in ("place", "high", "low", "start", "end", "n_words", "alone")})
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = ~((points == 32) | ((points >= 9) & (points <= 13)))
    change = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    hashes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    line = np.concatenate([[0], np.cumsum(points == 10)])[starts]
    opens = np.concatenate([[True], line[1:] != line[:-1]])  # a line
    first = opens | np.concatenate([[False], np.isin(points[ends[:-1] - 1], (33, 46, 63))])  # of a sentence
    sentence = np.cumsum(first)

    # every sentence lies apart from the next, so that no cut looks beyond it
    at = np.arange(len(words)) + sentence * REACH
    apart = np.full(at[-1] + REACH + 1, _LAST, np.uint64)
    order = np.minimum(_scrambled(hashes ^ _FACTORS[2]), _LAST - np.uint64(1))
    apart[at] = order
    least = (np.bincount(sentence) > LONG)[sentence]
    for k in range(1, REACH + 1):
        least &= (order < apart[at - k]) & (order <= apart[at + k])  # one word said over and over is not cut
    begins = np.flatnonzero(first | np.concatenate([[False], least[:-1]]))

    n_words = np.diff(np.concatenate([begins, [len(words)]]))
    step = (np.arange(len(words)) - np.repeat(begins, n_words)).astype(np.uint64)
    high, low = (np.add.reduceat(_scrambled(hashes * _FACTORS[k] + step * _FACTORS[k + 1]), begins) for k in (3, 4))
    last = begins + n_words - 1
    whole = lambda edge: edge[begins] & np.concatenate([edge[begins][1:], [True]])
    alone = (whole(opens) & (n_words >= LINE_WORDS)) | (whole(first) & (n_words >= SENTENCE_WORDS))
    return pd.DataFrame({"place": np.arange(len(begins), dtype=np.int32), "high": high.view(np.int64), "low": low.view(np.int64),
                         "start": starts[begins].astype(np.int32), "end": ends[last].astype(np.int32), "n_words": n_words.astype(np.int32), "alone": alone})


def pieces(rows: DataFrame, text: str, key: str) -> DataFrame:
    """The pieces of all numbered rows with the row's ``id``, written once."""
    key_type = rows.schema[key].dataType

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at:at + 200]
                found = [pieces_of(value or "") for value in part["text"]]
                whole = pd.concat(found, ignore_index=True)
                sizes = [len(f) for f in found]
                yield whole.assign(**{ROW: np.repeat(part[ROW].values, sizes), "id": np.repeat(part["id"].values, sizes)})

    # the id as text and back: a column of numbers with nulls would reach pandas as floating point
    found = rows.select(ROW, F.col(key).cast("string").alias("id"), F.col(text).alias("text")).mapInPandas(cut, PIECE_SCHEMA)
    return written(found.withColumn("id", F.col("id").cast(key_type)), "pieces")


def judged(rows: DataFrame, text: str, key: str) -> DataFrame:
    """One row per removed run: number, ``start``, ``end``, ``n_words``, number and start of the occurrence of its first piece that stays."""
    found = pieces(rows, text, key)
    # ids rank rows; the numbers settle what ids leave open
    rank = F.struct(F.col("id").isNull().alias("unknown"), "id", F.col(ROW).alias("row"), F.col("start").alias("s"))
    firsts = (found.groupBy("high", "low").agg(F.count(F.lit(1)).alias("times"), F.min(rank).alias("first")).where("times > 1")
              .select("high", "low", F.col("first.row").alias("first_row"), F.col("first.s").alias("first_start")))
    firsts = written(firsts, "firsts")  # read anew, so that the join below has both sides shuffled for it and can split a frequent piece
    copies = found.drop("id").join(firsts, ["high", "low"]).where((F.col(ROW) != F.col("first_row")) | (F.col("start") != F.col("first_start")))
    in_text = Window.partitionBy(ROW).orderBy("place")
    runs = (copies.withColumn("run", F.col("place") - F.row_number().over(in_text)).groupBy(ROW, "run")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_words").alias("n_words"),
                 F.array_sort(F.collect_list(F.struct("start", "end", "n_words", "alone", "first_row", "first_start"))).alias("parts")))
    # a run that is too short still gives its lines and sentences
    whole = F.array(F.struct("start", "end", F.col("n_words").cast("int").alias("n_words"), F.lit(True).alias("alone"),
                             F.col("parts")[0]["first_row"].alias("first_row"), F.col("parts")[0]["first_start"].alias("first_start")))
    by_themselves = F.filter("parts", lambda p: p["alone"])
    return (runs.select(ROW, F.explode(F.when(F.col("n_words") >= RUN_WORDS, whole).otherwise(by_themselves)).alias("r"))
            .select(ROW, "r.start", "r.end", "r.n_words", "r.first_row", "r.first_start"))


def removals(docs: DataFrame, text: str = "text", key: str = "doc_id", stored: bool = False) -> DataFrame:
    """One row per removed span: key, ``start``, ``end``, ``n_words`` and the kept occurrence (``first_<key>``, ``first_start``); for
    ``stored`` see :func:`tradeloom.llm.shared.numbered`."""
    rows, number = numbered(docs.select(key, text), stored)
    rows = rows.select(F.col(number).alias(ROW), key, text)
    names = rows.select(F.col(ROW).alias("first_row"), F.col(key).alias(f"first_{key}"))
    return (judged(rows, text, key).join(rows.select(ROW, key), ROW).join(names, "first_row")
            .select(key, "start", "end", "n_words", f"first_{key}", "first_start"))


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    parts, at = [], 0
    for start, end in sorted(spans):
        if start > at:
            parts.append(text[at:start])
        at = max(at, end)
    return "".join([*parts, text[at:]])


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id", stored: bool = False) -> DataFrame:
    """Documents without their removed spans, with the spans that went; a text's spans are one value, as the text is."""
    rows, number = numbered(docs.select(key, text), stored)
    rows = rows.select(F.col(number).alias(ROW), key, text)
    gone = judged(rows, text, key).groupBy(ROW).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("removed"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or s is None else remove_spans(t, [(x["start"], x["end"]) for x in s])
                          for t, s in zip(texts, spans)], dtype=object)

    return rows.join(gone, ROW, "left").select(key, cut(F.col(text), F.col("removed")).alias(text), "removed")
