"""Spelling variants by dense tiles of common prefixes and suffixes.

Words are near if they differ by one inserted, deleted or replaced code point. That is so exactly if the lengths of their
common prefix and their common suffix add up to the longer one's length less one, or more. Words lie in padded code-point
matrices, one aligned left and one aligned right, and a tile compares all words of one block with all of another, column by
column.

Of two near words the longer of which has m code points, one of the two lengths is at least m // 2. So a tile only brings words
together that share their first m // 2 code points, or their last, and whose longer one has m: every word lies in four such
groups. A pair that shares both is taken by the groups of prefixes. Groups of more than ``BLOCK`` words are dealt out as pairs of
blocks, so no task holds more than two blocks of a group, and no pair is left out; the work of a group grows with the square of its words.

Words are counted where the texts are, so that a frequent word is one row of each task, and a cell gives only each word's number of near
words and the best of them. Chains of forms are followed by doubling their steps.

Null and empty texts have no words. Rows without doc_id count with an empty id. Repeated rows count as often as they come.
Equal counts go to the word that is smaller in code-point order. An empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tradeloom.session import written

MIN_LENGTH, MIN_TIMES = 6, 5
DOMINATES = 5  # a form is at least so many times as frequent
BLOCK = 1_024  # words
HELD = 200_000  # different words that a task counts before it hands them on
TYPO_EVERY = 199  # runs whose checksum is divisible by this lose a code point

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(text: str) -> str:
    """A-Z in lower case, and nothing else: bytes.lower knows only these."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def damaged(run: str, check: int) -> str:
    """The run without one code point if the checksum says so."""
    if check % TYPO_EVERY:
        return run
    at = check % len(run)
    return run[:at] + run[at + 1:]


def counted(doc_id: str | None, text: str | None, into: Counter) -> None:
    """Add a document's words, each run with its own checksum of ``<doc_id>:<run>``."""
    before = zlib.crc32(f"{doc_id or ''}:".encode())
    for run, times in Counter(RUN.findall(lowered(text or ""))).items():
        into[damaged(run, zlib.crc32(run.encode(), before))] += times


def vocabulary(docs: DataFrame, text: str = "text", key: str = "doc_id", min_length: int = MIN_LENGTH, min_times: int = MIN_TIMES) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()

        def taken() -> pd.DataFrame:
            long = [(w, n) for w, n in found.items() if len(w) >= min_length]
            found.clear()
            return pd.DataFrame(long, columns=["word", "n"])

        for batch in batches:
            for doc_id, value in zip(batch["key"], batch["text"]):
                counted(doc_id, value, found)
                if len(found) >= HELD:
                    yield taken()
        if found:
            yield taken()

    # the key as text: a column of numbers with nulls would reach pandas as floating point
    parts = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(count, "word string, n bigint")
    return written(parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_times), "vocabulary")


def _codes(words: list[str], width: int, right: bool) -> np.ndarray:
    """Code points of the words, one row each, padded with zeros."""
    padded = "".join([w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words])
    return np.frombuffer(padded.encode("utf-32-le"), np.uint32).reshape(len(words), width)


def common(a: np.ndarray, b: np.ndarray, columns: range) -> np.ndarray:
    """How many of the columns, in their order, every row of ``a`` has in common with every row of ``b``."""
    length = np.zeros((len(a), len(b)), np.uint8 if len(columns) < 128 else np.int64)
    alive = np.ones(length.shape, bool)
    for c in columns:
        alive &= a[:, c][:, None] == b[:, c][None, :]
        if not alive.any():
            break
        length += alive
    return length


class Tile:
    """The words of one cell: code points aligned left and aligned right."""

    def __init__(self, word: list[str], longer: int, prefixes: bool):
        self.size, self.longer, self.prefixes = np.fromiter(map(len, word), np.int64, len(word)), longer, prefixes
        self.left, self.right = _codes(word, longer, False), _codes(word, longer, True)

    def near(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of near words among ``a`` and ``b``, blocks of words of one length each, that the cell's group has to find."""
        if not len(a) or not len(b):
            return a[:0], b[:0]
        shorter, half = min(self.size[a[0]], self.size[b[0]]), self.longer // 2
        prefix = common(self.left[a], self.left[b], range(shorter))
        suffix = common(self.right[a], self.right[b], range(self.longer - 1, self.longer - 1 - shorter, -1))
        near = (prefix + suffix >= self.longer - 1) & ((prefix >= half) if self.prefixes else (suffix >= half) & (prefix < half))
        i, j = np.nonzero(near)
        return a[i], b[j]


def near_places(rows: pd.DataFrame, cell: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the near words of whole cells, every pair once: a word of full length with another such word, or with one a
    code point shorter."""
    word, low, block = rows.word.tolist(), rows.low.values, rows.block.values
    longer, side, apart = rows.longer.values, rows.side.values, low != rows.high.values
    edges = _edges(rows, cell)
    for start, end in zip(edges, edges[1:]):
        if end - start < 2:
            continue
        tile = Tile(word[start:end], int(longer[start]), side[start] == "prefix")
        whole, one = tile.size == tile.longer, block[start:end] == low[start]
        found = []
        if apart[start]:
            a, b = np.flatnonzero(whole & one), np.flatnonzero(whole & ~one)
            found = [tile.near(a, b), tile.near(a, np.flatnonzero(~whole & ~one)), tile.near(b, np.flatnonzero(~whole & one))]
        elif whole.any():
            a = np.flatnonzero(whole)
            i, j = tile.near(a, a)
            found = [(i[i < j], j[i < j]), tile.near(a, np.flatnonzero(~whole))]
        for i, j in found:
            if len(i):
                yield start + i, start + j


def _edges(rows: pd.DataFrame, cell: list[str]) -> list[int]:
    """Where cells begin, and the end; rows are sorted by cell."""
    new = np.zeros(max(len(rows) - 1, 0), bool)
    for c in cell:
        values = rows[c].values
        new |= values[1:] != values[:-1]
    return [0, *(np.flatnonzero(new) + 1).tolist(), len(rows)]


def _whole_cells(batches: Iterator[pd.DataFrame], cell: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of batches sorted by cell, cut where a cell ends."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        rows = pd.concat([*held, batch], ignore_index=True) if held else batch.reset_index(drop=True)
        last = _edges(rows, cell)[-2]
        if last:
            yield rows.iloc[:last]
        held = [rows.iloc[last:]]
    if held:
        yield held[0]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have a near one; ``best`` is the most frequent."""
    size, half = F.length("word"), lambda m: (m / 2).cast("int")
    sides = [F.struct(F.lit(side).alias("side"), m.cast("int").alias("longer"), part(half(m)).alias("part"))
             for m in (size, size + 1)
             for side, part in (("prefix", lambda k: F.substr("word", F.lit(1), k)), ("suffix", lambda k: F.substr("word", size - k + 1, k)))]
    members = words.select("word", "n", F.explode(F.array(*sides)).alias("g")).select("word", "n", "g.*")
    group = ["side", "longer", "part"]
    sizes = members.groupBy(*group).agg(F.count(F.lit(1)).alias("members"), F.max(F.length("word") == F.col("longer")).alias("any")).where(
        (F.col("members") > 1) & F.col("any"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    cells = (members.join(sizes.drop("any"), group).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("word"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*group, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "word", "n"))
    cell = [*group, "low", "high"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_cells(batches, cell):
            found = list(near_places(rows, cell))
            if not found:
                continue
            i, j = (np.concatenate(x) for x in zip(*found))
            word, n = rows.word.values, rows.n.values
            near = pd.DataFrame({"word": word[np.r_[i, j]], "n": n[np.r_[j, i]], "near": word[np.r_[j, i]]})
            near = near.sort_values(["word", "n", "near"], ascending=[True, False, True])
            yield near.groupby("word", sort=False).agg(n_near=("near", "size"), best_n=("n", "first"), best=("near", "first")).reset_index()

    dealt = cells.repartition(*cell).sortWithinPartitions(*cell)
    found = dealt.mapInPandas(compare, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("first")).select(
        "word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words that have a form: the last of the chain. Counts grow along a chain, so it ends."""
    steps = written(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = written(steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                   F.col("next").isNotNull().alias("moved")), "steps")
        steps = joined.drop("moved")
        if joined.where("moved").isEmpty():
            return steps


def grouped(docs: DataFrame, text: str = "text", key: str = "doc_id", min_length: int = MIN_LENGTH, min_times: int = MIN_TIMES) -> DataFrame:
    """Word, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of all words that are long and frequent enough."""
    words = vocabulary(docs, text, key, min_length, min_times)
    is_form = F.col("best_n") >= DOMINATES * F.col("n")
    judged = words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    judged = written(judged, "judged")
    ends = roots(judged.where(F.col("form").isNotNull()))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
