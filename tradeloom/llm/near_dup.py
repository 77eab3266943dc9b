"""Near duplicates by SetSketch registers.

A document's set holds the 64-bit hashes of its distinct shingles of five words (the whole sequence if it has fewer). Each of
``REGISTERS`` registers keeps an exponentially spaced, truncated minimum of hashed elements, ``floor(1 - log_b(min))``;
registers of a union are the maxima of the registers, and equal registers are the likelier the more similar two sets are.

1. Documents with equal sets are one node (grouped by a 128-bit fingerprint, combined before the shuffle).
2. Bands of registers give every node its buckets. Nodes of one bucket are first compared with its first node only.
3. Nodes of a bucket that are then still in different components are compared block by block: a bucket is dealt out as cells
   of two blocks of about ``BLOCK`` nodes, and a cell gives only pairs whose registers, ``FINE`` further ones among them,
   allow a link (five standard errors), each pair in the first band in which it agrees. Dealing out costs a bucket's size
   over ``BLOCK`` rows a node, so it is done in rounds that deal each node to about ``ALL_PAIRS`` others, and nodes that one
   round has linked are not compared in the next. No bucket is too large: all its blocks meet, at a cost that grows with the
   square of the nodes that stay apart.
4. Pairs pass a joint maximum-likelihood estimate from the registers (five too), those of step 3 in their cell, and are
   then confirmed on the full sets.
5. Components are found by alternating large and small stars, in tables written to the shared folder.

A pair whose registers are equal with a probability of 0.85 misses all bands with one of 1.7e-4: 1,736 of 10 million simulated
pairs with this file's bands, which share registers and so do not miss independently.

Every row gets a number first, and rows are joined and dropped by it; a doc_id may be null, of any type, or come with several
texts. Null text and text without words have an empty set and are linked with nothing. Repeated rows and equal texts form one
component. Rows without doc_id are linked like others and rank after them: their component is the smallest doc_id in reach, null
if there is none. ``near_duplicates`` keeps all rows of the smallest doc_id, ``without_near_duplicates`` the first row of each
component and all rows with an empty set. Columns other than the two named are never read, and any names may be among them.
An empty table gives no rows. No links, components or fingerprints reach the driver, only counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tradeloom.llm.shared import ROW, numbered, only_rows, without_rows
from tradeloom.session import written, written_alone

SHINGLE = 5
PERCENT = 85  # 100 * intersection >= PERCENT * union
REGISTERS = 256
BASE, RATE, LIMIT = 1.001, 20.0, 65534  # of the registers
ROWS, BANDS = 10, 56  # registers in a band, bands
BLOCK = 512  # nodes
ALL_PAIRS = 4 * BLOCK  # nodes of a bucket that a node is dealt to in one round
FINE = 512  # registers, one byte of each
ESTIMATE_ERRORS = 5.0
BROADCAST_PAIRS = 100_000  # counted; some 3 MB

_SEED = np.random.default_rng(20240229)
_FACTORS = _SEED.integers(1, 2**63, size=REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _SEED.integers(1, 2**63, size=SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FINE_FACTORS = _SEED.integers(1, 2**63, size=FINE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; bytes.lower and bytes.split know A-Z and the six white space characters only."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    if len(words) < SHINGLE:
        whole = np.array([len(words)], np.uint64)
        for k in range(len(words)):
            whole = _scrambled(whole * _MIX[0] + hashes[k:k + 1])
        return whole
    windows = np.zeros(len(words) - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        windows += hashes[k:k + len(windows)] * _MIX[k]
    return np.unique(_scrambled(windows))


def fingerprint(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def registers(items: np.ndarray, factors: np.ndarray = _FACTORS) -> np.ndarray:
    """The SetSketch of a non-empty set as 16-bit registers."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 256):
        np.minimum(least, (items[at:at + 256, None] * factors[None, :]).min(0), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 1) / 2.0**64 * (1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def estimated(equal: np.ndarray, above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from the registers that are equal, larger in a, larger in b."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    most = np.minimum(u / v, v / u)
    p = lambda x: -np.log(np.maximum(1 - x * (BASE - 1) / BASE, 1e-300)) / np.log(BASE)
    tiny = 1e-12

    def likelihood(j: np.ndarray) -> np.ndarray:
        larger_a, larger_b = p(np.maximum(u - v * j, 0)), p(np.maximum(v - u * j, 0))
        return (above * np.log(np.maximum(larger_a, tiny)) + below * np.log(np.maximum(larger_b, tiny))
                + equal * np.log(np.maximum(1 - larger_a - larger_b, tiny)))

    low, high, ratio = np.zeros_like(most), most.copy(), (np.sqrt(5) - 1) / 2
    for _ in range(30):  # golden section; the likelihood has one peak
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        left = likelihood(a) > likelihood(b)
        high, low = np.where(left, b, high), np.where(left, low, a)
    return (low + high) / 2


def sketches(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Number, key, ``fp``, ``n_shingles`` and ``sketch`` of every numbered row."""
    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch[text]]
            yield pd.DataFrame({ROW: batch[ROW], key: batch[key], "fp": [fingerprint(s) for s in sets], "n_shingles": [len(s) for s in sets],
                                "sketch": [registers(s).tobytes() if len(s) else b"" for s in sets]})

    key_type = docs.schema[key].dataType
    # the key as text and back: a column of numbers with nulls would reach pandas as floating point
    found = docs.select(ROW, F.col(key).cast("string"), text).mapInPandas(
        sketch, f"{ROW} bigint, `{key}` string, fp binary, n_shingles bigint, sketch binary")
    return found.withColumn(key, F.col(key).cast(key_type))


def fine_registers(items: np.ndarray) -> bytes:
    """The low bytes of further registers."""
    return registers(items, _FINE_FACTORS).astype(np.uint8).tobytes()


def _matrix(sketch: pd.Series, kind: type = np.uint16) -> np.ndarray:
    return np.frombuffer(b"".join(sketch), kind).reshape(len(sketch), -1)


def _places() -> tuple[np.ndarray, np.random.Generator]:
    """The registers of each band, and the generator that chose them."""
    chosen = np.random.default_rng(7)
    return np.stack([chosen.choice(REGISTERS, ROWS, replace=False) for _ in range(BANDS)]), chosen


def band_keys(nodes: DataFrame) -> DataFrame:
    """(band, key, nid) for every band of every node."""
    places, chosen = _places()
    factors = chosen.integers(1, 2**63, size=places.shape, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at:at + 512]
                picked = _matrix(part.sketch)[:, places].astype(np.uint64)
                hashed = _scrambled((picked * factors).sum(2, dtype=np.uint64) + np.arange(len(places), dtype=np.uint64)[None, :])
                yield pd.DataFrame({"nid": part.nid.values, "keys": list(hashed.view(np.int64))})

    return nodes.select("nid", "sketch").mapInPandas(keys, "nid bigint, keys array<bigint>").select(
        F.posexplode("keys").alias("band", "key"), "nid")


def buckets(nodes: DataFrame) -> DataFrame:
    """(key, band, nid, n, pivot) of all buckets with two nodes or more."""
    keys = band_keys(nodes)
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("nid").alias("pivot")).where("n > 1")
    return written(keys.join(counts, "key"), "buckets")


def _both(pairs: DataFrame, side: DataFrame, columns: list[str], few: bool) -> DataFrame:
    """The pairs with ``columns`` of both nodes, suffixed _a and _b."""
    for end in ("a", "b"):
        right = side.select(F.col("nid").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])
        pairs = right.join(F.broadcast(pairs) if few and end == "a" else pairs, end)
    return pairs


def _possible(equal: np.ndarray, above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether the joint estimate allows a link."""
    threshold = PERCENT / 100
    return estimated(equal, above, below, n_a, n_b) >= threshold - ESTIMATE_ERRORS * (threshold * (1 - threshold) / REGISTERS) ** 0.5


def likely(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and joint estimate allow to be linked."""
    def allowed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                a, b = _matrix(batch.sketch_a), _matrix(batch.sketch_b)
                yield batch.loc[_possible((a == b).sum(1), (a > b).sum(1), (a < b).sum(1), batch.n_shingles_a.values,
                                          batch.n_shingles_b.values), ["a", "b"]]

    sized = _both(pairs, sets, ["n_shingles", "sketch"], pairs.count() <= BROADCAST_PAIRS).where(
        F.least("n_shingles_a", "n_shingles_b") * 100 >= F.greatest("n_shingles_a", "n_shingles_b") * PERCENT)
    return written(sized.select("a", "b", "n_shingles_a", "n_shingles_b", "sketch_a", "sketch_b").mapInPandas(allowed, "a bigint, b bigint"), "likely")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    shared = F.size(F.array_intersect("items_a", "items_b"))
    full = _both(pairs, sets, ["items"], pairs.count() <= BROADCAST_PAIRS).select(
        "a", "b", shared.alias("both"), (F.size("items_a") + F.size("items_b")).alias("total"))
    return written(full.where(F.col("both") * 100 >= (F.col("total") - F.col("both")) * PERCENT).select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """(nid, root) of every node that has a link; root is the smallest nid of its component."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    last = None
    while True:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, "large")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                                 F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = written(small.where("u <> v").distinct(), "small")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == last:
            return edges.select(F.col("u").alias("nid"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("nid"), F.col("v").alias("root")).distinct())
        last = state


def node_sets(docs: DataFrame, nodes: DataFrame, text: str) -> DataFrame:
    """(nid, n_shingles, sketch, fine, items) of the given nodes, from the text of their first row."""
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingle_set(t) for t in batch["text"]]
            yield batch[["nid", "n_shingles", "sketch"]].assign(
                fine=[fine_registers(s) for s in found], items=[s.view(np.int64) for s in found])

    texts = only_rows(docs.select(ROW, F.col(text).alias("text")), ROW, written(nodes.select(ROW), "read-again"))
    found = texts.join(nodes.select("nid", ROW, "n_shingles", "sketch"), ROW).drop(ROW).mapInPandas(
        sets, "nid bigint, n_shingles bigint, sketch binary, fine binary, items array<bigint>")
    return written(found, "sets")


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of one cell after the other, from batches sorted by cell."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        cells = batch.cell.values
        edges = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1).tolist(), len(batch)]
        for start, end in zip(edges, edges[1:]):
            if start == end:
                continue
            if held and held[0].cell.values[0] != cells[start]:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(batch.iloc[start:end])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def rounds(largest: int) -> int:
    """Rounds in which all blocks of a bucket of ``largest`` nodes meet."""
    return -(-largest // BLOCK) // 2 // _distances() + 1


def _distances() -> int:
    """Distances between blocks that one round takes; blocks are laid out in a circle, with two at each distance."""
    return max(1, ALL_PAIRS // BLOCK // 2)


def crossing(members: DataFrame, sets: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of a bucket's members with different roots that sizes, registers and joint estimate allow to be linked,
    of the blocks that meet in round ``turn``."""
    places, _ = _places()
    threshold, size = PERCENT / 100, REGISTERS + FINE
    least = int(size * threshold - ESTIMATE_ERRORS * (size * threshold * (1 - threshold)) ** 0.5)

    def compared(cell: pd.DataFrame) -> Iterator[tuple[np.ndarray, ...]]:
        nid, root, n, block = (cell[c].values for c in ("nid", "root", "n_shingles", "block"))
        if (root == root[0]).all():
            return
        sketch, fine, band = _matrix(cell.sketch), _matrix(cell.fine, np.uint8), cell.band.values[0]
        first = int((block == block[0]).sum())  # rows are sorted by block
        for i in range(first):
            j = i + 1 if first == len(nid) else first
            j += np.flatnonzero((root[j:] != root[i]) & (np.minimum(n[j:], n[i]) * 100 >= np.maximum(n[j:], n[i]) * PERCENT))
            equal = sketch[j] == sketch[i]
            near = equal.sum(1) + (fine[j] == fine[i]).sum(1) >= least
            j, equal = j[near], equal[near]
            if len(j):
                new = ~equal[:, places[:band]].all(2).any(1)  # not those that an earlier band has, whose bucket is compared as well
                j, equal, above = j[new], equal[new].sum(1), (sketch[i] > sketch[j[new]]).sum(1)
                yield np.minimum(nid[i], nid[j]), np.maximum(nid[i], nid[j]), equal, above, REGISTERS - equal - above, np.full(len(j), n[i]), n[j]

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in _cells(batches):
            if made := list(compared(cell)):
                a, b, *registers_and_sizes = map(np.concatenate, zip(*made))
                yield pd.DataFrame({"a": a, "b": b})[_possible(*registers_and_sizes)]

    blocks, first = F.ceil(F.col("n") / BLOCK), turn * _distances()
    around = F.sequence(F.lit(first), F.least(F.lit(first + _distances() - 1).cast("long"), F.floor(F.col("blocks") / 2)))
    others = F.array_distinct(F.flatten(F.transform(around, lambda d: F.array(
        F.pmod(F.col("block") + d, F.col("blocks")), F.pmod(F.col("block") + F.col("blocks") - d, F.col("blocks"))))))
    dealt = (members.where("nid <> pivot").withColumn("blocks", blocks).where(F.floor(F.col("blocks") / 2) >= first)
             .withColumn("block", F.expr("pmod(xxhash64(nid, key), blocks)"))
             .join(sets.select("nid", "n_shingles", "sketch", "fine"), "nid")
             .withColumn("other", F.explode(others))
             .select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("cell"),
                     "block", "band", "nid", "root", "n_shingles", "sketch", "fine"))
    return dealt.repartition("cell").sortWithinPartitions("cell", "block").mapInPandas(pairs, "a bigint, b bigint")


def linked(sets: DataFrame, found: DataFrame) -> DataFrame:
    """The links (a, b) of the buckets ``found``, as many as components need."""
    first = written(found.where("nid > pivot").select(F.col("pivot").alias("a"), F.col("nid").alias("b")).distinct(), "pairs")
    links = [confirmed(likely(first, sets), sets)]
    last = rounds(found.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0])
    for turn in range(last):  # each pair is made once, so only the first ones may have been tested
        rooted = components(_union(links))
        members = found.where("n > 2").join(rooted, "nid", "left").withColumn("root", F.coalesce("root", "nid"))
        undecided = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
        members = written(members.join(undecided, "key"), "open")
        crossed = written(crossing(members, sets, turn).distinct().join(first, ["a", "b"], "left_anti"), "pairs")
        links.append(confirmed(crossed, sets))
    return _union(links)


def _union(links: list[DataFrame]) -> DataFrame:
    whole = links[0]
    for part in links[1:]:
        whole = whole.unionByName(part)
    return whole


def judged(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Number, key, ``n_shingles``, ``component_id`` (the smallest key of the component), ``kept`` and ``first`` (whether it is the
    first row of its component) of every numbered row."""
    rows = written(sketches(docs, text, key), "sketches")
    nodes = (rows.where("n_shingles > 0").groupBy("fp")
             .agg(F.min(F.struct(F.col(key).isNull().alias("unknown"), F.col(key).alias("doc"), ROW)).alias("first"),
                  F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
             .select("fp", "first", F.col(f"first.{ROW}").alias(ROW), "n_shingles", "sketch"))
    nodes = written(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    found = buckets(nodes)
    shared = found.select("nid").distinct()
    sets = node_sets(docs, nodes.join(shared, "nid", "left_semi"), text)
    rooted = nodes.select("nid", "first").join(components(linked(sets, found)), "nid")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("lowest"))
    by_set = nodes.select("fp", "nid", "first").join(rooted.join(lowest, "root").select("nid", "lowest"), "nid", "left").select(
        "fp", F.coalesce("lowest", "first").alias("lowest"))
    by_set = written(by_set, "components")
    first = F.col("lowest").isNull() | (F.col(f"lowest.{ROW}") == F.col(ROW))
    component = F.when(F.col("lowest").isNull(), F.col(key)).otherwise(F.col("lowest.doc"))
    return (rows.select(ROW, key, "fp", "n_shingles").join(by_set, "fp", "left")
            .select(ROW, key, "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col(key) == component, first).alias("kept"), first.alias("first")))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", stored: bool = False) -> DataFrame:
    """Key, ``n_shingles``, ``component_id`` (the smallest key of the component) and ``kept`` of every row; for ``stored`` see
    :func:`tradeloom.llm.shared.numbered`."""
    rows, number = numbered(docs.select(key, text), stored)
    return judged(rows.select(F.col(number).alias(ROW), key, text), text, key).drop(ROW, "first")


def without_near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", stored: bool = False) -> DataFrame:
    """The first row of every component, with all its columns."""
    rows, number = numbered(docs, stored)
    narrow = rows.select(F.col(number).alias(ROW), key, text)
    gone = written_alone(docs.sparkSession, lambda: judged(narrow, text, key).where("not first").select(ROW), "copies")
    return without_rows(rows, number, gone)
