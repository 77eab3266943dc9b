"""Hard negatives by anchor clusters that share one list of candidates.

Vectors are integers, a score is their inner product with the anchor, higher scores come first and ties go to the smaller id.
An anchor's positives are its first ``POSITIVES`` other rows of the same label. For each positive, its negatives are the first
``NEGATIVES`` rows of another label whose score lies between ``LOW`` and ``HIGH`` per cent of the positive's.

1. Anchors are clustered by angle; the centroids are fitted on at most ``SAMPLE`` anchors and number at most ``CLUSTERS``.
   All rows, anchors and candidates, go to their nearest centroid, and a centroid's candidates are dealt out as cells of about
   ``CELL`` rows, copies of one vector too.
2. In a cell, the candidates are sorted once per anchor cluster by the largest inner product that any member of the cluster
   could have with them: their norm times the cosine of their angle to the centroid less the cluster's widest angle. Every
   member walks that list in steps and stops when the bound, times its own norm, is below all scores it could still use.
3. Anchors look into the cells of their own centroid first. The scores found there are what a candidate of the other cells has to
   reach, so cells whose best bound is lower are left out. The best of all cells are then taken by rank. Positives and
   negatives are both found like this, and no bound leaves out a row that belongs to the result.

The anchors are a stated part of the rows and meet all cells that their bounds allow: the work grows with anchors times
candidates where vectors are not clustered. A task holds one cell and ``MEMBERS`` anchors at a time.

Rows with a null id, label or vector, or a null or non-finite component, take no part. Vectors that are shorter than others
count as filled up with zeros. Scores are 64-bit integers and wrap beyond that. Repeated rows are rows like any other; each of
them may be another one's positive. Fewer candidates than asked for give fewer rows, an empty table gives none. Other columns
than the three named are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeloom.session import written

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score
CLUSTERS, CLUSTER_ANCHORS = 256, 64  # centroids at most, anchors a centroid should have
SAMPLE = 20_000  # anchors that centroids are fitted on
CELL = 32_768  # candidates
MEMBERS = 256  # anchors that walk a list together
STEP = 2_048  # candidates of one step of a walk
ROUNDS = 8  # of the clustering
LEAST, MOST = -2**63, 2**63 - 1

RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def usable(df: DataFrame, key: str, vector: str, label: str, scale: int = 256) -> DataFrame:
    """``id``, ``label`` and integer ``vector`` (each component times ``scale``, rounded down) of the rows that take part."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))

    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", bad))
    return rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x.cast("double") * scale)))


def _matrix(vectors: pd.Series, width: int = 0) -> np.ndarray:
    """Vectors as the rows of an integer matrix, filled up with zeros."""
    sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
    width = max(width, int(sizes.max(initial=0)))
    if (sizes == width).all() and width:
        return np.concatenate(vectors.values).reshape(-1, width).astype(np.int64, copy=False)
    matrix = np.zeros((len(vectors), width), np.int64)
    for i, vector in enumerate(vectors):
        matrix[i, :len(vector)] = vector
    return matrix


def _fitted(matrix: np.ndarray, width: int) -> np.ndarray:
    return matrix if matrix.shape[1] == width else np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def _units(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows at length one (zeros stay), and their norms."""
    real = matrix.astype(np.float64)
    norms = np.sqrt((real * real).sum(1))
    return real / np.maximum(norms, 1e-300)[:, None], norms


def _angles(units: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    width = max(units.shape[1], centroids.shape[1])
    return np.arccos(np.clip(_fitted(units, width) @ _fitted(centroids, width).T, -1, 1))


def centroids_of(sample: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` unit centroids of the sample by angle, the same ones for the same sample."""
    units, _ = _units(np.unique(sample, axis=0))
    centres = units[np.random.default_rng(11).permutation(len(units))[:k]]
    for _ in range(ROUNDS):
        nearest = (units @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        norms = np.sqrt((sums * sums).sum(1))
        centres = np.where(norms[:, None] > 1e-9, sums / np.maximum(norms, 1e-9)[:, None], centres)
    return centres


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``a`` and ``b``; as floating point only where that is exact."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if largest < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def placed(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The rows with a number, nearest ``cluster`` and ``angle`` to it, ``norm``, ``angles`` of anchors to all centroids."""
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                units, norms = _units(_matrix(batch.vector))
                angles = _angles(units, centroids)
                nearest = angles.argmin(1)
                yield batch.assign(cluster=nearest.astype(np.int32), angle=angles[np.arange(len(batch)), nearest], norm=norms,
                                   angles=[a if anchor else None for a, anchor in zip(angles, batch.anchor)])

    schema = "row bigint, id bigint, label bigint, vector array<bigint>, anchor boolean, cluster int, angle double, norm double, angles array<double>"
    return written(rows.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "label", "vector", "anchor")
                   .mapInPandas(place, schema), "vectors")


class _Cell:
    """The candidates of a cell and, for each anchor cluster that asks, their order by upper bound."""

    def __init__(self, rows: pd.DataFrame):
        self.matrix = _matrix(rows.vector)
        self.units, self.norms = _units(self.matrix)
        self.row, self.id, self.label = (rows[c].values.astype(np.int64) for c in ("row", "id", "label"))

    def ordered(self, centroid: np.ndarray, widest: float) -> None:
        beyond = np.maximum(_angles(self.units, centroid[None, :])[:, 0] - widest - 1e-6, 0)
        bound = self.norms * (np.cos(np.minimum(beyond, np.pi)) + 1e-9)
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]

    def walk(self, members: pd.DataFrame, k: int, same: bool) -> pd.DataFrame:
        """The first ``k`` candidates of every member and range of scores, among those that reach the range's ``floor``."""
        width = max(self.matrix.shape[1], int(members.vector.map(len).max()))
        anchors, cell = _matrix(members.vector, width), _fitted(self.matrix, width)
        norms = _units(anchors)[1]
        n_ranges = members.low.map(len).values
        ranges = int(n_ranges.max())
        low, high, floor = (np.full((len(members), ranges), fill, np.int64) for fill in (MOST, LEAST, MOST))
        for i, (a, b, c) in enumerate(zip(members.low, members.high, members.floor)):
            low[i, :len(a)], high[i, :len(b)], floor[i, :len(c)] = a, b, c
        floor = np.maximum(floor, low)
        label, row = members.label.values.astype(np.int64), members["row"].values.astype(np.int64)
        pools = [(np.empty(0, np.int64),) * 3 for _ in range(ranges)]  # member, candidate, score
        active = np.arange(len(members))
        for at in range(0, len(self.order), STEP):
            reach = norms[active] * self.bound[at] * (1 + 1e-9) + 1
            active = active[(reach[:, None] >= floor[active]).any(1)]
            if not len(active):
                break
            step = self.order[at:at + STEP]
            found = scores(anchors[active], cell[step])
            fits = (label[active][:, None] == self.label[step]) == same
            if same:
                fits &= row[active][:, None] != self.row[step]
            for j in range(ranges):
                who, what = np.nonzero(fits & (found >= floor[active, j][:, None]) & (found <= high[active, j][:, None]))
                if not len(who):
                    continue
                member, candidate, score = (np.concatenate(x) for x in zip(pools[j], (active[who], step[what], found[who, what])))
                best = np.lexsort((self.row[candidate], self.id[candidate], -score, member))
                member, candidate, score = member[best], candidate[best], score[best]
                starts = np.flatnonzero(np.r_[True, member[1:] != member[:-1]])
                place = np.arange(len(member)) - np.repeat(starts, np.diff(np.r_[starts, len(member)]))
                keep = place < k
                full = place == k - 1
                floor[member[full], j] = np.maximum(floor[member[full], j], score[full])
                pools[j] = member[keep], candidate[keep], score[keep]
        return pd.concat([pd.DataFrame({"row": row[m], "range": np.full(len(m), j, np.int32), "found_row": self.row[c], "found_id": self.id[c],
                                        "score": s}) for j, (m, c, s) in enumerate(pools)])


def _sections(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Consecutive rows of one cell, kind and cluster, anchors at most ``MEMBERS`` at a time."""
    held: list[pd.DataFrame] = []

    def pieces(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        size = MEMBERS if rows.asks.iloc[0] else len(rows)
        for at in range(0, len(rows), size):
            yield rows.iloc[at:at + size]

    for batch in batches:
        marks = list(zip(batch.cell, batch.asks, batch.cluster))
        edges = [0, *[i for i in range(1, len(marks)) if marks[i] != marks[i - 1]], len(marks)]
        for start, end in zip(edges, edges[1:]):
            if start == end:
                continue
            if held and ((held[0].cell.iloc[0], held[0].asks.iloc[0], held[0].cluster.iloc[0]) != marks[start]
                         or held[0].asks.iloc[0] and sum(map(len, held)) >= MEMBERS):
                yield from pieces(pd.concat(held))
                held = []
            held.append(batch.iloc[start:end])
    if held:
        yield from pieces(pd.concat(held))


class Search:
    """Candidates in cells, and walks of anchors over them."""

    def __init__(self, rows: DataFrame, centroids: np.ndarray):
        self.rows, self.centroids = rows, centroids
        about = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("widest"), F.max("norm").alias("norm"),
                                            F.max(F.when(F.col("anchor"), F.col("angle"))).alias("anchors_widest")).collect()  # at most CLUSTERS rows
        self.widest, self.norm, self.anchors_widest = (np.zeros(len(centroids)) for _ in range(3))
        self.cells = np.zeros(len(centroids), np.int64)
        for r in about:
            self.widest[r.cluster], self.norm[r.cluster], self.anchors_widest[r.cluster] = r.widest, r.norm, r.anchors_widest or 0
            self.cells[r.cluster] = -(-r.n // CELL)

    def _cells_of(self, cluster: Column) -> Column:
        return F.element_at(F.array(*[F.lit(int(n)) for n in self.cells]), cluster + 1)

    def _found(self, asking: DataFrame, k: int, same: bool) -> DataFrame:
        """What the anchors ``asking`` find in the cells that their ``cell_of`` (cluster and number) names."""
        none = F.lit(None).cast("array<bigint>")
        shared = ["cell", "asks", "cluster", "row", "id", "label", "vector"]
        number = F.pmod(F.xxhash64("row"), self._cells_of(F.col("cluster")))
        candidates = (self.rows.withColumn("cell", F.col("cluster").cast("long") * (1 << 40) + number).withColumn("asks", F.lit(False))
                      .withColumn("cluster", F.lit(-1)).select(*shared, none.alias("low"), none.alias("high"), none.alias("floor")))
        asking = asking.withColumn("cell", F.explode(F.expr("transform(sequence(0, cells - 1), i -> target * 1099511627776L + i)")))
        asking = asking.withColumn("asks", F.lit(True)).select(*shared, "low", "high", "floor")
        centroids, widest = self.centroids, self.anchors_widest

        def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            at = cell = cluster = None
            for section in _sections(batches):
                here = section.cell.iloc[0]
                if not section.asks.iloc[0]:
                    at, cell, cluster = here, _Cell(section), None
                elif at == here:
                    if cluster != section.cluster.iloc[0]:
                        cluster = section.cluster.iloc[0]
                        cell.ordered(centroids[cluster], widest[cluster])
                    yield cell.walk(section, k, same)

        union = candidates.unionByName(asking).repartition("cell").sortWithinPartitions("cell", "asks", "cluster")
        return union.mapInPandas(walk, "row bigint, range int, found_row bigint, found_id bigint, score bigint")

    def first(self, anchors: DataFrame, k: int, same: bool, label: str) -> DataFrame:
        """(row, range, rank, found_row, found_id, score) of the first ``k`` rows in every range of scores of every anchor.

        ``anchors`` have arrays ``low`` and ``high``, one element a range."""
        order = Window.partitionBy("row", "range").orderBy(F.desc("score"), "found_id", "found_row")

        def ranked(found: DataFrame) -> DataFrame:
            return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

        clusters = F.col("cluster").cast("long")
        near = written(ranked(self._found(anchors.withColumn("floor", F.col("low")).withColumn("target", clusters)
                                          .withColumn("cells", self._cells_of(F.col("cluster"))), k, same)), f"{label}-near")
        floors = (near.where(F.col("rank") == k).groupBy("row")
                  .agg(F.map_from_entries(F.collect_list(F.struct("range", "score"))).alias("full")))
        reach = F.transform(F.array(*[F.struct(F.lit(float(n)).alias("n"), F.lit(float(w)).alias("w")) for n, w in zip(self.norm, self.widest)]),
                            lambda c, i: F.col("norm") * c["n"] * (F.cos(F.greatest(F.get("angles", i) - c["w"] - 1e-6, F.lit(0.0))) + 1e-9) + 1)
        far = anchors.join(floors, "row", "left").withColumn("floor", F.transform(
            "low", lambda low, i: F.greatest(low, F.coalesce(F.element_at("full", i), low))))
        far = (far.withColumn("reach", reach).withColumn("target", F.explode(F.sequence(F.lit(0), F.lit(len(self.centroids) - 1))))
               .where((F.col("target") != F.col("cluster")) & (F.get("reach", F.col("target")) >= F.array_min("floor")))
               .withColumn("cells", self._cells_of(F.col("target"))).where("cells > 0").withColumn("target", F.col("target").cast("long")))
        found = near.drop("rank").unionByName(self._found(far, k, same)) if len(self.centroids) > 1 else near.drop("rank")
        return written(ranked(found), label)


def mine(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """Negatives for each anchor and positive, with their ranks and scores; ``rows`` as :func:`usable` gives them, ``anchor``
    says by ``id``, ``label`` and ``vector`` which of them are anchors."""
    spark = rows.sparkSession
    rows = rows.withColumn("anchor", F.coalesce(anchor, F.lit(False)))
    picked = rows.where("anchor")
    n = picked.count()
    if not n:
        return spark.createDataFrame([], RESULT)
    sample = picked.select("id", "vector").orderBy(F.xxhash64("id"), "id", "vector").limit(SAMPLE).toPandas()
    centroids = centroids_of(_matrix(sample.vector), min(CLUSTERS, max(1, n // CLUSTER_ANCHORS)))
    rows = placed(rows, centroids)
    search, anchors = Search(rows, centroids), rows.where("anchor")

    whole = anchors.withColumns({"low": F.array(F.lit(LEAST)), "high": F.array(F.lit(MOST))})
    found = search.first(whole, positives, True, "positives")
    share = lambda p: (F.col("score").cast("decimal(20,0)") * p / 100).cast("decimal(38,2)")
    ranges = found.withColumns({"low": F.ceil(share(LOW)).cast("long"), "high": F.floor(share(HIGH)).cast("long")}).where("low <= high")
    ranges = ranges.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "found_id", "score", "low", "high"))).alias("ranges"))
    asking = anchors.join(ranges, "row").withColumns({"low": F.col("ranges.low"), "high": F.col("ranges.high")})
    asking = written(asking, "asking")
    chosen = search.first(asking.drop("ranges"), negatives, False, "negatives")
    positive = F.get("ranges", F.col("range"))
    return chosen.join(asking.select("row", "id", "ranges"), "row").select(
        F.col("id").alias("anchor_id"), positive["found_id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("found_id").alias("negative_id"), positive["score"].alias("positive_score"), F.col("score").alias("negative_score"))
