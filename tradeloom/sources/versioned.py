"""Tables with upserts that can be read as of an earlier version, on plain Parquet folders.

Layout below ``path``::

    changes/version=<n>/   the rows version n inserted, updated or deleted, one per key
    commits/version=<n>/   one row, written after the changes; without it the version is not read
    bases/version=<n>/     optional: the whole state as of n, so that older changes can go
    base_commits/...       one row per finished base

An upsert costs what its batch costs, not what the table holds, and writing the same version
again replaces it. One writer at a time per table. Where a table format with MERGE is
installed, prefer that. All versions have the columns of the first; other rows are refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tradeloom.operators.dedup import dedup_latest
from tradeloom.sources import paths

DELETED, VERSION = "_deleted", "version"
_COMMIT = T.StructType([T.StructField("committed_at", T.TimestampType()),
                        T.StructField("operation", T.StringType()),
                        T.StructField("writer", T.StringType()),
                        T.StructField("batch", T.LongType()),
                        T.StructField(VERSION, T.LongType())])


def merge_frames(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plain upsert of two tables with unique keys: all updates, and the target rows they miss."""
    return updates.unionByName(target.join(updates.select(*keys), list(keys), "left_anti"))


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    # --- commits ------------------------------------------------------------------------

    def _commits(self, kind: str = "commits") -> DataFrame:
        if not paths.exists(self.spark, f"{self.path}/{kind}"):
            return self.spark.createDataFrame([], _COMMIT)
        return self.spark.read.schema(_COMMIT).parquet(f"{self.path}/{kind}")

    def _commit(self, version: int, operation: str, writer: str | None = None, batch: int | None = None,
                kind: str = "commits") -> None:
        row = self.spark.range(1).select(F.current_timestamp().alias("committed_at"),
                                         F.lit(operation).alias("operation"),
                                         F.lit(writer).cast("string").alias("writer"),
                                         F.lit(batch).cast("long").alias("batch"))
        row.write.mode("overwrite").parquet(f"{self.path}/{kind}/{VERSION}={version}")

    def latest(self) -> int | None:
        """The newest committed version, None for a table never written."""
        return self._commits().agg(F.max(VERSION)).first()[0]

    def _base(self, as_of: int) -> int | None:
        bases = self._commits("base_commits")
        return bases.filter(F.col(VERSION) <= as_of).agg(F.max(VERSION)).first()[0]

    # --- reading ------------------------------------------------------------------------

    def _start(self, as_of: int) -> tuple[int, DataFrame]:
        """The version reading starts from, and its rows: the newest base, else the first version."""
        base = self._base(as_of)
        if base is not None:
            return base, self.spark.read.parquet(f"{self.path}/bases/{VERSION}={base}")
        folded = self._commits("base_commits").agg(F.min(VERSION)).first()[0]
        if folded is not None:
            raise ValueError(f"version {as_of} was folded into version {folded}")
        first = self._commits().agg(F.min(VERSION)).first()[0]
        if as_of < first:
            raise ValueError(f"no version {as_of} in {self.path}; the first is {first}")
        return first, self.spark.read.parquet(f"{self.path}/changes/{VERSION}={first}")

    def _changes(self, after: int, up_to: int) -> DataFrame:
        """Rows of the committed versions in between, with their version; other folders aren't read."""
        between = F.col(VERSION).between(after + 1, up_to)
        committed = self._commits().filter(between).select(VERSION)
        return (self.spark.read.parquet(f"{self.path}/changes")
                .withColumn(VERSION, F.col(VERSION).cast("long"))
                .filter(between).join(committed, VERSION, "left_semi"))

    def _state(self, as_of: int) -> DataFrame:
        """Newest row of each key, deleted ones included.

        Only the changes are sorted by key. The start has one row per key, and loses those the
        changes replace in a join that needs no shuffle while the changes are few.
        """
        first, start = self._start(as_of)
        if first == as_of:
            return start
        changes = dedup_latest(self._changes(first, as_of), self.keys, [f"{VERSION} desc"], [DELETED])
        return merge_frames(start, changes.drop(VERSION), self.keys)

    def read_as_of(self, version: int) -> DataFrame:
        latest = self.latest()
        if latest is None or not 0 <= version <= latest:
            raise ValueError(f"no version {version} in {self.path}; the latest is {latest}")
        return self._visible(version)

    def _visible(self, version: int) -> DataFrame:
        return self._state(version).filter(~F.col(DELETED)).drop(DELETED)

    def read(self) -> DataFrame:
        """The current rows."""
        latest = self.latest()
        if latest is None:
            raise ValueError(f"{self.path} has no committed version")
        return self._visible(latest)

    def history(self) -> DataFrame:
        """One row per version: when, by which operation, rows inserted, updated and deleted.

        A table with a base starts there, its rows counted as inserted. Of the start's rows only
        those with later changes are looked at.
        """
        latest = self.latest()
        first, start = self._start(latest)
        marks = [*self.keys, VERSION, DELETED]
        log = start.withColumn(VERSION, F.lit(first).cast("long")).select(*marks)
        counts = log.groupBy(VERSION).agg(F.count(F.lit(1)).alias("rows_inserted")).withColumns(
            {"rows_updated": F.lit(0).cast("long"), "rows_deleted": F.lit(0).cast("long")})
        if first < latest:
            changes = self._changes(first, latest).select(*marks)
            touched = log.join(changes.select(*self.keys).distinct(), self.keys, "left_semi")
            before = F.lag(DELETED).over(Window.partitionBy(*self.keys).orderBy(VERSION))
            kind = (F.when(F.col(DELETED), F.lit("deleted"))
                    .when(F.coalesce(before, F.lit(True)), F.lit("inserted")).otherwise(F.lit("updated")))
            changed = (touched.unionByName(changes).withColumn("_kind", kind)
                       .filter(F.col(VERSION) > first).groupBy(VERSION)
                       .agg(*[F.count(F.when(F.col("_kind") == k, 1)).alias(f"rows_{k}")
                              for k in ("inserted", "updated", "deleted")]))
            counts = counts.unionByName(changed)
        return (self._commits().filter(F.col(VERSION) >= first)
                .join(counts, VERSION, "left").fillna(0)
                .select(VERSION, "committed_at", "operation", "rows_inserted", "rows_updated",
                        "rows_deleted"))

    # --- writing ------------------------------------------------------------------------

    def _write(self, rows: DataFrame, version: int, operation: str, writer: str | None = None,
               batch: int | None = None) -> int:
        rows.write.mode("overwrite").parquet(f"{self.path}/changes/{VERSION}={version}")
        self._commit(version, operation, writer, batch)
        return version

    def _in_shape(self, rows: DataFrame, version: int) -> DataFrame:
        """The rows with the columns in the order of ``version``; raises if names or types differ."""
        stored = next(f"{self.path}/{kind}/{VERSION}={version}" for kind in ("changes", "bases")
                      if paths.exists(self.spark, f"{self.path}/{kind}/{VERSION}={version}"))
        wanted = {f.name: f.dataType for f in self.spark.read.parquet(stored).schema if f.name != DELETED}
        given = {f.name: f.dataType for f in rows.schema}
        if given != wanted:
            differing = sorted(c for c in wanted.keys() | given.keys() if wanted.get(c) != given.get(c))
            raise ValueError(f"columns differ from those of {self.path}: {', '.join(differing)}")
        return rows.select(*wanted)

    def upsert(self, updates: DataFrame, order: Sequence[str], tiebreak: Sequence[str],
               version: int | None = None, writer: str | None = None) -> int:
        """Update matching keys, insert the others; returns the version written.

        Several rows of one key in ``updates`` are reduced to the first in ``order`` and
        ``tiebreak``. Writing the same ``version`` again replaces it. With a ``writer``, such as
        a stream, ``version`` is that writer's own batch id: a replayed batch replaces the version
        it made, a new one gets the next version, whatever a rollback added in between. A second
        writer is refused, since it would count from 0 again.
        """
        mine = F.col("writer").eqNullSafe(F.lit(writer).cast("string"))
        batch = None if writer is None else version
        latest, replayed, others = self._commits().agg(
            F.max(VERSION), F.max(F.when(mine & (F.col("batch") == F.lit(batch).cast("long")), F.col(VERSION))),
            F.max(F.col("writer").isNotNull() & ~mine)).first()
        if writer is not None and others:
            raise ValueError(f"{self.path} holds versions of another writer than {writer}")
        if version is None or writer is not None:
            version = replayed if replayed is not None else 0 if latest is None else latest + 1
        if latest is not None:
            updates = self._in_shape(updates, latest)
        rows = dedup_latest(updates, self.keys, order, tiebreak).withColumn(DELETED, F.lit(False))
        return self._write(rows, version, "upsert", writer, batch)

    def rollback(self, version: int) -> int:
        """Make the rows of an earlier version current again, as a new version.

        Only keys changed since then are compared.
        """
        latest = self.latest()
        wanted, current = self.read_as_of(version), self.read()
        if version < latest:
            touched = self._changes(version, latest).select(*self.keys).distinct()
            wanted = wanted.join(touched, self.keys, "left_semi")
            current = current.join(touched, self.keys, "left_semi")
        restored = wanted.subtract(current).withColumn(DELETED, F.lit(False))
        removed = (current.join(wanted.select(*self.keys), self.keys, "left_anti")
                   .withColumn(DELETED, F.lit(True)))
        return self._write(restored.unionByName(removed), latest + 1, f"rollback to {version}")

    def compact(self, keep_from: int) -> None:
        """Fold everything up to ``keep_from`` into a base and remove what that replaces.

        Reads as of ``keep_from`` and later stay as they were; earlier ones raise. The base is
        committed before anything is removed, so an interrupted call loses nothing and can be
        repeated.
        """
        base = self.read_as_of(keep_from).withColumn(DELETED, F.lit(False))
        if self._base(keep_from) != keep_from:
            base.write.mode("overwrite").parquet(f"{self.path}/bases/{VERSION}={keep_from}")
            self._commit(keep_from, "compact", kind="base_commits")
        # the commit of keep_from stays: it tells that the version exists
        for kind, oldest_kept in (("changes", keep_from + 1), ("bases", keep_from),
                                  ("base_commits", keep_from), ("commits", keep_from)):
            for folder in paths.subfolders(self.spark, f"{self.path}/{kind}"):
                if int(folder.rsplit("=", 1)[1]) < oldest_kept:
                    paths.remove(self.spark, folder)
