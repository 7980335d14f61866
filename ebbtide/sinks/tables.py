"""Parquet tables with upsert, history and maintenance.

Layout: `data/version=N/<partition folders>` holds what commit N wrote, `commits` one row per
commit and partition. A partition is read from the newest commit that names it, so a commit
becomes visible at once when its rows are written, readers never see half a write, and earlier
moments stay readable. One writer at a time is assumed. With a lakehouse format on the cluster
the same calls map to MERGE INTO and its snapshots.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.merge import merge_events
from ..session import cut_lineage
from ..sources.paths import exists, size_in_bytes
from .writers import gathered

TARGET_BYTES = 128 * 1024 * 1024


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partitions: Sequence[str]):
        self.spark, self.path, self.schema, self.partitions = spark, path.rstrip("/"), schema, list(partitions)
        keys = [f for f in schema.fields if f.name in self.partitions]
        self._commit_schema = T.StructType([
            T.StructField("version", T.IntegerType()), T.StructField("committed_at", T.TimestampType()),
            T.StructField("batch", T.StringType()), T.StructField("rows", T.LongType()), *keys,
        ])

    def commits(self) -> DataFrame:
        """One row per commit and partition it wrote."""
        folder = f"{self.path}/commits"
        if not exists(self.spark, folder):
            return self.spark.createDataFrame([], self._commit_schema)
        return self.spark.read.schema(self._commit_schema).parquet(folder)

    def _live(self, at: dt.datetime | None = None) -> DataFrame:
        """Newest commit per partition, as of a moment."""
        known = self.commits() if at is None else self.commits().where(F.col("committed_at") <= F.lit(at))
        return known.groupBy(*self.partitions).agg(F.max(F.struct("version", "rows")).alias("c")).select(
            *self.partitions, F.col("c.version").alias("version"), F.col("c.rows").alias("rows")
        )

    def folders(self, at: dt.datetime | None = None, only: Sequence[tuple] | None = None) -> list[str]:
        """The folders that hold the table's partitions: one entry per partition, not per row."""
        wanted = None if only is None else set(only)
        folders = []
        for row in self._live(at).where(F.col("rows") > 0).collect():
            values = tuple(row[c] for c in self.partitions)
            if wanted is None or values in wanted:
                folders.append(self._folder(row["version"], values))
        return folders

    def _folder(self, version: int, values: Sequence) -> str:
        """Where Spark's writer puts a partition; it names NULL and escapes special characters in its own way."""
        names = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        place = "/".join(
            names.getPartitionPathString(c, None if v is None else str(v)) for c, v in zip(self.partitions, values)
        )
        return f"{self.path}/data/version={version}/{place}"

    def read(self, at: dt.datetime | None = None, only: Sequence[tuple] | None = None) -> DataFrame:
        """The table now or at a moment, or only some of its partitions."""
        folders = self.folders(at, only)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        found = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(*folders)
        return found.select(*self.schema.fieldNames())

    def has_batch(self, batch: str) -> bool:
        return not self.commits().where(F.col("batch") == batch).limit(1).isEmpty()

    def commit(self, rows: DataFrame, touched: Sequence[tuple], at: dt.datetime, batch: str | None = None, clustered_already: bool = False) -> int:
        """Write `rows` as the new content of the touched partitions; a partition without rows becomes empty."""
        version = (self.commits().agg(F.max("version")).first()[0] or 0) + 1
        target = f"{self.path}/data/version={version}"
        (rows if clustered_already else gathered(rows, self.partitions)).write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "snappy").partitionBy(
            *self.partitions).parquet(target)
        # Counting what was written reads file footers only.
        written = self.spark.read.schema(self.schema).parquet(target).groupBy(*self.partitions).agg(F.count(F.lit(1)).alias("rows"))
        kinds = T.StructType([f for f in self._commit_schema.fields if f.name in self.partitions])
        listed = self.spark.createDataFrame([tuple(t) for t in touched], kinds)
        same = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"w.{c}")) for c in self.partitions])
        record = listed.alias("l").join(written.alias("w"), same, "left").select(
            F.lit(version).alias("version"), F.lit(at).cast("timestamp").alias("committed_at"), F.lit(batch).cast("string").alias("batch"),
            F.coalesce("w.rows", F.lit(0)).alias("rows"), *[F.col(f"l.{c}") for c in self.partitions],
        )
        record.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return version

    def _partitions_of(self, df: DataFrame) -> set[tuple]:
        """Distinct partition values; bounded by the number of partitions."""
        return {tuple(row) for row in df.select(*self.partitions).distinct().collect()}

    def upsert(
        self, incoming: DataFrame, key: str, version_column: str, at: dt.datetime, batch: str | None = None,
        keys_may_move: bool = True, stored: bool = False,
    ) -> int | None:
        """Merge rows by key; only partitions that hold a touched key, before or after, are rewritten.

        A key whose partition has changed is found by its key in the whole table (a scan of one
        column), so it cannot end up in two partitions. Where a key's partition never changes,
        `keys_may_move=False` leaves that scan out and reads the incoming partitions only. A batch
        that was committed already is skipped.
        """
        if batch is not None and self.has_batch(batch):
            return None
        rows = incoming.select(*self.schema.fieldNames())
        rows = rows if stored else cut_lineage(rows, "incoming")
        touched = self._partitions_of(rows)
        if not touched:
            return None
        if keys_may_move:
            held = self.read().select(key, *self.partitions).join(rows.select(key).distinct(), key, "left_semi")
            touched |= self._partitions_of(held)
        merged = merge_events(self.read(only=list(touched)), rows, key, version_column)
        return self.commit(merged, sorted(touched, key=repr), at, batch)

    def compact(self, sort: Sequence[str], at: dt.datetime, target_bytes: int = TARGET_BYTES) -> int | None:
        """Rewrite all live partitions into files of about `target_bytes`, sorted; content is unchanged.

        A partition that fits into a file is one file.
        """
        live = sorted((tuple(row[c] for c in (*self.partitions, "version")) for row in self._live().where(F.col("rows") > 0).collect()), key=repr)
        if not live:
            return None
        # Sized by what is read now: older versions and the list of commits do not count.
        sizes = {tuple(values): size_in_bytes(self.spark, self._folder(version, values)) for *values, version in live}
        large = [values for values, size in sizes.items() if size > target_bytes]
        placed = clustered(self.read(), self.partitions, sort, sum(sizes.values()), target_bytes, large)
        return self.commit(placed, list(sizes), at, clustered_already=True)


def clustered(
    df: DataFrame, partitions: Sequence[str], sort: Sequence[str], size: int, target_bytes: int = TARGET_BYTES, large: Sequence[tuple] = (),
) -> DataFrame:
    """Range-partitioned and sorted rows, as many tasks as files of the target size fit into `size` bytes.

    Only the partitions named in `large` are cut along the sort columns: any other lies in one task and becomes one file.
    """
    files = max(1, -(-size // target_bytes))
    order = [F.col(c) for c in (*partitions, *sort)]
    cuts = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(partitions, values)]) for values in large]
    cut = reduce(lambda a, b: a | b, cuts) if cuts else F.lit(False)
    ranges = [*(F.col(c) for c in partitions), *(F.when(cut, F.col(c)) for c in sort if cuts)]
    return df.repartitionByRange(int(files), *ranges).sortWithinPartitions(*order)


def expirable_versions(commits: DataFrame, as_of: Column, max_age_days: int = 7, keep: int = 10) -> DataFrame:
    """Versions that are old, not among the newest `keep`, and not needed by the present table.

    Deleting them is left to the caller.
    """
    versions = commits.groupBy("version").agg(F.max("committed_at").alias("committed_at"))
    newest = versions.orderBy(F.desc("version")).limit(keep)
    oldest_kept = newest.agg(F.min("version")).scalar()
    old = F.col("committed_at") < as_of - F.make_dt_interval(days=F.lit(max_age_days))
    return versions.where(old & (F.col("version") < oldest_kept)).select("version", "committed_at")


def unreferenced(expirable: DataFrame, commits: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Expirable versions from which no partition is read any more."""
    live = commits.groupBy(*partitions).agg(F.max("version").alias("version")).select("version").distinct()
    return expirable.join(live, "version", "left_anti")


# Days after which data moves to the next storage tier.
TIERS = [("cold", 90), ("archive", 365), ("delete", 2555)]


def partition_age_report(partitions: DataFrame, as_of: Column, date: str = "date", tiers: Sequence[tuple[str, int]] = tuple(TIERS)) -> DataFrame:
    """Age in days and storage tier of each partition."""
    age = F.datediff(F.to_date(as_of), F.col(date))
    tier = reduce(lambda found, t: F.when(F.col("age_days") >= t[1], t[0]).otherwise(found), tiers, F.lit("hot"))
    return partitions.withColumn("age_days", age).withColumn("tier", tier)
