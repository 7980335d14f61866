"""Session settings the operators rely on, and where intermediate tables may be written."""

from __future__ import annotations

import math
import os
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime-settable options; everything else is left to the cluster's own defaults.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Times in files without a zone are UTC: read as such, filters on them reach the scan.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

SCRATCH_CONF = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime options to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "ebbtide", cores: int | str = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own.

    EBBTIDE_SCRATCH names the folder for intermediate tables where the environment has set none.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("EBBTIDE_DRIVER_MEMORY", "8g"))
    )
    if os.environ.get("EBBTIDE_SCRATCH"):
        builder = builder.config(SCRATCH_CONF, os.environ["EBBTIDE_SCRATCH"])
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


# Folders made inside `owned_scratch`, innermost owner last.
_OWNERS: list[list[str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder named by `spark.checkpoint.dir`, which has to be set."""
    shared = spark.conf.get(SCRATCH_CONF, None)
    if not shared:
        raise ValueError(f"set {SCRATCH_CONF} to a folder every executor can reach")
    path = f"{shared.rstrip('/')}/ebbtide/{name}-{uuid.uuid4().hex}"
    if _OWNERS:
        _OWNERS[-1].append(path)
    return path


@contextmanager
def owned_scratch(spark: SparkSession):
    """Removes the intermediate tables that are made inside, when it ends; nothing read later may depend on them."""
    _OWNERS.append([])
    try:
        yield
    finally:
        conf = spark._jsc.hadoopConfiguration()
        for path in _OWNERS.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def few_rows(df):
    """A result of a handful of rows, held by itself: it no longer depends on tables that its job removes."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


# How many rows are worth a task of their own in a step that costs much per row, and the most that one task gets.
LEAST_ROWS, MOST_ROWS = 2048, 1 << 20


def dealt(df):
    """The rows in even partitions for a step that costs much per row: as many as the session has cores, more for very many rows.

    Few bytes make few files and those few tasks, however long a row takes; small tables stay together.
    """
    rows = df.count()
    cores = min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / LEAST_ROWS))
    return df.repartition(max(1, cores, math.ceil(rows / MOST_ROWS)))


def cut_lineage(df, name: str):
    """Write `df` to the shared folder and read it back: survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
