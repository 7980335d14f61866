"""Helpers shared by the text operators: batches of whole texts, scratch tables, word pattern."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.session import cut_lineage, prepare, scratch_dir

# The six white-space characters between words, as text and as a character class.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"

# Rows and bytes per Arrow batch: a batch of long texts must fit into a task's share of memory.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20

TEXT = "__text"


def session(spark: SparkSession) -> SparkSession:
    """Options that the operators of this folder rely on."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/labels.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/embeddings.parquet")


def unused(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_texts(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    outputs: Sequence[tuple[str, T.DataType]],
    make: Callable[[], Callable[[list], list[Sequence]]],
    empty: str | bytes = "",
) -> DataFrame:
    """Columns `keep` plus `outputs`, computed from whole texts in batches.

    `make()` runs once per task and returns a function from a list of texts to one list per output column. A null text
    counts as empty. A kept column with the name of an output is replaced by it.
    """
    session(df.sparkSession)
    names = {n for n, _ in outputs}
    kept = [c for c in keep if c not in names]
    # A kept text travels once.
    source = df.select(*[F.col(f"`{c}`") for c in kept], *([] if text in kept else [F.col(f"`{text}`").alias(TEXT)]))
    at = kept.index(text) if text in kept else len(kept)
    schema = T.StructType([*source.schema.fields[: len(kept)], *[T.StructField(n, t, True) for n, t in outputs]])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with only_used():
            work = make()
        for batch in batches:
            columns = work([empty if t is None else t for t in batch.column(at).to_pylist()])
            arrays = [batch.column(i).cast(arrow.field(i).type) for i in range(len(kept))]
            arrays += [pa.array(c, type=arrow.field(len(kept) + i).type) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return source.mapInArrow(run, schema)


_KEPT: dict = {}
_USED: set = set()


def per_process(key: tuple, build: Callable):
    """What `build` makes, once per worker process: later tasks of the process find what earlier ones learned."""
    _USED.add(key)
    if key not in _KEPT:
        for other in [k for k in _KEPT if k[0] == key[0]]:
            del _KEPT[other]
        _KEPT[key] = build()
    return _KEPT[key]


@contextmanager
def only_used() -> Iterator[None]:
    """Whatever the process keeps that is not asked for inside is let go: the tables of one operator are held at a time."""
    _USED.clear()
    yield
    for key in [k for k in _KEPT if k not in _USED]:
        del _KEPT[key]


class Scratch:
    """Tables of one run in the shared folder; `drop` removes those that are no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def write(self, df: DataFrame, step: str) -> DataFrame:
        """Written and read back: lineage ends here, so lost executors cost no earlier work."""
        path = scratch_dir(self.spark, f"{self.name}-{step}")
        df.write.mode("errorifexists").parquet(path)
        self.paths[step] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *steps: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for step in steps:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(step))
            path.getFileSystem(conf).delete(path, True)


__all__ = ["BATCH_ROWS", "SPACES", "SPACE_CLASS", "Scratch", "cut_lineage", "documents", "embeddings", "labels", "map_texts", "only_used", "per_process", "session", "unused"]
