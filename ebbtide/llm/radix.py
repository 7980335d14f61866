"""Exact deduplication by most-significant-digit radix partitioning; equality is byte equality, no digest is compared.

Documents are split by their leading bytes, groups of several by the bytes that follow, and so on. A group ends when it is a
single document or when its texts have ended. Each round is one aggregation by (group, next bytes) and one join back, both
over all executors, so a group of any size is spread: copies collapse before the shuffle, and the join's skewed partitions
are split by adaptive execution. The number of bytes per round grows fourfold, so rounds grow with the logarithm of the
longest text among copies. The first bytes are enough to tell most documents apart behind a common head line. Joins that
move texts are merge joins at every size: their skewed partitions are split, and nothing has to fit into memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, Scratch, session

FIRST_BYTES, GROWTH = 256, 4

ROW, GROUP = "__row", "__group"


def normalised(text) -> F.Column:
    """Without the six white-space characters; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _bytes(body: str, start: int, length: int | None):
    return F.substring(body, start, length if length is not None else (1 << 31) - 1)


def _partition(source: DataFrame, tables: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows of `source` (__key, __text, any payload) with a row number, and the final group of each row that is not alone.

    Rows have __key, __chars, __sha, the payload and the group of their leading bytes; a row without one is alone from the
    start, and a row without a final group is alone in the end.
    """
    payload = [c for c in source.columns if c not in ("__key", "__text")]
    source = source.select(
        "__key", F.coalesce(F.char_length("__text"), F.lit(0)).alias("__chars"), F.encode(normalised(F.col("__text")), "UTF-8").alias("__body"), *payload
    ).withColumns({"__sha": F.sha2("__body", 256), "__digit": _bytes("__body", 1, FIRST_BYTES)})

    # Leading bytes that several documents share; all other documents are groups of their own.
    shared = tables.write(
        source.groupBy("__digit").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__digit", F.monotonically_increasing_id().alias(GROUP)),
        "digits",
    )
    rows = tables.write(
        source.join(shared.hint("merge"), "__digit", "left").select(
            F.monotonically_increasing_id().alias(ROW),
            "__key",
            "__chars",
            "__sha",
            *payload,
            GROUP,
            (F.octet_length("__digit") < FIRST_BYTES).alias("__ended"),
            F.when(F.col(GROUP).isNotNull(), _bytes("__body", FIRST_BYTES + 1, None)).alias("__rest"),
        ),
        "rows",
    )
    tables.drop("digits")

    # Rows whose group is settled: their texts have ended together.
    settled = rows.filter(F.col(GROUP).isNotNull() & F.col("__ended")).select(ROW, F.concat_ws(":", F.lit(0), GROUP).alias(GROUP))
    open_rows = rows.filter(F.col(GROUP).isNotNull() & ~F.col("__ended")).select(ROW, GROUP, "__rest")
    size, step = FIRST_BYTES * GROWTH, 1
    while open_rows.limit(1).count():
        split = open_rows.select(ROW, GROUP, _bytes("__rest", 1, size).alias("__digit"), _bytes("__rest", size + 1, None).alias("__rest"))
        groups = tables.write(
            split.groupBy(GROUP, "__digit").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(
                F.col(GROUP).alias("__from"), F.col("__digit").alias("__by"), F.monotonically_increasing_id().alias("__next")
            ),
            f"digits{step}",
        )
        ended = F.octet_length("__digit") < size
        joined = split.join(groups.hint("merge"), (F.col(GROUP) == F.col("__from")) & (F.col("__digit") == F.col("__by"))).select(
            ROW, F.col("__next").alias(GROUP), ended.alias("__ended"), F.when(~ended, F.col("__rest")).alias("__rest")
        )
        level = tables.write(joined, f"level{step}")
        settled = settled.unionByName(level.filter("__ended").select(ROW, F.concat_ws(":", F.lit(step), GROUP).alias(GROUP)))
        open_rows = level.filter("NOT __ended").select(ROW, GROUP, "__rest")
        tables.drop(f"digits{step}")
        size, step = size * GROWTH, step + 1
    return rows, settled


def _chosen(own: DataFrame) -> DataFrame:
    """Per group, from rows (group, __key, __chars, row): the row that stays, its key, and the group's size."""
    best = F.min(F.struct((-F.col("__chars")).alias("a"), F.col("__key").isNull().alias("b"), F.col("__key").alias("c"), F.col(ROW).alias("d")))
    chosen = own.groupBy(GROUP).agg(best.alias("__best"), F.count(F.lit(1)).alias("__n"))
    return chosen.select(F.col(GROUP), F.col("__best.c").alias("__keep"), F.col("__best.d").alias("__keep_row"), "__n")


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: `key`, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space (a null text is empty). Of equal texts the row with the
    most code points stays, then the smallest key (null last), then any one of identical rows; keep_id is its key.
    text_sha256 is of the normalised text and only reported. An empty table gives no rows; other columns are not read.
    """
    spark = session(docs.sparkSession)
    rows, settled = _partition(docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text")), Scratch(spark, "radix"))
    own = rows.select(ROW, "__key", "__chars", "__sha").join(settled, ROW, "left")
    single = F.col(GROUP).isNull()
    # A row that is alone gets a group of its own name, so that nulls do not meet in one task.
    own = own.withColumn("__at", F.coalesce(GROUP, F.concat_ws(":", F.lit("r"), ROW)))
    chosen = _chosen(own.filter(~single)).withColumnRenamed(GROUP, "__at")
    return own.join(chosen, "__at", "left").select(
        F.col("__key").alias(key),
        F.when(single, F.col("__key")).otherwise(F.col("__keep")).alias("keep_id"),
        F.coalesce("__n", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col(ROW) == F.col("__keep_row"))).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stay, with all their columns; cases as in `exact_groups`."""
    spark = session(docs.sparkSession)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")
    rows, settled = _partition(docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"), whole), Scratch(spark, "radix"))
    grouped = rows.select(ROW, "__key", "__chars").join(settled, ROW)
    dropped = grouped.join(_chosen(grouped), GROUP).filter(F.col(ROW) != F.col("__keep_row")).select(ROW)
    # Rows alone by their leading bytes are not moved again.
    alone = rows.filter(F.col(GROUP).isNull()).select("__doc.*")
    return alone.unionByName(rows.filter(F.col(GROUP).isNotNull()).join(dropped.hint("merge"), ROW, "left_anti").select("__doc.*"))
