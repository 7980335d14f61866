"""From feature snapshots to model inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import CATEGORICAL_FEATURES, CUSTOMER, LABEL, NUMERIC_FEATURES
from ..functions.running import dense_index, running
from ..session import cut_lineage

UNKNOWN = "unknown"


def fill_missing(df: DataFrame, numeric: Sequence[str] = tuple(NUMERIC_FEATURES), text: Sequence[str] = tuple(CATEGORICAL_FEATURES)) -> DataFrame:
    """No activity is zero activity; no category is the category 'unknown'."""
    changed = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric if c in df.columns}
    changed.update({c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in text if c in df.columns})
    return df.withColumns(changed)


def fit_encoder(train: DataFrame, column: str) -> DataFrame:
    """Category to number in sorted order, from the training rows; stored, like every fitted part."""
    return cut_lineage(dense_index(train, column, f"{column}_encoded"), f"encoder-{column}")


def encode(df: DataFrame, encoder: DataFrame, column: str) -> DataFrame:
    """Add `<column>_encoded`. Unseen values share the place of 'unknown', or the place after the last if there is none."""
    name = f"{column}_encoded"
    fallback = encoder.agg(
        F.coalesce(F.max(F.when(F.col(column) == UNKNOWN, F.col(name))), F.max(name) + 1, F.lit(0))
    ).scalar()
    return df.join(encoder, column, "left").withColumn(name, F.coalesce(F.col(name), fallback).cast("int")).select(*df.columns, name)


def fit_scaler(train: DataFrame, columns: Sequence[str] = tuple(NUMERIC_FEATURES)) -> DataFrame:
    """One stored row with mean and population deviation per column."""
    fitted = train.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    )
    return cut_lineage(fitted, "scaler")


def scale(df: DataFrame, scaler: DataFrame, columns: Sequence[str] = tuple(NUMERIC_FEATURES)) -> DataFrame:
    """Standardise; a constant column is only centred. The scaler's single row enters as a scalar subquery."""
    fitted = scaler.select(F.struct("*")).scalar()

    def scaled(c: str) -> Column:
        std = fitted.getField(f"std_{c}")
        return (F.col(c) - fitted.getField(f"mean_{c}")) / F.when(std == 0, F.lit(1.0)).otherwise(std)

    return df.withColumns({c: scaled(c) for c in columns})


def split_hash(key: Column, seed: int) -> Column:
    """60-bit number of a key, the same in every run and engine."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 15), 16, 10).cast("bigint")


def stratified_split(
    df: DataFrame, label: str = LABEL, key: str = CUSTOMER, test: float = 0.2, val: float = 0.1, seed: int = 42
) -> DataFrame:
    """Add `split` with exact shares per label: rows in hash order, cut at the shares.

    Only (label, hash, key) is ranked, in bins; the row at each of the two cuts gives a bound per
    label, and whole rows are compared with it where they are. Rows with the same label and key
    fall on the same side of a cut.
    """
    narrow = df.select(F.col(label).alias("_of"), split_hash(F.col(key), seed).alias("_hash"), F.col(key).alias("_key"))
    placed = running(narrow, ["_of"], [F.col("_hash"), F.col("_key")], {"_place": ("sum", F.lit(1))}, whole={"_size": "_place"})
    n_test = F.floor(F.col("_size") * F.lit(test) + 0.5)
    n_val = F.floor(F.col("_size") * F.lit(val) + 0.5)
    at = F.struct("_hash", "_key")
    cuts = placed.groupBy("_of").agg(
        F.max(F.when(F.col("_place") <= n_test, at)).alias("_test"), F.max(F.when(F.col("_place") <= n_test + n_val, at)).alias("_val")
    )
    row = F.struct(split_hash(F.col(key), seed).alias("_hash"), F.col(key).alias("_key"))
    split = F.when(row <= F.col("_test"), "test").when(row <= F.col("_val"), "validation").otherwise("train")
    return df.join(cuts, F.col(label).eqNullSafe(F.col("_of"))).select(*df.columns, split.alias("split"))


def hash_split(df: DataFrame, key: str = CUSTOMER, test: float = 0.2, val: float = 0.1, seed: int = 42) -> DataFrame:
    """Add `split` by the key's hash alone: no shuffle, shares only approximate, a customer never moves."""
    share = split_hash(F.col(key), seed) / F.lit(float(16**15))
    return df.withColumn("split", F.when(share < test, "test").when(share < test + val, "validation").otherwise("train"))


def split_summary(split: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows and churn rate per split."""
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.avg(F.col(label).cast("double")).alias("churn_rate"))


def model_columns() -> list[str]:
    """The model's inputs in order: scaled numerics, then encoded categories."""
    return [*NUMERIC_FEATURES, *[f"{c}_encoded" for c in CATEGORICAL_FEATURES]]


def prepare_inputs(df: DataFrame, scaler: DataFrame, encoders: dict[str, DataFrame]) -> DataFrame:
    """Fill, encode and scale rows with parts fitted on the training rows."""
    filled = fill_missing(df)
    for column, encoder in encoders.items():
        filled = encode(filled, encoder, column)
    return scale(filled, scaler)


def assemble(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add the `features` vector."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(columns or model_columns()), outputCol="features").transform(df)
