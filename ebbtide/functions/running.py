"""Exact running totals, ranks and percentiles that never put one large key into one task.

A plain window over a key sends all rows of the key to one task. Here the rows are cut into bins
along (keys, ordering) by range partitioning, so that a key holding a third of all rows is spread
over about a third of the bins, whatever the type or shape of its values. The window runs inside
(bin, key); what earlier bins of the key add is a second window over at most `bins` rows per key.
Where the cuts fall affects speed only, never the result. The number of bins is the session's
number of shuffle partitions, which is sized with the cluster.

The cut rows are written to the shared folder once, since both windows read them and have to see the
same cuts. Nothing else is written: finding the cuts samples the input, which for a shuffled input
reads its shuffle files again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import cut_lineage

_AGGREGATE = {"sum": F.sum, "max": F.max, "min": F.min}
_COMBINE = {
    "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    "max": F.greatest,
    "min": F.least,
}


def binned(df: DataFrame, keys: Sequence[str], order: Sequence[Column], bins: int | None = None) -> DataFrame:
    """`df` cut along (keys, order), with the number of the cut in `_bin`, and stored."""
    bins = bins or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(bins, *[F.col(k) for k in keys], *order)
    return cut_lineage(ranged.withColumn("_bin", F.spark_partition_id()), "bins")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    totals: Mapping[str, tuple[str, Column]],
    inclusive: bool = True,
    bins: int | None = None,
    whole: Mapping[str, str] = {},
) -> DataFrame:
    """Add `totals` = {name: (sum|max|min, column)} accumulated along `order` inside `keys`.

    `whole` = {name: name of a total} adds the total over all rows of the key. Rows with equal order values are peers only
    if the caller made them one row; give a total order.
    """
    upto = W.currentRow if inclusive else -1
    cut = binned(df, keys, order, bins)
    group = [*keys, "_bin"]
    per_bin = cut.groupBy(*group).agg(
        *[_AGGREGATE[how](col).alias(f"_b_{name}") for name, (how, col) in totals.items()]
    )
    # At most `bins` rows per key, whatever the size of the input.
    across = W.partitionBy(*(keys or [F.lit(0)])).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(*(keys or [F.lit(0)]))
    before = per_bin.select(
        *group, *[_AGGREGATE[how](f"_b_{name}").over(across).alias(f"_b_{name}") for name, (how, _) in totals.items()],
        *[_AGGREGATE[totals[name][0]](f"_b_{name}").over(everything).alias(f"_w_{new}") for new, name in whole.items()],
    )
    inside = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, upto)
    local = cut.select(
        "*", *[_AGGREGATE[how](col).over(inside).alias(f"_l_{name}") for name, (how, col) in totals.items()]
    )
    same = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in group])
    joined = local.alias("l").join(before.alias("r"), same, "left")
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        *[_COMBINE[how](F.col(f"_l_{name}"), F.col(f"_b_{name}")).alias(name) for name, (how, _) in totals.items()],
        *[F.col(f"_w_{new}").alias(new) for new in whole],
    )


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    bins: int | None = None,
) -> DataFrame:
    """Linear-interpolation percentiles per key, from counts of distinct values.

    The built-in exact percentile keeps every distinct value of a group in one buffer; this form
    counts distinct values with partial aggregation and then looks ranks up, so no group has to
    fit into memory.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = running(counts, keys, [F.col("_v")], {"_upto": ("sum", F.col("_n"))}, bins=bins, whole={"_size": "_upto"})

    def at(rank: Column) -> Column:
        """The value at a zero-based rank."""
        return F.max(F.when((rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto")), F.col("_v")))

    picked, result = [], []
    for name, p in probabilities.items():
        spot = (F.col("_size") - 1) * F.lit(float(p))
        low, high = F.floor(spot), F.ceil(spot)
        picked += [at(low).alias(f"_lo_{name}"), at(high).alias(f"_hi_{name}"), F.max(spot - low).alias(f"_w_{name}")]
        result.append(
            (F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_w_{name}")).alias(name)
        )
    return ranked.groupBy(*keys).agg(*picked).select(*keys, *result)


def dense_index(df: DataFrame, column: str, name: str, bins: int | None = None) -> DataFrame:
    """Distinct values of a string column with their zero-based place in binary order."""
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_one", F.lit(1))
    numbered = running(distinct, [], [F.col(column)], {name: ("sum", F.col("_one"))}, bins=bins)
    return numbered.select(column, (F.col(name) - 1).cast("int").alias(name))
