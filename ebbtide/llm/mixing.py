"""Mixing sources to target weights by pivotal rounding of copy counts over a tree of blocks.

Every document of a source is to be copied target / source_size times. The whole part is certain; the fraction is settled by
the pivotal method: two documents meet, mass moves at random from one to the other until one has 0 or 1, the other goes on.
Documents of a source are put in order of size and cut into blocks, so that mass moves between documents of like length; what
is left of a block is one document with a fraction, and these meet in blocks of the next level, until a source has one left.
Expected copies are exact and each source's copies differ from their sum by less than one. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.running import dense_index, running

from .common import Scratch, session

WEIGHTS, MOST_COPIES = (5.0, 2.0, 1.0), 3
BLOCK = 128
SEED = 20260

NEAR = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, tables: Scratch, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Per source: source_size, target.

    Sources in code-point order, null last, weigh `weights` in turn and share the sum of all sizes. A target stops at `most`
    times its source's size; what exceeds it goes to the others by weight. So targets are min(cap, level * weight) with the
    level at which they sum up; it only rises from round to round, and a round is one aggregate.
    """
    sums = tables.write(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sums")
    places = dense_index(sums, "source", "place")
    weighted = sums.join(places, "source", "left").withColumn("place", F.coalesce("place", F.lit(places.count())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighted = tables.write(weighted.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * most).cast("double")), "weights")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, rounds = 0.0, -1
    while True:
        above = F.col("cap") <= F.lit(level) * F.col("weight")
        capped, open_weight, count = weighted.agg(
            F.sum(F.when(above, F.col("cap")).otherwise(0.0)), F.sum(F.when(~above, F.col("weight")).otherwise(0.0)), F.count(F.when(above, True))
        ).first()
        if not open_weight or count == rounds:
            break
        rounds, level = count, (total - capped) / open_weight
    # Written once more: its known size lets the planner broadcast it where it is small.
    target = F.least(F.col("cap"), F.lit(level) * F.col("weight"))
    return tables.write(weighted.select("source", "source_size", target.alias("target")), "targets")


def _uniform(a: Column, b: Column, level: int) -> Column:
    """Between 0 and 1 from the two documents that meet; the same in every run."""
    return F.shiftrightunsigned(F.xxhash64(a, b, F.lit(SEED + level)), 11).cast("double") / F.lit(float(1 << 53))


def _meet(units: Column, level: int) -> Column:
    """Pivotal rounding along an array of (size, h, row, p): the rows that got 1, and the one left with its fraction."""
    unit = "struct<size:bigint,h:bigint,row:bigint,p:double>"
    start = F.struct(
        F.lit(None).cast(unit).alias("left"), F.array().cast("array<bigint>").alias("ones")
    )

    def step(state, x):
        y = state["left"]
        total = y["p"] + x["p"]
        draw = _uniform(y["h"], x["h"], level)
        below = total < 1
        # Below 1 one of the two takes all the mass; from 1 on one of them becomes 1 and the other keeps the rest.
        x_goes_on = F.when(below, draw * total < x["p"]).otherwise(draw * (2 - total) < 1 - x["p"])
        rest = F.when(below, total).otherwise(total - 1)
        on, out = F.when(x_goes_on, x).otherwise(y), F.when(x_goes_on, y["row"]).otherwise(x["row"])
        left = F.struct(on["size"].alias("size"), on["h"].alias("h"), on["row"].alias("row"), rest.alias("p"))
        ones = F.when(below, state["ones"]).otherwise(F.concat(state["ones"], F.array(out)))
        first = y.isNull() | (y["p"] < NEAR)
        return F.struct(F.when(first, x).otherwise(left).alias("left"), F.when(first, state["ones"]).otherwise(ones).alias("ones"))

    return F.aggregate(units, start, step)


def mix(rows: DataFrame, tables: Scratch, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """`rows` (row: unique long, key, source, size) with source_size, target, copies and taken = copies * size."""
    targets = source_targets(rows, tables, weights, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    same = F.col("t.source").eqNullSafe(F.col("r.source"))
    planned = rows.alias("r").join(targets.alias("t"), same, "left").select("r.*", "t.source_size", "t.target", ratio.alias("ratio"))
    whole = F.floor(F.col("ratio") + NEAR)
    planned = planned.withColumn("whole", whole).withColumn("p", F.greatest(F.col("ratio") - whole, F.lit(0.0)))
    units = planned.filter(f"p >= {NEAR} AND size > 0").select("source", "size", F.xxhash64("key", "size", F.lit(SEED)).alias("h"), "row", "p")

    # Documents of a source in order of size, cut into blocks; later levels put neighbouring blocks together.
    placed = running(tables.write(units, "units"), ["source"], [F.col(c) for c in ("size", "h", "row")], {"place": ("sum", F.lit(1))})
    units = placed.withColumn("block", F.expr(f"(place - 1) div {BLOCK}")).drop("place")
    picked, level = [], 0
    while True:
        met = units.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("size", "h", "row", "p"))).alias("units"))
        met = tables.write(met.select("source", "block", _meet(F.col("units"), level).alias("met")), f"met{level}")
        picked.append(met.select(F.explode("met.ones").alias("row")))
        units = met.select("source", "met.left.*", "block").filter(f"p >= {NEAR}")
        if (met.agg(F.max("block")).first()[0] or 0) == 0:
            break
        units = units.withColumn("block", F.expr(f"block div {BLOCK}"))
        level += 1
    # One document per source has a fraction left: drawn by itself.
    picked.append(units.filter((_uniform(F.col("h"), F.lit(0), level + 1) < F.col("p")) | (F.col("p") > 1 - NEAR)).select("row"))
    chosen = picked[0]
    for more in picked[1:]:
        chosen = chosen.unionAll(more)
    chosen = chosen.withColumn("extra", F.lit(1))
    copies = F.col("whole") + F.coalesce("extra", F.lit(0))
    return (
        planned.join(chosen.hint("merge"), "row", "left")
        .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0).cast("long"))
        .select("row", "key", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mix_documents(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per input row: `key`, source, size, source_size, target, copies, taken.

    The size is the number of words (a null text has none; such documents are not copied). Null is a source of its own, the
    last. No document is copied more than `most` times. Draws come from key and size, so a second run gives the same rows;
    of rows with the same key and size any may be chosen. A null key is a key like any other. An empty table gives no rows.
    Other columns are not read.
    """
    spark = session(docs.sparkSession)
    tables = Scratch(spark, "mixing")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size")
    )
    return mix(tables.write(rows, "rows"), tables, weights, most).drop("row").withColumnRenamed("key", key)


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The mix itself: each row of `docs`, with all its columns, as often as it is copied. Cases as in `mix_documents`."""
    spark = session(docs.sparkSession)
    tables = Scratch(spark, "mixing")
    # The rows get their numbers when they are written; columns that clash with ours live inside a struct.
    whole = tables.write(docs.select(F.monotonically_increasing_id().alias("row"), word_count(F.col(f"`{text}`")).alias("size"), F.struct(*[f"`{c}`" for c in docs.columns]).alias("doc")), "documents")
    rows = whole.select("row", F.col("doc").getField(key).alias("key"), F.col("doc").getField(source).alias("source"), "size")
    copies = mix(rows, tables, weights, most).filter("copies > 0").select("row", "copies")
    return whole.join(copies, "row").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
