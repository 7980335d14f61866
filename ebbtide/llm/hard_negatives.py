"""Hard negatives of anchor vectors by Four-Russians scoring.

Components become integers. A candidate travels as bit planes, eight dimensions to a byte. For each eight dimensions of the
anchors all 256 subset sums are tabled once; a plane's byte looks its sum up, and planes are shifted and added, which gives
the exact inner product. Anchors come in blocks of bounded size, candidates in slices of bounded size, and every block meets
every slice in a task of its own: a stated set of queries against all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, session

# Anchors of a block, candidates of a slice: a task holds one of each. Rows and anchors scored at once (memory caches).
ANCHORS, CANDIDATES, ROWS_AT_ONCE, ANCHORS_AT_ONCE = 2048, 16384, 256, 512

# 100 times a score has to fit into 64 bits.
LARGEST = 1 << 56


def integers(vector: Column, scale: float) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def takes_part(vector: Column, label: Column) -> Column:
    """Whether label and vector are there and all components are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return label.isNotNull() & vector.isNotNull() & F.coalesce(fine, F.lit(False))


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Lists as rows of a matrix; shorter ones end in zeros."""
    out = np.zeros((len(lists), dims), np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.values.to_numpy(zero_copy_only=False)[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
    out[np.repeat(np.arange(len(lists)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def pack(rows: DataFrame, dims: int, bits: int) -> DataFrame:
    """Column `v` of integers as `planes`: two's complement, lowest plane first, a byte for eight dimensions."""
    groups = -(-dims // 8)
    schema = T.StructType([f for f in rows.schema.fields if f.name != "v"] + [T.StructField("planes", T.BinaryType())])
    at = rows.columns.index("v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = _matrix(batch.column(at), groups * 8)
                planes = [np.packbits((values >> j & 1).astype(np.uint8), axis=1, bitorder="little") for j in range(bits)]
                packed = np.stack(planes, 1).reshape(len(values), -1)
                kept = [batch.column(i) for i in range(batch.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([*kept, pa.array([r.tobytes() for r in packed], pa.binary())], names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Tables of (eight dimensions, byte, anchor): the sum of the components whose bit is set."""
    n, dims = anchors.shape
    tables = np.zeros((dims // 8, 256, n), anchors.dtype)
    for i in range(8):
        tables[:, 1 << i : 2 << i] = tables[:, : 1 << i] + anchors.T.reshape(dims // 8, 8, n)[:, i, None, :]
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products (candidate, anchor) of packed candidates (candidate, plane, byte): look up, shift and add."""
    n, bits, groups = planes.shape
    total = np.zeros((n, tables.shape[2]), tables.dtype)
    found = np.empty_like(total)
    for j in reversed(range(bits)):
        total <<= 1
        for g in range(groups):
            np.take(tables[g], planes[:, j, g], axis=0, out=found, mode="clip")
            if j == bits - 1:  # the sign's plane
                total -= found
            else:
                total += found
    return total


class Best:
    """The k highest scores per query; candidates come in the order that breaks ties, so an equal one never displaces."""

    def __init__(self, queries: int, k: int, least: int):
        self.k, self.kth = k, np.full(queries, least, np.int64)
        self.query = self.score = self.row = np.zeros(0, np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        if not len(query):
            return
        query, score, row = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.row, row)))
        order = np.lexsort((row, -score, query))
        query, score, row = query[order], score[order], row[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        self.kth[query[place == self.k - 1]] = score[place == self.k - 1]
        self.query, self.score, self.row = (x[place < self.k] for x in (query, score, row))


def _slices(tables_of, planes: np.ndarray, anchors: np.ndarray):
    """Scores of bounded pieces: (first row, first anchor, matrix)."""
    for a in range(0, len(anchors), ANCHORS_AT_ONCE):
        tables = tables_of(anchors[a : a + ANCHORS_AT_ONCE])
        for r in range(0, len(planes), ROWS_AT_ONCE):
            yield r, a, scores(tables, planes[r : r + ROWS_AT_ONCE])


def _meet(rows: DataFrame, anchors: DataFrame, dims: int, bits: int, tasks: int, outputs: list[str], work) -> DataFrame:
    """`work(candidates, planes, anchors, matrix, kind)` for every slice of rows and block of anchors."""
    groups = -(-dims // 8)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table(outputs, [[]] * len(outputs))
        left = left.sort_by([("id", "ascending"), ("uid", "ascending")])  # null ids last
        planes = np.frombuffer(b"".join(left["planes"].to_pylist()), np.uint8).reshape(left.num_rows, bits, groups)
        matrix = _matrix(right["v"].combine_chunks(), groups * 8)
        widest = int(np.abs(matrix).sum(1).max(initial=0)) << bits
        kind = np.int32 if widest < 2**31 else np.int64
        return work(left, planes, right, matrix.astype(kind), lambda m: subset_sums(m))

    schema = T.StructType([T.StructField(n, T.LongType()) for n in outputs])
    dealt = [x.repartition(tasks, "block", "slice") for x in (rows, anchors)]
    return dealt[0].groupBy("block", "slice").cogroup(dealt[1].groupBy("block", "slice")).applyInArrow(run, schema)


POSITIVE, NEGATIVE = ["anchor_uid", "uid", "id", "score"], ["anchor_uid", "positive", "uid", "id", "score"]


def _table(names: list[str], columns: list) -> pa.Table:
    return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, pa.int64()) for c in columns], names=names)


def _positives(k: int):
    def work(left, planes, right, anchors, tables_of):
        labels, own = left["label"].to_numpy(), left["uid"].to_numpy()
        wanted, uids = right["label"].to_numpy(), right["uid"].to_numpy()
        best = Best(len(anchors), k, np.iinfo(np.int64).min)
        for label in np.unique(wanted):
            rows, mine = np.flatnonzero(labels == label), np.flatnonzero(wanted == label)
            for r, a, found in _slices(tables_of, planes[rows], anchors[mine]):
                query = mine[a : a + found.shape[1]]
                i, q = np.nonzero((found > best.kth[query]) & (own[rows[r : r + len(found)], None] != uids[query]))
                best.add(query[q], found[i, q].astype(np.int64), rows[r + i])
        row = pa.array(best.row)
        return _table(POSITIVE, [uids[best.query], left["uid"].take(row), left["id"].take(row), best.score])

    return work


def _negatives(k: int, low: int, high: int):
    def work(left, planes, right, anchors, tables_of):
        labels, own, uids = left["label"].to_numpy(), right["label"].to_numpy(), right["uid"].to_numpy()
        listed = right["positives"].combine_chunks()
        sizes = np.diff(listed.offsets.to_numpy())
        positives = np.zeros((len(anchors), max(1, sizes.max(initial=0))), np.int64)
        positives[np.repeat(np.arange(len(anchors)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = listed.flatten().to_numpy()
        best = [Best(len(anchors), k, np.iinfo(np.int64).min) for _ in range(positives.shape[1])]
        for r, a, found in _slices(tables_of, planes, anchors):
            query = np.arange(a, a + found.shape[1])
            other = labels[r : r + len(found), None] != own[query]
            for p, kept in enumerate(best):
                least, most = -(-low * positives[query, p] // 100), high * positives[query, p] // 100
                least = np.maximum(least, np.where(kept.kth[query] == np.iinfo(np.int64).min, least, kept.kth[query] + 1))
                i, q = np.nonzero((found >= least) & (found <= most) & other & (p < sizes[query]))
                kept.add(query[q], found[i, q].astype(np.int64), r + i)
        parts = []
        for p, kept in enumerate(best):
            row = pa.array(kept.row)
            parts.append(_table(NEGATIVE, [uids[kept.query], np.full(len(kept.row), p + 1), left["uid"].take(row), left["id"].take(row), kept.score]))
        return pa.concat_tables(parts)

    return work


def _first(df: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "uid")
    return df.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def hard_negatives(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | None = None,
    anchor: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor and positive.

    `label` (default: the column label) and `anchor` (default: key divisible by 100) are expressions of the input. A
    component x counts as floor(scale * x), a score is the integer inner product. Positives are an anchor's first
    `positives` other rows of its label, negatives the first `negatives` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score; higher scores come first, equal ones by smaller
    key (null last). Rows with a null label, a null vector or a component that is null or not finite take no part; a null
    key is never an anchor by default. A shorter vector counts as ending in zeros, an empty one scores 0. Repeated rows
    are rows of their own: a copy is another row, and equal anchors each give their rows. Empty input gives no rows;
    other columns are not read. Vectors whose scores could exceed 2^56 are refused with a ValueError.
    """
    spark = session(vectors.sparkSession)
    label = F.col("label") if label is None else label
    anchor = F.col(f"`{key}`") % 100 == 0 if anchor is None else anchor
    tables = Scratch(spark, "hard-negatives")
    rows = vectors.filter(takes_part(F.col(f"`{vector}`"), label)).select(
        F.monotonically_increasing_id().alias("uid"), F.col(f"`{key}`").cast("long").alias("id"), label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), integers(F.col(f"`{vector}`"), scale).alias("v"),
    )
    rows = tables.write(rows, "rows")  # fixes the row numbers
    size = F.coalesce(F.array_max(F.transform("v", lambda x: F.abs(x))), F.lit(0))
    found = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("a"), F.max(F.size("v")).alias("dims"), F.max(size).alias("size")).first()
    dims, size = max(1, found.dims or 0), max(1, found.size or 0)
    if dims * size * size >= LARGEST:
        raise ValueError("scores of these vectors may not fit into 64 bits")
    bits = size.bit_length() + 1
    blocks, slices = max(1, -(-found.a // ANCHORS)), max(1, -(-found.n // CANDIDATES))

    def numbered(df: DataFrame, name: str, n: int) -> DataFrame:
        return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

    packed = pack(rows.select("uid", "id", "label", "v"), dims, bits).withColumn("slice", F.pmod(F.xxhash64("uid"), F.lit(slices)).cast("int"))
    packed = numbered(packed, "block", blocks)
    anchors = rows.filter("anchor").select("uid", "id", "label", "v", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int").alias("block"))
    tasks = blocks * slices

    near = _meet(packed, numbered(anchors, "slice", slices), dims, bits, tasks, POSITIVE, _positives(positives))
    near = tables.write(_first(near, ["anchor_uid"], positives, "positive"), "positives")
    listed = near.groupBy("anchor_uid").agg(F.transform(F.array_sort(F.collect_list(F.struct("positive", "score"))), lambda x: x["score"]).alias("positives"))
    asked = anchors.join(listed, F.col("uid") == F.col("anchor_uid")).drop("anchor_uid")
    far = _meet(packed, numbered(asked, "slice", slices), dims, bits, tasks, NEGATIVE, _negatives(negatives, low, high))
    far = _first(far, ["anchor_uid", "positive"], negatives, "rank")

    names = anchors.select(F.col("uid").alias("anchor_uid"), F.col("id").alias("anchor_id"))
    pairs = near.select("anchor_uid", "positive", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(pairs, ["anchor_uid", "positive"]).join(names, "anchor_uid").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
