"""Near-duplicates by SimHash: fingerprints in one pass, links through a Gray-order hierarchical index, components.

Two fingerprints within two differing bits agree on at least one of three blocks of bits. So every fingerprint goes to three
groups, one per block: the block is the uppermost node of the index, and the index of a group holds the other bits. A group
with too many members is divided once more by the same argument on the bits that are left, and those groups again; then 19
or 20 bits are free, which bounds a group by about a million fingerprints whatever the table holds. Equal fingerprints are one
member. From a group come the links of a spanning forest, not its pairs.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, map_texts, session, unused
from .components import connected_components
from .gray_index import Forest, gray_rank, near_pairs

SHINGLE_WORDS, MOST_BITS, SEED = 3, 2, 42
# Groups up to this size are searched as they are, larger ones are divided; the links are the same either way.
GROUP_ROWS = 20_000
# Rows that a task gathers before it builds indexes for whole groups.
GATHER_ROWS = 200_000

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str, width: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash, unsigned: A-Z in lower case, shingles of `width` words with repeats, majority of their XXH64 bits."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest, total, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(words) - width + 1
    for at in range(0, n, 255 * 256):
        stop = min(at + 255 * 256, n)
        hashes = [digest(joined[s : e - 1], SEED) for s, e in zip(starts[at:stop], ends[at + width - 1 : stop + width - 1])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        if whole:
            total += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        if whole < len(bits):
            total += bits[whole:].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, out: str = "fp") -> DataFrame:
    """Columns `keep` (all by default) and `out`, the fingerprint as a signed long; null and empty texts have 0."""

    def make():
        return lambda texts: [np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)]

    return map_texts(docs, text, docs.columns if keep is None else keep, [(out, T.LongType())], make)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _thirds(mask: int) -> list[int]:
    """Masks that fix one third of the free bits more."""
    free = [b for b in range(64) if not mask >> b & 1]
    cut = [free[: len(free) // 3], free[len(free) // 3 : 2 * len(free) // 3], free[2 * len(free) // 3 :]]
    return [mask | sum(1 << b for b in part) for part in cut]


def _links(batches):
    """Links of a spanning forest per group, from rows sorted by group; a group's last rows wait for the next batch."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def search(mask, key, fp):
        starts = np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])]
        group = np.cumsum(starts) - 1
        several = (np.bincount(group) > 1)[group]
        group, fp = group[several], fp[several]
        if not len(fp):
            return None
        group = np.unique(group, return_inverse=True)[1]
        codes = fp.view(np.uint64)
        order = np.lexsort((gray_rank(codes), group))
        codes, group = codes[order], group[order]
        forest, links = Forest(len(codes)), []
        for left, right in near_pairs(codes, group, MOST_BITS):
            links += [(i, j) for i, j in zip(left.tolist(), right.tolist()) if forest.join(i, j)]
        if not links:
            return None
        found = codes.view(np.int64)[np.array(links)]
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], schema=schema)

    def gathered():
        return [np.concatenate(c) for c in zip(*held)]

    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "fp")))
        if sum(len(h[0]) for h in held) >= GATHER_ROWS:
            mask, key, fp = gathered()
            open_from = int(np.flatnonzero((mask != mask[-1]) | (key != key[-1]))[-1]) + 1 if (mask[0], key[0]) != (mask[-1], key[-1]) else 0
            held = [(mask[open_from:], key[open_from:], fp[open_from:])]
            if open_from and (out := search(mask[:open_from], key[:open_from], fp[:open_from])):
                yield out
    if held and (out := search(*gathered())):
        yield out


def fingerprint_links(prints: DataFrame, tables: Scratch) -> DataFrame:
    """(a, b): enough links between the distinct fingerprints of column `fp` to connect all that are linked."""
    refine = {m: _thirds(m) for m in _thirds(0)}
    refine |= {m: _thirds(m) for ms in list(refine.values()) for m in ms}

    def exploded(df, masks):
        return df.select("fp", F.explode(masks).alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))

    def array(masks):
        return F.array(*[F.lit(_signed(m)).cast("long") for m in masks])

    def finer(of):
        """The finer masks of a row's mask, as a lookup over the masks of that level."""
        return F.create_map(*[x for m in of for x in (F.lit(_signed(m)).cast("long"), array(refine[m]))])[F.col("mask")]

    level = exploded(prints.select("fp"), array(_thirds(0)))
    parts = []
    masks = _thirds(0)
    for _ in range(2):
        crowded = tables.write(level.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP_ROWS).select("mask", "key"), f"crowded{len(parts)}")
        parts.append(level.join(crowded, ["mask", "key"], "left_anti").select("mask", "key", "fp"))
        level = exploded(level.join(crowded, ["mask", "key"], "left_semi"), finer(masks))
        masks = [f for m in masks for f in refine[m]]
    groups = parts[0].unionByName(parts[1]).unionByName(level.select("mask", "key", "fp"))
    return groups.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(_links, "a long, b long")


def components_of_prints(prints: DataFrame, tables: Scratch) -> DataFrame:
    """(fp, label) for every distinct fingerprint of column `fp`: equal labels are linked."""
    distinct = tables.write(prints.select("fp").distinct(), "distinct")
    labels = connected_components(fingerprint_links(distinct, tables), tables)
    found = distinct.join(labels.select(F.col("node").alias("fp"), "label"), "fp", "left")
    return found.withColumn("label", F.coalesce("label", "fp"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: `key`, fp (signed long), component_id: the smallest key of all documents that can be reached.

    Documents link when their fingerprints differ in at most two bits. Null texts and texts without words have fingerprint
    0 and link like any other. Repeated rows each give a row. Null keys are ignored for component_id, which is null where a
    component has no other. An empty table gives no rows. Other columns are not read.
    """
    spark = session(docs.sparkSession)
    tables = Scratch(spark, "simhash")
    prints = tables.write(fingerprints(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), keep=["key"]), "prints")
    labelled = prints.groupBy("fp").agg(F.min("key").alias("first")).join(components_of_prints(prints, tables), "fp")
    labelled = tables.write(labelled, "labelled")
    first = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    by_print = labelled.select("fp", "label").join(first, "label").select("fp", "component_id")
    return prints.join(by_print, "fp").select(F.col("key").alias(key), "fp", "component_id")


def near_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each component, with all its columns: that of the smallest key (null last), any of several such rows."""
    spark = session(docs.sparkSession)
    tables = Scratch(spark, "simhash")
    row, fp = unused(docs, "row"), unused(docs, "fp")
    whole = tables.write(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    # Only numbers come back from Python; other columns stay where they are.
    printed = tables.write(fingerprints(whole, text, keep=[key, row], out=fp), "prints")
    prints = printed.select(F.col(f"`{fp}`").alias("fp"), F.struct(F.col(f"`{key}`").isNull().alias("a"), F.col(f"`{key}`").alias("b"), F.col(f"`{row}`").alias("c")).alias("at"))
    labels = components_of_prints(prints, tables)
    best = prints.groupBy("fp").agg(F.min("at").alias("at")).join(labels, "fp").groupBy("label").agg(F.min("at").alias("at"))
    staying = tables.write(best.select(F.col("at.c").alias(row)), "staying")
    return whole.join(staying.hint("merge"), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
