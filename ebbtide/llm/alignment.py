"""Tokens of two tokenizers side by side, cut into the smallest groups that cover the same bytes.

Divide and conquer at shared cuts: of an interval whose ends are shared, a common end near the middle is located by bisecting
the other side's ends, and both halves go on by themselves; an interval without a common end inside is a leaf, one group.
All intervals of a level are halved at once, over the texts of a whole batch: ends of texts are shared ends.

How often two ids end together is counted over the corpus. A batch carries its distinct pairs once, its documents refer to
them by number, so that the counts come back by one row per batch and pair, however often a pair occurs.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext
from tokenizers import Tokenizer

from .common import Scratch, only_used, per_process, session, unused
from .vocabulary import PIECES, byte_alphabet


class Pair:
    """Both tokenizers with the bytes of their tokens; special strings in a text are plain text."""

    def __init__(self, first: bytes, second: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.first = self._by_ranks(json.loads(first)) or self._by_library(first)
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        value = {c: b for b, c in enumerate(byte_alphabet())}
        names = {i: s for s, i in json.loads(first)["model"]["vocab"].items()}
        self.bytes_a = [bytes(value[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
        sp = self.second
        self.bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size())]
        if not all(self.bytes_b) or not all(self.bytes_a[i] for i in names):
            raise ValueError("a token without bytes")
        self.size_a, self.size_b = (np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        # Decimal ids with what follows them: another token of the group, or the end of the side.
        self.shown_a, self.shown_b = (np.array([f"{i}{mark}" for mark in (",", end) for i in range(len(table))], object) for table, end in ((self.bytes_a, "|"), (self.bytes_b, ";")))

    @staticmethod
    def _by_library(data: bytes):
        """Ids of a text by the library the file is made for."""
        library = Tokenizer.from_str(data.decode())
        library.encode_special_tokens = True
        library.no_truncation()
        library.no_padding()
        return lambda text: library.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _by_ranks(content: dict):
        """The same ids, sooner, where the file is plain: pieces by the usual split, merges in the order of the joined ids."""
        ids, pre = content["model"]["vocab"], content["pre_tokenizer"] or {}
        joined = [ids[a + b] for a, b in (m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"])]
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not content["normalizer"]
        if not plain or any(x >= y for x, y in zip(joined, joined[1:])) or content["model"].get("ignore_merges"):
            return None
        value = {c: b for b, c in enumerate(byte_alphabet())}
        special = {t["id"] for t in content.get("added_tokens", [])}
        ranks = {bytes(value[c] for c in s): i for s, i in ids.items() if i not in special}
        return tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, texts: list[str]) -> tuple[list, list]:
        """Ids of each text by both; none where the joined bytes of either are not a blank and the text."""
        own = [i for i, t in enumerate(texts) if t]
        a, b = [[]] * len(texts), [[]] * len(texts)
        for i, y in zip(own, self.second.encode([texts[i] for i in own], num_threads=1)):
            ids, raw = self.first(f" {texts[i]}"), f" {texts[i]}".encode()
            if b"".join(map(self.bytes_a.__getitem__, ids)) == raw and b"".join(map(self.bytes_b.__getitem__, y)) == raw:
                a[i], b[i] = ids, y
        return a, b


def _near_middle(ends_a, ends_b, middle, first, last):
    """Of each interval the index in `ends_a`, from `first` to `last`, nearest to `middle` whose end is in `ends_b`; else -1.

    Looks outwards in rings that grow twofold; every end looked at is bisected among the other side's.
    """
    found = np.full(len(middle), -1)
    open_, near, width = np.arange(len(middle)), 0, 1
    while len(open_):
        ring = np.arange(near, near + width)
        offsets = np.unique(np.concatenate([-ring, ring]))
        offsets = offsets[np.argsort(np.abs(offsets), kind="stable")]
        at = middle[open_, None] + offsets
        inside = (at >= first[open_, None]) & (at <= last[open_, None])
        row, column = np.nonzero(inside)
        value = ends_a[at[row, column]]
        hit = ends_b[np.searchsorted(ends_b, value)] == value
        row, column = row[hit], column[hit]
        best, place = np.unique(row, return_index=True)  # offsets are in order of distance
        found[open_[best]] = at[best, column[place]]
        more = np.ones(len(open_), bool)
        more[best] = False
        near += width
        more &= (middle[open_] - near >= first[open_]) | (middle[open_] + near <= last[open_])
        open_ = open_[more]
        width = min(2 * width, max(1, (1 << 20) // max(1, len(open_))))
    return found


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices, in order, of the ends that both rising arrays have; the last ends have to be equal."""
    if not len(ends_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cuts_a, cuts_b = [np.array([len(ends_a) - 1])], [np.array([len(ends_b) - 1])]
    # Interval: tokens from a to before a2, and from b to before b2; both sides end together.
    a, a2, b, b2 = (np.array([x]) for x in (0, len(ends_a), 0, len(ends_b)))
    while True:
        inner = (a2 - a > 1) & (b2 - b > 1)
        a, a2, b, b2 = a[inner], a2[inner], b[inner], b2[inner]
        if not len(a):
            break
        i = _near_middle(ends_a, ends_b, (a + a2 - 2) // 2, a, a2 - 2)
        cut = i >= 0
        a, a2, b, b2, i = a[cut], a2[cut], b[cut], b2[cut], i[cut]
        k = np.searchsorted(ends_b, ends_a[i])
        cuts_a.append(i)
        cuts_b.append(k)
        # Halves side by side: intervals stay in order, which keeps bisecting within reach of the last place.
        a, a2, b, b2 = (np.stack(x, 1).ravel() for x in ((a, i + 1), (i + 1, a2), (b, k + 1), (k + 1, b2)))
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


class Aligned:
    """The alignment of a batch of texts."""

    def __init__(self, pair: Pair, texts: list[str]):
        a, b = pair.encode(texts)
        self.n_a, self.n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(ids), np.int64, n.sum()) for ids, n in ((a, self.n_a), (b, self.n_b)))
        i, k = shared_cuts(np.cumsum(pair.size_a[ids_a]), np.cumsum(pair.size_b[ids_b]))
        document = np.searchsorted(np.cumsum(self.n_a), i, side="right")
        self.n_groups = np.bincount(document, minlength=len(texts))
        self.groups = self._shown(pair, ids_a, ids_b, i, k)
        # Pairs of the batch, and per document which of them it links and how often.
        self.pairs, local, self.totals = np.unique(ids_a[i] << 32 | ids_b[k], return_inverse=True, return_counts=True)
        wide = max(1, len(self.pairs))
        both, self.times = np.unique(document * wide + local, return_counts=True)
        self.at, self.first = both % wide, np.searchsorted(both // wide, np.arange(len(texts) + 1))

    def _shown(self, pair: Pair, ids_a, ids_b, i, k) -> list[str]:
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[i], last_b[k] = 1, 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        shown = np.empty(len(ids_a) + len(ids_b), object)
        # Before a token stand the earlier ones of its side, and the other side's of earlier groups (A), or to the end of the group (B).
        shown[np.arange(len(ids_a)) + np.concatenate([[0], k + 1])[group_a]] = pair.shown_a[ids_a + last_a * len(pair.bytes_a)]
        shown[np.arange(len(ids_b)) + (i + 1)[group_b]] = pair.shown_b[ids_b + last_b * len(pair.bytes_b)]
        ends = np.cumsum(self.n_a + self.n_b)
        return ["".join(shown[s:e].tolist())[:-1] for s, e in zip(ends - self.n_a - self.n_b, ends)]


def align(
    docs: DataFrame, first_path: str, second_path: str, text: str = "text", keep: list[str] | None = None, groups: Callable[[Column], Column] = lambda g: g
) -> DataFrame:
    """Columns `keep` (all by default) with n_a, n_b, n_groups, n_links, groups, n_best, count_sum.

    A encodes a blank and the text by a byte-level BPE file, B the text by a piece model that adds the blank. `groups`
    lists ids as `a1,a2|b1;a3|b2,b3`; the argument of that name may reduce the column before it is stored. A link is a
    token of A and one of B whose bytes end together; the count of a pair of ids is its links over all rows, n_best a
    document's links whose count is the highest of its B id (ties included), count_sum the sum of its links' counts.

    Texts are used whole. A null or empty text, or one whose joined tokens are not its bytes, has no tokens: zeros and
    empty groups. Repeated rows are rows of their own, and counted as such. Input columns with the name of an output are
    replaced. An empty table gives no rows. The two files are broadcast (their size bounds them).
    """
    spark = session(docs.sparkSession)
    with open(first_path, "rb") as f, open(second_path, "rb") as g:
        files = f.read(), g.read()
    if json.loads(files[0])["model"]["type"] != "BPE":
        raise ValueError("a plain BPE model is expected")
    shared, digest = spark.sparkContext.broadcast(files), hashlib.sha256(b"".join(files)).hexdigest()

    outputs = ["n_a", "n_b", "n_groups", "n_links", "groups"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (*outputs, "n_best", "count_sum")]
    chunk, at, times, pairs, totals, whole = (unused(docs, f"__{n}") for n in ("chunk", "at", "times", "pairs", "totals", "whole"))
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias(whole))
    long, longs = T.LongType(), T.ArrayType(T.LongType())
    schema = T.StructType([
        *source.schema.fields[:-1], *[T.StructField(n, T.StringType() if n == "groups" else long) for n in outputs],
        T.StructField(chunk, long), *[T.StructField(n, longs) for n in (at, times, pairs, totals)],
    ])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with only_used():
            pair = per_process(("alignment", digest), lambda: Pair(*shared.value))
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            n = batch.num_rows
            if not n:
                continue
            x = Aligned(pair, [t or "" for t in batch.column(len(kept)).to_pylist()])
            lists = [pa.ListArray.from_arrays(pa.array(x.first, pa.int32()), pa.array(v, pa.int64())) for v in (x.at, x.times)]
            # The first row of a batch carries its pairs.
            once = [pa.array([v.tolist()] + [None] * (n - 1), pa.list_(pa.int64())) for v in (x.pairs, x.totals)]
            columns = [x.n_a, x.n_b, x.n_groups, x.n_groups, x.groups, np.full(n, task << 32 | number), *lists, *once]
            arrays = [batch.column(i) for i in range(len(kept))] + columns
            yield pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c)).cast(f.type) for c, f in zip(arrays, arrow)], schema=arrow)

    tables = Scratch(spark, "alignment")
    rows = tables.write(source.mapInArrow(run, schema).withColumn("groups", groups(F.col("groups"))), "rows")

    zipped = F.arrays_zip(F.col(pairs).alias("pair"), F.col(totals).alias("total"))
    listed = rows.filter(F.col(pairs).isNotNull()).select(F.col(chunk).alias("chunk"), F.posexplode(zipped).alias("at", "x")).select("chunk", "at", "x.pair", "x.total")
    counts = listed.groupBy("pair").agg(F.sum("total").alias("count"))
    # A window of one B id has at most as many rows as A has ids.
    highest = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))))
    known = listed.select("chunk", "at", "pair").join(counts.select("pair", "count", (F.col("count") == highest).alias("best")), "pair").select("chunk", "at", "count", "best")

    final = T.StructType([*[f for f in rows.schema.fields if f.name not in (chunk, at, times, pairs, totals)], T.StructField("n_best", long), T.StructField("count_sum", long)])
    own = [f.name for f in final.fields[:-2]]
    arrow_final = to_arrow_schema(final)

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        count, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        place = right["at"].to_numpy()
        count[place], best[place] = right["count"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
        links, many = left[at].combine_chunks(), left[times].combine_chunks().flatten().to_numpy()
        row = np.repeat(np.arange(left.num_rows), np.diff(links.offsets.to_numpy()))
        which, sums = links.flatten().to_numpy(), []
        for value in (best, count):
            total = np.zeros(left.num_rows, np.int64)
            np.add.at(total, row, value[which] * many)
            sums.append(total)
        return pa.Table.from_arrays([*[left[n].cast(arrow_final.field(i).type) for i, n in enumerate(own)], *map(pa.array, sums)], schema=arrow_final)

    asked = rows.select(*own, chunk, at, times)
    return asked.groupBy(chunk).cogroup(known.groupBy("chunk")).applyInArrow(look_up, final)
