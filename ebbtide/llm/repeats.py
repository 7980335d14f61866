"""Removal of passages that an earlier document holds too, from sorted suffixes of the places where repeats can be.

Every string of `length` bytes has an anchor: its 16-byte gram of least hash, the leftmost of equals. Equal strings have equal
anchors, so only strings whose anchor's gram is in two documents can repeat. Four steps, each over all executors:

1. Per chunk of documents, the grams of all anchors go to shards by their hash; each chunk sends a gram once.
2. A shard tells each chunk which of its grams another document has too.
3. The bytes around such anchors, all strings of one anchor run in one fragment, go to shards by gram; equal fragments of a
   chunk go once, for the smallest document. A gram of very many documents is no key: there each string is a fragment of its
   own, and goes to the shard of its own hash, so that no gram fills a task.
4. A shard puts the suffixes of its fragments in order by external induced sorting; neighbours whose common prefix reaches
   `length` hold the same string, and the smallest document among them is its first. Strings that begin in a document larger
   than that are sent back to the chunk, which cuts the bytes they cover.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.running import running
from .common import Scratch, session
from .induced_sort import suffix_order

LENGTH, GRAM = 50, 16
# A gram found in so many documents is split by whole strings.
CROWDED = 20_000
# Bytes of documents looked at together; bytes of fragments sorted together (more if one gram has more).
PIECE_BYTES, SORT_BYTES = 1 << 20, 1 << 20
CHUNKS_PER_PARTITION = 2
# Bytes of a shard's fragments in memory; beyond that they wait in a file, in so many ranges of grams.
SHARD_BYTES, RANGES = 128 << 20, 64
LAST = (1 << 63) - 1

U32 = np.uint64(32)
LOW = np.uint64(0xFFFFFFFF)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 16 bytes from each position on."""
    word = data.astype(np.uint64)
    for k in (1, 2, 4):
        word = word[:-k] | word[k:] << np.uint64(8 * k)
    n = len(data) - GRAM + 1
    h = word[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h = (h ^ word[8 : 8 + n]) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> U32
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Texts put together up to PIECE_BYTES, with (document, offset in it, offset in the piece) of each part.

    Long texts are cut so that each string of `length` bytes is whole in exactly one part.
    """
    held, parts, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), PIECE_BYTES):
            part = text[at : at + PIECE_BYTES + length - 1]
            if size and size + len(part) > PIECE_BYTES:
                yield b"".join(held), parts
                held, parts, size = [], [], 0
            parts.append((i, at, size))
            held.append(part)
            size += len(part)
    if parts:
        yield b"".join(held), parts


def anchor_runs(data: bytes, parts: list[tuple[int, int, int]], length: int):
    """Runs of strings with the same anchor: gram hash, document, start in the document, start in the piece, strings."""
    buffer = np.frombuffer(data, np.uint8)
    hashes = gram_hashes(buffer)
    places = np.arange(len(hashes), dtype=np.uint64)
    anchors = (sliding_min((hashes >> U32 << U32) | places, length - GRAM + 1) & LOW).astype(np.int64)
    starts = np.array([p[2] for p in parts])
    ends = np.append(starts[1:], len(data))
    # Strings that lie in one part; a part is at least one string long.
    counts = ends - starts - length + 1
    of = np.repeat(np.arange(len(parts)), counts)
    at = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[of]
    own = anchors[at]
    first = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (of[1:] != of[:-1])))
    strings = np.diff(np.append(first, len(of)))
    part = of[first]
    doc = np.array([p[0] for p in parts])[part]
    start = at[first]
    return hashes[own[first]], doc, start - starts[part] + np.array([p[1] for p in parts])[part], start, strings


CODEC = "zstd"


def pack(*arrays: np.ndarray | bytes) -> tuple[bytes, int]:
    """Arrays as one compressed string, and its size before that."""
    raw = [a if isinstance(a, bytes) else a.tobytes() for a in arrays]
    data = np.array([len(arrays), *map(len, raw)], np.int64).tobytes() + b"".join(raw)
    return pa.compress(data, CODEC, asbytes=True), len(data)


def unpack(data: bytes, size: int, *kinds) -> list:
    raw = pa.decompress(data, size, CODEC, asbytes=True)
    n = int(np.frombuffer(raw[:8], np.int64)[0])
    sizes = np.frombuffer(raw[8 : 8 + 8 * n], np.int64)
    at, out = 8 + 8 * n, []
    for kind, length in zip(kinds, sizes.tolist()):
        part = raw[at : at + length]
        out.append(part if kind is bytes else np.frombuffer(part, kind))
        at += length
    return out


MESSAGE = "to int, chunk int, data binary, size long"


def _messages(rows: list[tuple[int, int, bytes, int]]) -> pa.Table:
    to, chunk, data, size = zip(*rows) if rows else ([], [], [], [])
    return pa.table({"to": pa.array(to, pa.int32()), "chunk": pa.array(chunk, pa.int32()), "data": pa.array(data, pa.binary()), "size": pa.array(size, pa.int64())})


def _split(by: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of a sorted array."""
    if len(by):
        first = np.flatnonzero(np.append(True, by[1:] != by[:-1]))
        for b, e in zip(first.tolist(), np.append(first[1:], len(by)).tolist()):
            yield int(by[b]), slice(b, e)


def _chunk(table: pa.Table) -> tuple[int, list[bytes], np.ndarray]:
    keys = table.column("key").fill_null(LAST).to_numpy()
    return table.column("chunk")[0].as_py(), [t or b"" for t in table.column("body").to_pylist()], keys


def _grams(shards: int, length: int):
    """Step 1: (shard; gram, smallest document, whether there are more, number of documents) of a chunk."""

    def run(table: pa.Table) -> pa.Table:
        chunk, texts, keys = _chunk(table)
        found = [anchor_runs(data, parts, length)[:2] for data, parts in pieces(texts, length)]
        if not found:
            return _messages([])
        gram = np.concatenate([f[0] for f in found])
        doc = np.concatenate([keys[f[1]] for f in found])
        order = np.lexsort((doc, gram))
        gram, doc = gram[order], doc[order]
        fresh = np.append(True, (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1]))
        gram, doc = gram[fresh], doc[fresh]
        first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        count = np.diff(np.append(first, len(gram)))
        gram, doc = gram[first], doc[first]
        shard, short = ((gram >> U32) % np.uint64(shards)).astype(np.int64), (gram & LOW).astype(np.uint32)
        order = np.lexsort((short, shard))
        shard, short, doc, count = shard[order], short[order], doc[order], count[order].astype(np.uint32)
        return _messages([(to, chunk, *pack(short[at], doc[at], count[at])) for to, at in _split(shard)])

    return run


def _shared(crowded_from: int):
    """Step 2: (chunk; grams that another document has too, whether they are crowded) of a shard."""

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("to")[0].as_py()
        chunks = table.column("chunk").to_numpy()
        parts = [unpack(d, s, np.uint32, np.int64, np.uint32) for d, s in zip(table.column("data").to_pylist(), table.column("size").to_pylist())]
        gram = np.concatenate([p[0] for p in parts])
        doc = np.concatenate([p[1] for p in parts])
        count = np.concatenate([p[2] for p in parts]).astype(np.int64)
        chunk = np.repeat(chunks, [len(p[0]) for p in parts])
        order = np.argsort(gram, kind="stable")
        gram, doc, count, chunk = gram[order], doc[order], count[order], chunk[order]
        first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        runs = np.diff(np.append(first, len(gram)))
        several = (np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)) | (np.maximum.reduceat(count, first) > 1)
        crowded = np.add.reduceat(count, first) >= crowded_from
        keep = np.repeat(several, runs)
        gram, chunk, crowded = gram[keep], chunk[keep], np.repeat(crowded, runs)[keep]
        order = np.argsort(chunk, kind="stable")
        gram, chunk, crowded = gram[order], chunk[order], crowded[order]
        return _messages([(shard, to, *pack(gram[at], crowded[at].astype(np.uint8))) for to, at in _split(chunk)])

    return run


RUNS = (np.int64, np.uint64, np.uint32, np.uint8)


def _row_key(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text)


def _fragments(shards: int, length: int):
    """Step 3: (shard; fragments around shared anchors, and runs of strings that the chunk itself holds earlier)."""

    def run(docs: pa.Table, shared: pa.Table) -> pa.Table:
        if not docs.num_rows or not shared.num_rows:
            return _messages([])
        chunk, texts, keys = _chunk(docs)
        known, crowded = [], []
        for to, data, size in zip(*[shared.column(c).to_pylist() for c in ("to", "data", "size")]):
            gram, full = unpack(data, size, np.uint32, np.uint8)
            known.append(np.uint64(to) << U32 | gram)
            crowded.append(full)
        known, crowded = np.concatenate(known), np.concatenate(crowded)
        order = np.argsort(known)
        known, crowded = known[order], crowded[order]
        # Every string run around a shared anchor, as the number of its fragment among the distinct ones of the chunk.
        place: dict[bytes, int] = {}
        number, docs_, starts, runs, shard_of, gram_of = [], [], [], [], [], []
        for data, parts in pieces(texts, length):
            gram, doc, start, at, strings = anchor_runs(data, parts, length)
            shard, short = (gram >> U32) % np.uint64(shards), gram & LOW
            wanted = shard << U32 | short
            at_known = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            hit = known[at_known] == wanted
            split = hit & (crowded[at_known] > 0)
            hit &= ~split
            for column, values in ((docs_, doc), (starts, start), (runs, strings), (shard_of, shard), (gram_of, short)):
                column.append(values[hit].astype(np.int64))
            ends = at + strings + (length - 1)
            number += [place.setdefault(data[x:y], len(place)) for x, y in zip(at[hit].tolist(), ends[hit].tolist())]
            rows = np.flatnonzero(split)
            if len(rows):
                # Each string of a crowded gram goes its own way.
                each = np.repeat(rows, strings[rows])
                inner = np.arange(len(each)) - np.repeat(np.cumsum(strings[rows]) - strings[rows], strings[rows])
                own = [data[x : x + length] for x in (at[each] + inner).tolist()]
                hashes = np.array([xxhash.xxh64_intdigest(s) for s in own], np.uint64)
                for column, values in (
                    (docs_, doc[each]), (starts, start[each] + inner), (runs, np.ones(len(each))), (shard_of, (hashes >> U32) % np.uint64(shards)), (gram_of, hashes & LOW),
                ):
                    column.append(values.astype(np.int64))
                number += [place.setdefault(s, len(place)) for s in own]
        if not number:
            return _messages([])
        number = np.array(number, np.int64)
        doc, start, strings, shard, short = [np.concatenate(c) for c in (docs_, starts, runs, shard_of, gram_of)]
        key, row = keys[doc], np.array([_row_key(t) for t in texts], np.uint64)[doc]
        least = np.full(len(place), LAST, np.int64)
        np.minimum.at(least, number, key)
        # Of equal fragments the smallest document's are sent; all others are repeats of it.
        mine = key == least[number]
        again = ~mine
        sent = np.flatnonzero(mine)
        sent = sent[np.lexsort((short[sent], shard[sent]))]
        fragments = list(place)
        none = [np.empty(0, k) for k in RUNS]
        out = []
        for i, (to, at) in enumerate(_split(shard[sent])):
            rows = sent[at]
            back = [c[again].astype(k) for c, k in zip((key, row, start, strings), RUNS)] if i == 0 else none
            out.append(
                (to, chunk, *pack(
                    short[rows].astype(np.uint32), *[c[rows].astype(k) for c, k in zip((key, row, start, strings), RUNS)],
                    b"".join([fragments[f] for f in number[rows].tolist()]), *back,
                ))
            )
        return _messages(out)

    return run


def first_documents(texts: list[bytes], keys: np.ndarray, strings: np.ndarray, length: int) -> np.ndarray:
    """For each string of each fragment, in order: the smallest key of a fragment that holds it."""
    sizes = np.array([len(t) for t in texts])
    text = np.ones(int(sizes.sum()) + len(texts) + 1, np.uint16)
    starts = np.cumsum(sizes + 1) - sizes - 1
    body = np.frombuffer(b"".join(texts), np.uint8)
    at = np.arange(len(body)) + np.repeat(np.arange(len(texts)), sizes)
    text[at] = body.astype(np.uint16) + 2
    text[-1] = 0
    owner = np.full(len(text), -1, np.int64)
    begins = np.arange(int(strings.sum())) - np.repeat(np.cumsum(strings) - strings, strings) + np.repeat(starts, strings)
    owner[begins] = np.repeat(np.arange(len(texts)), strings)
    order, prefix = suffix_order(text, length)
    # Neighbours with a common prefix of `length` hold the same string.
    first = np.flatnonzero(prefix < length)
    of = owner[order]
    least = np.minimum.reduceat(np.where(of >= 0, keys[of], LAST), first)
    result = np.empty(len(text), np.int64)
    result[order] = np.repeat(least, np.diff(np.append(first, len(order))))
    return result[begins]


class Shard:
    """The fragments of one shard, in a temporary file by ranges of grams where they outgrow memory."""

    KINDS = (np.uint32, np.int64, np.uint64, np.uint32, np.uint8)

    def __init__(self, length: int, memory: int):
        self.length, self.memory, self.held, self.bytes, self.file, self.places = length, memory, [], 0, None, {}

    def add(self, chunk: int, columns: list[np.ndarray], text: bytes) -> None:
        """Fragments in order of their grams: gram, key, row, start, strings, and their bytes one behind the other."""
        self.held.append((chunk, columns, text))
        self.bytes += len(text) + 25 * len(columns[0])
        if self.bytes > self.memory:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        edges = np.arange(1, RANGES, dtype=np.uint64) * np.uint64((1 << 32) // RANGES)
        for chunk, columns, text in self.held:
            ends = np.append(0, np.cumsum(columns[4].astype(np.int64) + (self.length - 1)))
            cuts = [0, *np.searchsorted(columns[0], edges).tolist(), len(columns[0])]
            for i, (b, e) in enumerate(zip(cuts, cuts[1:])):
                if b < e:
                    raw = b"".join([*[c[b:e].tobytes() for c in columns], text[ends[b] : ends[e]]])
                    self.places.setdefault(i, []).append((chunk, e - b, self.file.tell(), len(raw)))
                    self.file.write(raw)
        self.held, self.bytes = [], 0

    def parts(self) -> Iterator[list[tuple[int, list[np.ndarray], bytes]]]:
        """All fragments; those of a gram come together."""
        if self.file is None:
            if self.held:
                yield self.held
            return
        self._spill()
        for i in sorted(self.places):
            part = []
            for chunk, n, at, size in self.places[i]:
                self.file.seek(at)
                raw, columns, used = self.file.read(size), [], 0
                for kind in self.KINDS:
                    columns.append(np.frombuffer(raw, kind, n, used))
                    used += n * np.dtype(kind).itemsize
                part.append((chunk, columns, raw[used:]))
            yield part
        self.file.close()


def repeated_runs(part: list[tuple[int, list[np.ndarray], bytes]], length: int) -> Iterator[tuple[int, tuple]]:
    """(chunk, runs of strings that begin in a smaller document too) of fragments, sorted about SORT_BYTES at a time."""
    texts: list[bytes] = []
    for _, columns, text in part:
        ends = np.cumsum(columns[4].astype(np.int64) + (length - 1)).tolist()
        texts += [text[b:e] for b, e in zip([0, *ends], ends)]
    short, key, row, start, strings = [np.concatenate(c) for c in zip(*[columns for _, columns, _ in part])]
    chunk = np.repeat([c for c, _, _ in part], [len(columns[0]) for _, columns, _ in part])
    order = np.argsort(short, kind="stable")
    # Cut between grams, about SORT_BYTES each.
    total = np.cumsum(strings[order].astype(np.int64) + (length - 1))
    cuts, reached = [0], 0
    for c in (np.flatnonzero(np.append(short[order][1:] != short[order][:-1], True)) + 1).tolist():
        if total[c - 1] - reached >= SORT_BYTES or c == len(order):
            cuts.append(c)
            reached = int(total[c - 1])
    for b, e in zip(cuts, cuts[1:]):
        rows = order[b:e]
        # Equal fragments are sorted once, for their smallest document.
        place: dict[bytes, int] = {}
        of = np.array([place.setdefault(texts[i], len(place)) for i in rows.tolist()])
        least = np.full(len(place), LAST, np.int64)
        np.minimum.at(least, of, key[rows])
        own = np.empty(len(place), np.int64)
        own[of] = strings[rows]
        first = first_documents(list(place), least, own, length)
        offset = np.cumsum(own) - own
        n = strings[rows].astype(np.int64)
        entry = np.repeat(np.arange(len(rows)), n)
        within = np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n)
        repeated = first[offset[of[entry]] + within] < key[rows][entry]
        begin = np.flatnonzero(np.append(True, (entry[1:] != entry[:-1]) | (repeated[1:] != repeated[:-1])))
        span = np.diff(np.append(begin, len(entry)))
        begin, span = begin[repeated[begin]], span[repeated[begin]]
        r = rows[entry[begin]]
        by = np.argsort(chunk[r], kind="stable")
        r, begin, span = r[by], begin[by], span[by]
        for to, s in _split(chunk[r]):
            yield to, (key[r[s]], row[r[s]], start[r[s]] + within[begin[s]], span[s])


def _firsts(length: int, memory: int):
    """Step 4: (chunk; runs of strings that begin in a smaller document too), shard by shard."""

    def messages(shard: int, back: dict[int, list[tuple]]) -> Iterator[pa.RecordBatch]:
        rows = [(shard, to, *pack(*[np.concatenate(c).astype(k) for c, k in zip(zip(*found), RUNS)])) for to, found in back.items()]
        yield from _messages(rows).to_batches()
        back.clear()

    def finish(shard: int, own: Shard, back: dict[int, list[tuple]]) -> Iterator[pa.RecordBatch]:
        for part in own.parts():
            for to, found in repeated_runs(part, length):
                back.setdefault(to, []).append(found)
            if own.file is not None:
                yield from messages(shard, back)
        yield from messages(shard, back)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, own, back = None, None, {}
        for batch in batches:
            for to, chunk, data, size in zip(*[batch.column(c).to_pylist() for c in ("to", "chunk", "data", "size")]):
                if to != shard:
                    if own is not None:
                        yield from finish(shard, own, back)
                    shard, own = to, Shard(length, memory)
                *columns, text, key, row, start, strings = unpack(data, size, *Shard.KINDS, bytes, *RUNS)
                if len(columns[0]):
                    own.add(chunk, columns, text)
                if len(key):
                    back.setdefault(chunk, []).append((key, row, start, strings))
        if own is not None:
            yield from finish(shard, own, back)

    return run


def _cut(length: int, arrow: pa.Schema):
    """The rest of each document without the bytes that repeated strings cover."""

    def run(docs: pa.Table, runs: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return arrow.empty_table()
        _, texts, keys = _chunk(docs)
        parts = [unpack(d, s, *RUNS) for d, s in zip(runs.column("data").to_pylist(), runs.column("size").to_pylist())]
        key, row, start, strings = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, k) for k in RUNS]
        order = np.lexsort((start, row, key))
        key, row, start, strings = key[order], row[order], start[order].astype(np.int64), strings[order].astype(np.int64)
        change = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]))) if len(key) else np.empty(0, np.int64)
        bounds = np.append(change, len(key)).tolist()
        place = {(int(key[b]), int(row[b])): (b, e) for b, e in zip(bounds, bounds[1:])}
        spans, kept = [], []
        for text, own in zip(texts, keys.tolist()):
            b, e = place.get((own, _row_key(text)), (0, 0))
            if b == e:
                spans.append([])
                kept.append(text)
                continue
            low, high = start[b:e], np.maximum.accumulate(start[b:e] + strings[b:e] - 1 + length)
            fresh = np.append(True, low[1:] > high[:-1])
            lows = low[fresh].tolist()
            highs = high[np.append(np.flatnonzero(fresh)[1:] - 1, len(low) - 1)].tolist()
            spans.append([{"start": x, "end": y} for x, y in zip(lows, highs)])
            kept.append(b"".join(text[x:y] for x, y in zip([0, *highs], [*lows, len(text)])))
        columns = [docs.column("key"), pa.array([len(t) for t in texts], pa.int64()), pa.array(spans, arrow.field("spans").type), pa.array(kept, pa.binary())]
        return pa.table([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=arrow)

    return run


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def remove_repeats(
    docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, crowded_from: int = CROWDED, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """One row per input row: `key`, n_bytes, spans of removed bytes (start, end), kept (the rest, as bytes).

    Texts are UTF-8 bytes; a null text is empty. A byte is removed if a string of `length` bytes that covers it also begins
    in a document with a smaller key. Keys may be of any type that has an order: those that are no whole numbers are
    replaced by their places, which costs a join of the texts. Documents with the same key, repeated rows included, take nothing from each other;
    null keys come last. A text shorter than `length` stays as it is; an empty table gives no rows. Other columns are not
    read. `crowded_from` and `shard_bytes` (documents of a gram, memory of a shard) change the way, not the result. What is kept need not be valid UTF-8, since strings begin and end anywhere.
    """
    spark = session(docs.sparkSession)
    if not 33 <= length <= 255:
        raise ValueError("strings of 33 to 255 bytes are supported")
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        return _by_place(docs, text, key, length, crowded_from, shard_bytes)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    number = F.pmod(F.xxhash64(F.col(f"`{key}`"), body), F.lit(parts * CHUNKS_PER_PARTITION)).cast("int")
    # One exchange of the texts serves the three steps that read them.
    base = docs.select(number.alias("chunk"), F.col(f"`{key}`").cast("long").alias("key"), body.alias("body")).repartition(parts, "chunk")
    grams = base.groupBy("chunk").applyInArrow(_grams(parts, length), MESSAGE)
    shared = grams.groupBy("to").applyInArrow(_shared(crowded_from), MESSAGE)
    fragments = base.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_fragments(parts, length), MESSAGE)
    runs = fragments.repartition(parts, "to").sortWithinPartitions("to").mapInArrow(_firsts(length, shard_bytes), MESSAGE)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("spans", SPANS), T.StructField("kept", T.BinaryType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    cut = base.groupBy("chunk").cogroup(runs.groupBy("chunk")).applyInArrow(_cut(length, to_arrow_schema(schema)), schema)
    return cut.withColumnRenamed("key", key)


def _by_place(docs: DataFrame, text: str, key: str, length: int, crowded_from: int, shard_bytes: int) -> DataFrame:
    """The same by the places of the distinct keys in their order."""
    given = docs.select(F.col(f"`{key}`").alias("__given"), F.col(f"`{text}`").alias("text"))
    distinct = given.select("__given").filter(F.col("__given").isNotNull()).distinct()
    places = Scratch(docs.sparkSession, "repeats").write(running(distinct, [], [F.col("__given")], {"place": ("sum", F.lit(1))}), "places")
    placed = given.join(places, "__given", "left").select(F.col("place").cast("long").alias("place"), "text")
    cut = remove_repeats(placed, "text", "place", length, crowded_from, shard_bytes)
    return cut.join(places, "place", "left").select(F.col("__given").alias(key), "n_bytes", "spans", "kept")
