"""Arrays and byte strings in one compressed payload, and runs of numbers: what
the two exact substring operators send through their shuffles."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import doc_order, stage_table

INTERVALS = "_o long, _tag long, a int, b int"
PACKS = "bucket int, payload binary"
#: Pieces of one minimiser from which its windows are dealt one by one, and bytes
#: of single windows in each of the buckets they go to, on average.
HOT_PIECES, HOT_BUCKET_BYTES = 10_000, 16_000_000
#: Most hot minimisers, eight bytes each: the limit of pieces rises with all pieces
#: so that no more can reach it.
MOST_HOT = 1_000_000
#: Text bytes counted together, those looked at in one go, and pieces of one
#: minimiser below which such a stretch reports it for a share of the minimisers.
COUNT_BYTES, PART_BYTES, LEAST_PIECES = 64_000_000, 4_000_000, 16
#: Bytes of pieces a shard holds before it sends them on.
HELD_BYTES = 48_000_000
_PACK_SCHEMA = pa.schema([("bucket", pa.int32()), ("payload", pa.binary())])
_INTERVAL_SCHEMA = pa.schema([("_o", pa.int64()), ("_tag", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])


def pack(arrays: Iterable[np.ndarray | bytes], level: int = 1) -> bytes:
    """Arrays one after the other, each with type and size, compressed."""
    parts = []
    for x in arrays:
        data = x if isinstance(x, bytes) else x.tobytes()
        kind = b"bytes" if isinstance(x, bytes) else x.dtype.str.encode()
        parts += [kind.ljust(8), len(data).to_bytes(8, "little"), data]
    return zstandard.ZstdCompressor(level=level).compress(b"".join(parts))


def unpack(payload: bytes) -> list:
    data, at, out = zstandard.ZstdDecompressor().decompress(payload), 0, []
    while at < len(data):
        kind, size = data[at:at + 8].strip(), int.from_bytes(data[at + 8:at + 16], "little")
        raw = data[at + 16:at + 16 + size]
        out.append(raw if kind == b"bytes" else np.frombuffer(raw, np.dtype(kind.decode())))
        at += 16 + size
    return out


def pack_batches(rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Pack rows as record batches of some megabytes."""
    some, size = [], 0
    for bucket, payload in rows:
        some.append((bucket, payload))
        size += len(payload)
        if size > 4_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), _PACK_SCHEMA.types)],
                                             schema=_PACK_SCHEMA)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), _PACK_SCHEMA.types)],
                                         schema=_PACK_SCHEMA)


def runs(places: np.ndarray, *groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each maximal run of consecutive places (sorted
    within groups) that share their group values."""
    if len(places) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.diff(places) != 1
    for g in groups:
        new |= g[1:] != g[:-1]
    cut = np.flatnonzero(new)
    return np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(places) - 1]])


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in ``known`` (sorted), by binary search."""
    if len(known) == 0:
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def intervals(o: np.ndarray, tag: np.ndarray, start: np.ndarray, window: int) -> list[np.ndarray]:
    """Intervals [a, b) covered by windows at ``start`` of documents (o, tag),
    touching windows merged."""
    by = np.lexsort((start, tag, o))
    o, tag, start = o[by], tag[by], start[by]
    first, last = runs(start, o, tag)
    return [o[first].astype("<i8"), tag[first].astype("<i8"), start[first].astype("<i4"),
            (start[last] + window).astype("<i4")]


def first_of_each(texts: list[bytes], o: np.ndarray, tag: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pieces in order of place: the first of each, and later copies (not
    those at the first one's place, which are the same piece sent twice)."""
    seen: dict[bytes, int] = {}
    lead = np.fromiter((seen.setdefault(t, i) for i, t in enumerate(texts)), np.int64, len(texts))
    place = np.arange(len(texts))
    other = (o != o[lead]) | (tag != tag[lead]) | (start != start[lead])
    return place[lead == place], place[(lead != place) & other]


def interval_table(found: list[list[np.ndarray]]) -> pa.Table:
    columns = [np.concatenate([f[i] for f in found]) for i in range(4)] if found else [np.zeros(0)] * 4
    return pa.table([pa.array(c, t) for c, t in zip(columns, _INTERVAL_SCHEMA.types)], schema=_INTERVAL_SCHEMA)


def covered(n: int, spans: list[dict] | None) -> np.ndarray:
    """Mask of n places under the intervals of a document."""
    marks = np.zeros(n + 1, np.int64)
    if spans:
        np.add.at(marks, np.array([s["a"] for s in spans], np.int64), 1)
        np.add.at(marks, np.minimum(np.array([s["b"] for s in spans], np.int64), n), -1)
    return np.cumsum(marks)[:-1] > 0


class Shard:
    """Documents of one task's stretch of rows, in document order, each once."""

    def __init__(self) -> None:
        self.rows: dict[tuple[int, int], bytes] = {}
        self.size = 0

    def add(self, o: int, tag: int, data: bytes) -> None:
        if (o, tag) not in self.rows:
            self.rows[(o, tag)] = data
            self.size += len(data)

    def in_order(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        keys = sorted(self.rows)
        return (np.array([k[0] for k in keys], np.int64), np.array([k[1] for k in keys], np.int64),
                [self.rows[k] for k in keys])


def by_shard(work: Callable[[Shard], Iterator[tuple[int, bytes]]], shard_bytes: int) -> Callable:
    """mapInArrow function over (_o, _tag, text): documents gather until a shard
    holds ``shard_bytes`` or more, then ``work`` makes its packs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packs() -> Iterator[tuple[int, bytes]]:
            shard = Shard()
            for batch in batches:
                for o, tag, text in zip(*[batch.column(k) for k in range(3)]):
                    shard.add(o.as_py(), tag.as_py(), (text.as_py() or "").encode())
                    if shard.size >= shard_bytes:
                        yield from work(shard)
                        shard = Shard()
            if shard.rows:
                yield from work(shard)

        yield from pack_batches(packs())

    return run


def bucket_of_shard(o: np.ndarray, tag: np.ndarray, buckets: int) -> int:
    """Bucket that takes a shard's own intervals: by the hash of its first
    document, so that shards spread over all buckets."""
    return int.from_bytes(hashlib.blake2b(np.array([o[0], tag[0]], np.int64).tobytes(), digest_size=8).digest(),
                          "little") % buckets


def keyed(docs: DataFrame, tag: Column) -> DataFrame:
    return docs.select(doc_order().alias("_o"), tag.alias("_tag"), F.col("text").cast("string"))


def bucket_count(docs: DataFrame, text_bytes: int) -> int:
    """Buckets that hold what ``text_bytes`` of text send, on average: their
    number follows the data, so a bucket fits in memory at any size."""
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return int(-(-total // text_bytes)) + 1


def _counted(pieces_of: Callable, least: int) -> Callable:
    def report(found: list[tuple]) -> pa.RecordBatch:
        value, mark, windows = (np.concatenate(c) for c in zip(*found))
        _, first = np.unique(mark, return_index=True)
        values, inverse, count = np.unique(value[first], return_inverse=True, return_counts=True)
        total = np.bincount(inverse, windows[first], len(values)).astype(np.int64)
        # n pieces below ``least`` count as ``least`` in n of ``least`` stretches, else as
        # none: a minimiser spread thin over many stretches is found all the same
        few = count < least
        drawn = ((values ^ mark[first].sum()) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(least) < count
        total = np.where(few, total * least // np.maximum(count, 1), total)
        told = ~few | drawn
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (
            values[told].view(np.int64), np.maximum(count, least)[told], total[told])], names=["value", "pieces", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, texts, size, part = [], [], 0, 0
        for batch in batches:
            for text in batch.column(0):
                texts.append((text.as_py() or "").encode())
                part += len(texts[-1])
                if part >= PART_BYTES:
                    found += pieces_of(texts)
                    texts, size, part = [], size + part, 0
                    if size >= COUNT_BYTES and found:
                        yield report(found)
                        found, size = [], 0
        found += pieces_of(texts)
        if found:
            yield report(found)

    return run


def hot_minimisers(docs: DataFrame, pieces_of: Callable, window_bytes: int,
                   hot_pieces: int) -> tuple[Broadcast[np.ndarray], int]:
    """Minimisers (sorted) of ``hot_pieces`` different pieces or more, and the
    buckets their windows need.

    ``pieces_of`` lists (minimiser, fingerprint, windows) of the pieces of some
    texts.  The set only says where windows go, never which ones count: equal
    windows have one minimiser and so go one way.  Copies count once a stretch.
    The set is bounded: of all counted pieces, at most ``MOST_HOT`` minimisers can
    hold a share of one in ``MOST_HOT`` each, and a smaller share is not hot."""
    counted = docs.select(F.col("text").cast("string")).mapInArrow(
        _counted(pieces_of, min(LEAST_PIECES, hot_pieces)), "value long, pieces long, windows long")
    by_value = stage_table(counted.groupBy("value").agg(F.sum("pieces").alias("pieces"), F.sum("windows").alias("windows")),
                           "minimisers")
    total = by_value.agg(F.sum("pieces")).first()[0] or 0
    rows = by_value.where(F.col("pieces") >= max(hot_pieces, -(-total // MOST_HOT))).select("value", "windows").toPandas()
    values = np.sort(rows["value"].to_numpy(np.int64).view(np.uint64))
    return (docs.sparkSession.sparkContext.broadcast(values),
            int(rows["windows"].sum()) * window_bytes // HOT_BUCKET_BYTES + 1)


def with_spans(docs: DataFrame, tag: Column, found: DataFrame) -> DataFrame:
    """(doc_id, text, spans) for every row: the intervals of its document,
    gathered by document before they meet the texts."""
    spans = found.groupBy("_o", "_tag").agg(F.collect_list(F.struct("a", "b")).alias("spans")).select(
        F.col("_o").alias("_so"), F.col("_tag").alias("_st"), "spans")
    rows = docs.select(F.col("doc_id").cast("long"), doc_order().alias("_o"), tag.alias("_tag"),
                       F.col("text").cast("string"))
    return rows.join(spans, (F.col("_o") == F.col("_so")) & (F.col("_tag") == F.col("_st")), "left").select(
        "doc_id", "text", "spans")
