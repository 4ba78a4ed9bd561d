"""Operator 4, exact substring dedup by suffix arrays.

1. Each shard (a stretch of a task's rows) sorts its suffixes to the depth of a
   window by Larsson-Sadakane refinement: groups of suffixes equal in h bytes are
   split by the rank of what follows, only where they are not single yet.
   Common prefixes of neighbours (Kasai) name the windows the shard repeats; all
   but the first are removed, and only first occurrences go on.
2. Those travel as packed runs: consecutive windows with one minimiser, to the
   bucket of that minimiser, so that equal windows of different shards meet and
   text that no other shard shares is dropped there at once.
3. In a bucket, chunks of bounded size get suffix arrays of their own, and their
   sorted windows are merged by binary search, the earliest place staying.

A passage in a third of all rows reaches its bucket once per shard.  Its edges,
which differ, all have a minimiser of the passage: minimisers of very many pieces
are counted before, and their windows are dealt singly by the hash of the window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession

from orderlens.llm import packs as P
from orderlens.llm.common import release, row_tag, stage_table, table, workers_import
from orderlens.llm.kmers import sliding_min

#: A gram of 16 bytes is two or three words: texts that are no copies rarely share
#: one, and runs of windows with one minimiser stay long.
WINDOW_BYTES, GRAM_BYTES = 100, 16
#: A suffix array holds fewer bytes than 2^21, so that two ranks and a place fit
#: one 64-bit sort key.
PLACE_BITS = 21
#: Text bytes of one suffix array, of the shard that packs several of them, and
#: of what one bucket gets on average: what survives in a bucket then mostly fits
#: one suffix array.
ARRAY_BYTES, SHARD_BYTES, BUCKET_BYTES = 2_000_000, 8_000_000, 2_000_000
#: Bits of a minimiser that go along with a piece.
VALUE_BYTES = 3
_MASK = np.uint64((1 << PLACE_BITS) - 1)
_BITS = np.uint64(PLACE_BITS)


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``data`` (bytes) in the order of their first ``depth`` bytes,
    ties by place, and where a new group of equal ones begins."""
    n = len(data)
    if n >= (1 << PLACE_BITS) - 1:
        raise ValueError("too many bytes for one suffix array")
    # bytes by their place in the alphabet at hand: more of them fit one key
    used = np.bincount(data, minlength=256) > 0
    code = (np.cumsum(used) * used).astype(np.uint8)
    bits = max(1, int(used.sum()).bit_length())
    h = min((64 - PLACE_BITS) // bits, depth)
    padded = np.concatenate([code[data].astype(np.uint64), np.zeros(h, np.uint64)])
    key = padded[:n].copy()
    for k in range(1, h):
        key <<= np.uint64(bits)
        key |= padded[k:k + n]
    key <<= _BITS
    key |= np.arange(n, dtype=np.uint64)
    key.sort()
    sa = (key & _MASK).astype(np.int32)
    key >>= _BITS
    head = np.ones(n, bool)
    np.not_equal(key[1:], key[:-1], out=head[1:])
    # 1 + slot of the group's first; 0 beyond the end
    rank = np.zeros(n + depth, np.uint32)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(1, n + 1, dtype=np.uint32), np.uint32(0)))
    while h < depth:
        step = min(h, depth - h)
        open_ = ~(head & np.append(head[1:], True))
        slots = np.flatnonzero(open_).astype(np.int32)
        if len(slots) == 0:
            break
        at = sa[slots]
        key = rank[at].astype(np.uint64)
        key <<= _BITS
        key |= rank[at + step]
        key <<= _BITS
        key |= at.astype(np.uint64)
        key.sort()
        at = (key & _MASK).astype(np.int32)
        key >>= _BITS
        first = np.ones(len(slots), bool)
        np.not_equal(key[1:], key[:-1], out=first[1:])
        sa[slots], head[slots] = at, first
        rank[at] = np.maximum.accumulate(np.where(first, slots + 1, 0)).astype(np.uint32)
        h += step
    return sa.astype(np.int64), head


def common_prefixes(data: np.ndarray, at: np.ndarray, before: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix (``depth`` at most) of the suffixes at ``at`` and at their
    neighbours ``before``.

    After Kasai: along consecutive places whose neighbours are consecutive too,
    a prefix loses one byte a step, so each byte of such a chain is compared
    once and a prefix ends at the chain's next difference."""
    if len(at) == 0:
        return np.zeros(0, np.int64)
    by = np.argsort(at, kind="stable")
    x, y = at[by], before[by]
    first, last = P.runs(x, x - y)
    length = last - first + depth
    ends = np.cumsum(length)
    shift = np.arange(ends[-1]) - np.repeat(ends - length, length)
    n = len(data)
    i, j = np.repeat(x[first], length) + shift, np.repeat(y[first], length) + shift
    inside = (i < n) & (j < n)
    differs = np.flatnonzero(~inside | (data[np.minimum(i, n - 1)] != data[np.minimum(j, n - 1)]))
    chain = np.repeat(np.arange(len(first)), last - first + 1)
    flat = (ends - length)[chain] + (np.arange(len(x)) - first[chain])
    after = np.append(differs, ends[-1] + depth)[np.searchsorted(differs, flat)]
    out = np.empty(len(at), np.int64)
    out[by] = np.minimum(after - flat, depth)
    return out


def repeats(pieces: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """Windows of the pieces, which come in order of place: (piece of each
    byte, offset in it, valid window starts, late, lead), where ``late`` are
    starts of windows that also start earlier and ``lead`` the first ones."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    size = np.array([len(p) for p in pieces], np.int64)
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), size)
    offset = (np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
    valid = offset + window <= size[piece]
    sa, head = suffix_array(data, window)
    tied = np.flatnonzero(~head)
    whole = common_prefixes(data, sa[tied], sa[tied - 1], window) >= window
    group_head = head.copy()
    group_head[tied[~whole]] = True
    in_group = ~(group_head & np.append(group_head[1:], True))
    group = np.cumsum(group_head)[in_group]
    places = sa[in_group]
    ok = valid[places]
    group, places = group[ok], places[ok]
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    leads = places[new][np.cumsum(new) - 1] if len(new) else places
    return piece, offset, valid, places[~new], leads[~new]


def _segments(o: np.ndarray, tag: np.ndarray, texts: list[bytes], window: int,
              most: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts as lists of (document, start, bytes) of at most ``most`` bytes; a
    longer text is cut so that every window lies in exactly one part."""
    some, size = [], 0
    for d, text in enumerate(texts):
        at = 0
        while at == 0 or at + window <= len(text):
            part = text[at:at + most - size] if at + most - size < len(text) else text[at:]
            if len(part) < min(window, len(text) - at) and some:
                yield some
                some, size = [], 0
                continue
            some.append((d, at, part))
            size += len(part)
            at = at + len(part) - window + 1 if at + len(part) < len(text) else len(text)
            if size + window > most:
                yield some
                some, size = [], 0
            if at >= len(text):
                break
    if some:
        yield some


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` bytes of ``data`` (all places).  Hashes of short
    stretches are combined into those of ``gram`` bytes."""
    part = 4 if gram % 4 == 0 else gram
    words = np.zeros(len(data) - part + 1, np.uint64)
    for k in range(part):
        words = words * np.uint64(0x100000001B3) + data[k:k + len(words)]
    words *= np.uint64(0x9E3779B97F4A7C15)
    words ^= words >> np.uint64(32)
    n = len(data) - gram + 1
    acc = np.zeros(n, np.uint64)
    for k in range(0, gram, part):
        acc = acc * np.uint64(0xC2B2AE3D27D4EB4F) + words[k:k + n]
    acc ^= acc >> np.uint64(31)
    acc *= np.uint64(0xD6E8FEB86659FD93)
    return acc ^ acc >> np.uint64(29)


def _minimisers(data: np.ndarray, gram: int, window: int) -> np.ndarray:
    """Smallest gram hash of every window of ``data`` (all places)."""
    return sliding_min(_gram_hashes(data, gram), window - gram + 1)


def _pieces_of(window: int, gram: int, most: int):
    """Minimiser, fingerprint (sum of the gram hashes) and windows of every piece."""
    def run(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for part in _segments(None, None, texts, window, most):
            pieces = [p for _, _, p in part]
            data = np.frombuffer(b"".join(pieces), np.uint8)
            if len(data) < window:
                continue
            piece = np.repeat(np.arange(len(pieces), dtype=np.int32), [len(p) for p in pieces])
            hashes = _gram_hashes(data, gram)
            least = sliding_min(hashes, window - gram + 1)
            starts = np.flatnonzero(piece[:len(least)] == piece[window - 1:])
            first, last = P.runs(starts, least[starts], piece[starts])
            a, b = starts[first], starts[last] + 1
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes)])
            yield least[a], total[b + window - gram] - total[a], b - a

    return run


def _shard_packs(window: int, gram: int, buckets: int, most: int, hot_values: Broadcast[np.ndarray],
                 hot_buckets: int):
    most_held = P.HELD_BYTES

    def work(shard: P.Shard) -> Iterator[tuple[int, bytes]]:
        import xxhash
        hot = hot_values.value
        o, tag, texts = shard.in_order()
        out: dict[int, list[tuple]] = {}
        held = 0
        spans = [[np.zeros(0, t) for t in ("<i8", "<i8", "<i4", "<i4")]]
        for part in _segments(o, tag, texts, window, most):
            doc = np.array([d for d, _, _ in part], np.int64)
            base = np.array([at for _, at, _ in part], np.int64)
            pieces = [p for _, _, p in part]
            data = b"".join(pieces)
            if len(data) < window:
                continue
            piece, offset, valid, late, _ = repeats(pieces, window)
            d = doc[piece[late]]
            spans.append(P.intervals(o[d], tag[d], base[piece[late]] + offset[late], window))
            goes = valid.copy()
            goes[late] = False
            least = _minimisers(np.frombuffer(data, np.uint8), gram, window)
            starts = np.flatnonzero(goes[:len(least)])
            first, last = P.runs(starts, least[starts], piece[starts])
            a, b, value = starts[first], starts[last] + window, least[starts[first]]
            bucket = ((value >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            single = P.among(value, hot)
            if single.any():
                # windows one by one, with bits of their own hash for the minimiser's
                n = (b - a - window + 1)[single]
                w = np.repeat(a[single], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                own = np.fromiter((xxhash.xxh64_intdigest(data[x:x + window]) for x in w.tolist()), np.uint64, len(w))
                to = buckets + ((own >> np.uint64(32)) % np.uint64(hot_buckets)).astype(np.int64)
                a, b, value, bucket = (np.concatenate([c[~single], x]) for c, x in (
                    (a, w), (b, w + window), (value, own), (bucket, to)))
            by = np.argsort(bucket, kind="stable")
            a, b, value, bucket = a[by], b[by], value[by], bucket[by]
            at = piece[a]
            columns = (o[doc[at]], tag[doc[at]], base[at] + offset[a], b - a, value)
            cut = np.flatnonzero(np.diff(bucket)) + 1
            for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(a)]) if len(a) else ():
                run = b"".join([data[x:y] for x, y in zip(a[i:j].tolist(), b[i:j].tolist())])
                out.setdefault(int(bucket[i]), []).append((*(c[i:j] for c in columns), run))
            held += int((b - a).sum())
            if held > most_held:
                none = [c[:0] for c in spans[0]]
                for k, rows in out.items():
                    yield k, _pack(rows, none)
                out, held = {}, 0
        local = [np.concatenate(c) for c in zip(*spans)]
        # the shard's own intervals go to a bucket by the shard, not to its first
        own = P.bucket_of_shard(o, tag, buckets)
        if len(local[0]):
            out.setdefault(own, [])
        none = [c[:0] for c in local]
        for k, rows in out.items():
            yield k, _pack(rows, local if k == own else none)

    return work


def _pack(rows: list[tuple], spans: list[np.ndarray]) -> bytes:
    """Pieces of a bucket: document, tag, start, length, some bytes of the
    minimiser and the bytes themselves; and the shard's own intervals."""
    o, tag, start, size, value = ([r[k] for r in rows] for k in range(5))
    join = lambda c, kind: np.concatenate([np.zeros(0, np.int64), *c]).astype(kind)
    low = np.concatenate([np.zeros(0, np.uint64), *value]).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :VALUE_BYTES]
    return P.pack([join(o, "<i8"), join(tag, "<i8"), join(start, "<i4"), join(size, "<i4"),
                   np.ascontiguousarray(low).ravel(), b"".join(r[5] for r in rows), *spans], level=1)


class _Merged:
    """Windows seen in a bucket, sorted, with the earliest place of each."""

    def __init__(self, window: int):
        self.windows = np.zeros(0, f"S{window}")
        self.place = np.zeros((0, 3), np.int64)

    def add(self, windows: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Merge sorted distinct windows by binary search; returns the places of
        windows that also start earlier."""
        at = np.searchsorted(self.windows, windows)
        known = np.zeros(len(windows), bool)
        inside = at < len(self.windows)
        known[inside] = self.windows[at[inside]] == windows[inside]
        mine, theirs = place[known], self.place[at[known]]
        earlier = np.zeros(len(mine), bool)
        same = np.ones(len(mine), bool)
        for k in range(3):
            earlier |= same & (mine[:, k] < theirs[:, k])
            same &= mine[:, k] == theirs[:, k]
        self.place[at[known][earlier]] = mine[earlier]
        late = np.where(earlier[:, None], theirs, mine)[~same]
        self.windows = np.insert(self.windows, at[~known], windows[~known])
        self.place = np.insert(self.place, at[~known], place[~known], axis=0)
        return late


def _chunk(pieces: list[bytes], o: np.ndarray, tag: np.ndarray, start: np.ndarray, window: int,
           distinct: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Late places of a chunk and, if asked, its sorted distinct windows with
    their places.  Pieces come in order of place."""
    piece, offset, valid, late, lead = repeats(pieces, window)

    def place(at: np.ndarray) -> np.ndarray:
        p = piece[at]
        return np.stack([o[p], tag[p], start[p] + offset[at]], axis=1).astype(np.int64)

    # a document given in two shards brings a place twice
    late_places, lead_places = place(late), place(lead)
    found = late_places[(late_places != lead_places).any(axis=1)]
    if not distinct:
        return found, None, None
    firsts = valid.copy()
    firsts[late] = False
    at = np.flatnonzero(firsts)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, window)[at]).view(f"S{window}").ravel()
    by = np.argsort(rows)
    return found, rows[by], place(at[by])


def _bucket(window: int, most: int):
    def run(rows: pa.Table) -> pa.Table:
        out, columns, pieces = [], [[] for _ in range(4)], []
        for payload in rows.column("payload"):
            po, pt, ps, size, value, data, *spans = P.unpack(payload.as_py())
            if len(spans[0]):
                out.append(spans)
            if len(po):
                ends = np.cumsum(size, dtype=np.int64)
                pieces.append((data, ends - size, ends))
                low = value.reshape(-1, VALUE_BYTES).astype(np.uint32)
                for c, x in zip(columns, (po, pt, ps, sum(low[:, k] << (8 * k) for k in range(VALUE_BYTES)))):
                    c.append(x)
        if not pieces:
            return P.interval_table(out)
        o, tag, start, value = (np.concatenate(c) for c in columns)
        which = np.repeat(np.arange(len(pieces)), [len(p[1]) for p in pieces])
        begin, end = np.concatenate([p[1] for p in pieces]), np.concatenate([p[2] for p in pieces])
        _, inverse = np.unique(value, return_inverse=True)
        shared = np.bincount(inverse)[inverse] > 1
        keep = np.flatnonzero(shared)
        keep = keep[np.lexsort((start[keep], tag[keep], o[keep]))]
        texts = [pieces[w][0][x:y] for w, x, y in zip(which[keep].tolist(), begin[keep].tolist(), end[keep].tolist())]
        # copies of a whole piece go at once; suffix arrays see different ones
        first, again = P.first_of_each(texts, o[keep], tag[keep], start[keep])
        if len(again):
            at = keep[again]
            out.append([o[at].astype("<i8"), tag[at].astype("<i8"), start[at].astype("<i4"),
                        (start[at] + (end - begin)[at]).astype("<i4")])
        _, inverse = np.unique(value[keep[first]], return_inverse=True)
        first = first[np.bincount(inverse)[inverse] > 1] if len(first) else first
        keep, texts = keep[first], [texts[i] for i in first.tolist()]
        sizes = np.cumsum([len(t) for t in texts]) if texts else np.zeros(0, np.int64)
        # chunks hold whole pieces: a piece is shorter than a segment of a shard
        late, merged, i = [], _Merged(window), 0
        one = len(sizes) == 0 or sizes[-1] <= most
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + most, "right")))
            part = keep[i:j]
            found, windows, places = _chunk(texts[i:j], o[part], tag[part], start[part].astype(np.int64), window, not one)
            late.append(found)
            if not one:
                late.append(merged.add(windows, places))
            i = j
        if late:
            at = np.concatenate(late)
            out.append(P.intervals(at[:, 0], at[:, 1], at[:, 2], window))
        return P.interval_table(out)

    return run


def sent_packs(docs: DataFrame, tag: Column, window: int, gram: int, shard_bytes: int, array_bytes: int,
               hot_pieces: int) -> DataFrame:
    """Packs of all shards, with the bucket each goes to."""
    workers_import(docs.sparkSession)
    buckets = P.bucket_count(docs, BUCKET_BYTES)
    hot = P.hot_minimisers(docs, _pieces_of(window, gram, array_bytes), window, hot_pieces)
    work = _shard_packs(window, gram, buckets, array_bytes, *hot)
    return P.keyed(docs, tag).mapInArrow(P.by_shard(work, shard_bytes), P.PACKS)


def repeated_spans(docs: DataFrame, tag: Column, window: int = WINDOW_BYTES, gram: int = GRAM_BYTES,
                   shard_bytes: int = SHARD_BYTES, array_bytes: int = ARRAY_BYTES,
                   hot_pieces: int = P.HOT_PIECES) -> DataFrame:
    """Byte intervals (_o, _tag, a, b) to remove, written once."""
    sent = sent_packs(docs, tag, window, gram, shard_bytes, array_bytes, hot_pieces)
    return stage_table(sent.groupBy("bucket").applyInArrow(_bucket(window, array_bytes), P.INTERVALS), "repeated-bytes")


_DEDUPED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digest(with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(*[batch.column(k) for k in range(3)]):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                gone = P.covered(len(data), spans.as_py())
                kept = data[~gone].tobytes()
                edges = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((doc_id.as_py(), len(data), int(gone.sum()), edges, hashlib.sha256(kept).hexdigest(), kept))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            columns = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 6, types)]
            n = 6 if with_bytes else 5
            yield pa.RecordBatch.from_arrays(columns[:n], names=names[:n])
    return run


def dedup_bytes(docs: DataFrame, window: int = WINDOW_BYTES, gram: int = GRAM_BYTES,
                shard_bytes: int = SHARD_BYTES, array_bytes: int = ARRAY_BYTES,
                with_bytes: bool = False, hot_pieces: int = P.HOT_PIECES) -> DataFrame:
    """Remove repeated byte strings from ``docs`` (doc_id, text), a row per row:
    doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and,
    if asked, the kept bytes (which may cut a character).

    NULL text is empty; texts shorter than a window lose nothing.  Documents go
    by doc_id (NULL last), rows that share a doc_id by the hash of their text;
    rows equal in both are one document and get its result each.  An empty table
    gives none; other columns are ignored.  Texts of any length go whole, longer
    ones in parts that overlap by a window less one byte."""
    tag = row_tag(docs)
    found = repeated_spans(docs, tag, window, gram, shard_bytes, array_bytes, hot_pieces)
    release(docs.sparkSession)
    rows = P.with_spans(docs, tag, found)
    return rows.mapInArrow(_digest(with_bytes), _DEDUPED + (", kept binary" if with_bytes else ""))


def op4_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dedup_bytes`` over the whole documents table (NULL text: empty; repeated
    rows get their document's result each; an empty table gives none; other
    columns are ignored)."""
    return dedup_bytes(table(spark, sf_dir, "documents"))


SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS i FROM d),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte,
  CASE WHEN 2 * (i + {WINDOW_BYTES}) <= length(h) THEN md5(substr(h, 2 * i + 1, {2 * WINDOW_BYTES})) END AS win FROM p),
r AS (SELECT doc_id, i, byte,
  CASE WHEN win IS NULL THEN 0 WHEN row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1 THEN 1 ELSE 0 END AS again FROM w),
c AS (SELECT doc_id, i, byte, max(again) OVER (PARTITION BY doc_id ORDER BY i
  ROWS BETWEEN {WINDOW_BYTES - 1} PRECEDING AND CURRENT ROW) AS gone FROM r),
s AS (SELECT *, CASE WHEN gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), 0) = 0
  THEN 1 ELSE 0 END AS opens FROM c),
k AS (SELECT doc_id, count(*) AS n_bytes, sum(gone)::BIGINT AS n_removed, sum(opens)::BIGINT AS n_spans,
  string_agg(byte, '' ORDER BY i) FILTER (gone = 0) AS kept FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_bytes, 0)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

QUERIES = {"op4_suffix_arrays": op4_suffix_arrays}
ORACLES = {"op4_suffix_arrays": SQL}
