"""Operator 2, substring dedup by super-k-mers.

A window is k consecutive words; its minimiser is the smallest hash among its
m-word grams.  Consecutive windows with one minimiser travel as one packed
string to the bucket of that minimiser, so a window costs about three words of
shuffle instead of k, and equal windows always meet.  In the bucket, sorting
word ranks counts the windows exactly; all but the first occurrence of a window
are removed.

Copies within a shard (a stretch of a task's rows) collapse before the shuffle:
a packed string that the shard has already sent is marked at once, so a passage
in a third of all rows reaches its bucket once per shard.  Minimisers of very many
different pieces (edges of such passages, frequent grams) are counted before; their
windows are dealt singly by the hash of the window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession

from orderlens.llm import packs as P
from orderlens.llm.common import release, row_tag, stage_table, table, workers_import

WINDOW_WORDS, GRAM_WORDS = 20, 3
#: Text bytes of a shard, and of what one bucket gets on average.
SHARD_BYTES, BUCKET_BYTES = 6_000_000, 4_000_000
#: Bits of a minimiser that go along; the bit above them marks a piece which may
#: repeat a window within itself.
VALUE_BITS = 0x7FFFFFFF
#: Bytes of one window, about, for the number of buckets of single windows.
ABOUT_BYTES = 130
#: Two ranks and a place of so many bits fit one sort key.
RANK_BITS = 21


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every stretch of ``width`` values."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return x if size == width else np.minimum(x[:len(x) - (width - size)], x[width - size:])


def gram_hashes(hashes: np.ndarray, m: int) -> np.ndarray:
    """Hash of every m consecutive word hashes."""
    acc = np.zeros(max(len(hashes) - m + 1, 0), np.uint64)
    for k in range(m):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + len(acc)]
    acc ^= acc >> np.uint64(32)
    acc *= np.uint64(0xD6E8FEB86659FD93)
    return acc ^ (acc >> np.uint64(29))


class _Known(dict):
    """Values of words by a function, each worked out once."""

    def __init__(self, value: Callable):
        self.value = value

    def __missing__(self, word: bytes) -> int:
        self[word] = v = self.value(word)
        return v

    def of(self, words, count: int, kind) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), kind, count)


def _pieces_of(window: int, gram: int):
    """Minimiser, fingerprint (sum of the gram hashes) and windows of every piece."""
    def run(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        import xxhash
        known = _Known(xxhash.xxh64_intdigest)
        for data in texts:
            words = data.split()
            if len(words) < window:
                continue
            grams = gram_hashes(known.of(words, len(words), np.uint64), gram)
            least = sliding_min(grams, window - gram + 1)
            a = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
            b = np.append(a[1:], len(least))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(grams)])
            yield least[a], total[b + window - gram] - total[a], b - a

    return run


def _shard_packs(window: int, gram: int, buckets: int, hot_values: Broadcast[np.ndarray], hot_buckets: int):
    most_held = P.HELD_BYTES

    def work(shard: P.Shard) -> Iterator[tuple[int, bytes]]:
        import xxhash
        hot = hot_values.value
        o, tag, texts = shard.in_order()
        known = _Known(xxhash.xxh64_intdigest)
        sent: set[bytes] = set()
        single: set[bytes] = set()
        out: dict[int, list] = {}
        local = []
        held = 0

        def packs(spans: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
            for bucket, rows in out.items():
                d = np.array([r[0] for r in rows], np.int64)
                yield bucket, P.pack([
                    o[d].astype("<i8"), tag[d].astype("<i8"), np.array([r[1] for r in rows], "<i4"),
                    np.array([r[2] for r in rows], "<u4"), b"\n".join(r[3] for r in rows), *spans])
                spans = [s[:0] for s in spans]

        none = [np.zeros(0, t) for t in ("<i8", "<i8", "<i4", "<i4")]
        for d, data in enumerate(texts):
            words = data.split()
            if len(words) < window:
                continue
            grams = gram_hashes(known.of(words, len(words), np.uint64), gram)
            least = sliding_min(grams, window - gram + 1)
            # only a run that holds its minimiser twice can repeat a window
            twice = len(np.unique(grams)) < len(grams)
            cut = np.flatnonzero(least[1:] != least[:-1]) + 1
            first, last = [0, *cut.tolist()], [*cut.tolist(), len(least)]
            joined = b" ".join(words)
            starts = [0, *np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1).tolist()]
            values = least[first]
            for a, b, value, one_by_one in zip(first, last, values.tolist(), P.among(values, hot).tolist()):
                piece = joined[starts[a]:starts[b + window - 1] - 1]
                if piece in sent:
                    local.append((d, a, b))
                    continue
                sent.add(piece)
                if one_by_one:
                    # windows one by one, with bits of their own hash for the minimiser's
                    for at in range(a, b):
                        one = joined[starts[at]:starts[at + window] - 1]
                        if one in single:
                            local.append((d, at, at + 1))
                            continue
                        single.add(one)
                        own = xxhash.xxh64_intdigest(one)
                        out.setdefault(buckets + (own >> 32) % hot_buckets, []).append((d, at, own & VALUE_BITS, one))
                        held += len(one)
                    continue
                again = twice and np.count_nonzero(grams[a:b + window - gram] == value) > 1
                out.setdefault((value >> 32) % buckets, []).append((d, a, value & VALUE_BITS | again << 31, piece))
                held += len(piece)
            if held > most_held:
                yield from packs(none)
                out, held = {}, 0
        spans = none
        if local:
            at = np.array(local, np.int64)
            spans = [o[at[:, 0]].astype("<i8"), tag[at[:, 0]].astype("<i8"), at[:, 1].astype("<i4"),
                     (at[:, 2] + window - 1).astype("<i4")]
            out.setdefault(int(o[0]) % buckets, [])
        yield from packs(spans)

    return work


def window_ranks(ids: np.ndarray, window: int) -> np.ndarray:
    """Equal numbers for equal windows of ``ids`` and for no others: pairs of
    ranks are sorted into ranks of twice the length."""
    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n, place = len(a), np.uint64(RANK_BITS)
        if max(n, a.max(initial=0) + 1, b.max(initial=0) + 1) > 1 << RANK_BITS:
            return np.unique(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64), return_inverse=True)[1]
        # both ranks and the place in one word: sorting values beats sorting indices
        key = (a.astype(np.uint64) << place | b.astype(np.uint64)) << place | np.arange(n, dtype=np.uint64)
        key.sort()
        pair = key >> place
        out = np.empty(n, np.int64)
        new = np.zeros(n, np.int64)
        new[1:] = pair[1:] != pair[:-1]
        out[(key & np.uint64((1 << RANK_BITS) - 1)).astype(np.int64)] = np.cumsum(new)
        return out

    powers, size = {1: ids}, 1
    while size * 2 <= window:
        x = powers[size]
        powers[size * 2] = join(x[:len(x) - size], x[size:])
        size *= 2
    out, length = powers[size], size
    while length < window:
        size = max(s for s in powers if s <= window - length)
        n = len(ids) - length - size + 1
        out, length = join(out[:n], powers[size][length:length + n]), length + size
    return out


def repeated_windows(pieces: list[bytes], o: np.ndarray, tag: np.ndarray, start: np.ndarray,
                     window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(o, tag, start) of every window of the pieces that also starts earlier.
    Occurrences at one place of one document are the same occurrence."""
    lists = [p.split(b" ") for p in pieces]
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    number = _Known(lambda word: len(number))
    ids = number.of(chain.from_iterable(lists), int(size.sum()), np.int64)
    piece = np.repeat(np.arange(len(pieces)), size)
    offset = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
    whole = np.flatnonzero(offset + window <= size[piece])
    rank = window_ranks(ids, window)[whole]
    piece, offset = piece[whole], offset[whole]
    wo, wt, ws = o[piece], tag[piece], start[piece] + offset
    by = np.lexsort((ws, wt, wo, rank))
    rank, wo, wt, ws = rank[by], wo[by], wt[by], ws[by]
    again = np.zeros(len(rank), bool)
    again[1:] = rank[1:] == rank[:-1]
    # the first place may come more than once (a document given in two shards)
    group = np.cumsum(~again) - 1
    head = np.flatnonzero(~again)
    lead = head[group]
    late = again & ((wo != wo[lead]) | (wt != wt[lead]) | (ws != ws[lead]))
    return wo[late], wt[late], ws[late]


def _bucket(window: int):
    def run(rows: pa.Table) -> pa.Table:
        o, tag, start, value, pieces, out = [], [], [], [], [], []
        for payload in rows.column("payload"):
            po, pt, ps, pv, text, *spans = P.unpack(payload.as_py())
            out.append(spans)
            if len(po):
                o.append(po)
                tag.append(pt)
                start.append(ps)
                value.append(pv)
                pieces.append(text)
        if value:
            every = np.concatenate(value)
            _, inverse, count = np.unique(every & VALUE_BITS, return_inverse=True, return_counts=True)
            lengths = np.array([len(v) for v in value])
            shared = (count[inverse] > 1) | (every > VALUE_BITS)
            keep = np.flatnonzero(shared)
            if len(keep):
                texts = [p for text, flags in zip(pieces, np.split(shared, np.cumsum(lengths)[:-1])) if flags.any()
                         for p, f in zip(text.split(b"\n"), flags.tolist()) if f]
                ko, kt, ks = (np.concatenate(c)[keep] for c in (o, tag, start))
                by = np.lexsort((ks, kt, ko))
                keep, ko, kt, ks, texts = keep[by], ko[by], kt[by], ks[by].astype(np.int64), [texts[i] for i in by]
                # copies of a whole piece go at once; windows are counted in different ones
                first, again = P.first_of_each(texts, ko, kt, ks)
                if len(again):
                    size = np.fromiter((texts[i].count(b" ") + 1 for i in again), np.int64, len(again))
                    out.append([ko[again].astype("<i8"), kt[again].astype("<i8"), ks[again].astype("<i4"),
                                (ks[again] + size).astype("<i4")])
                mark = every[keep[first]]
                _, inverse = np.unique(mark & VALUE_BITS, return_inverse=True)
                first = first[(np.bincount(inverse)[inverse] > 1) | (mark > VALUE_BITS)]
                if len(first):
                    found = repeated_windows([texts[i] for i in first], ko[first], kt[first], ks[first], window)
                    out.append(P.intervals(*found, window))
        return P.interval_table(out)

    return run


def sent_packs(docs: DataFrame, tag: Column, window: int, gram: int, shard_bytes: int, hot_pieces: int) -> DataFrame:
    """Packs of all shards, with the bucket each goes to."""
    workers_import(docs.sparkSession)
    buckets = P.bucket_count(docs, BUCKET_BYTES)
    hot = P.hot_minimisers(docs, _pieces_of(window, gram), ABOUT_BYTES, hot_pieces)
    work = _shard_packs(window, gram, buckets, *hot)
    return P.keyed(docs, tag).mapInArrow(P.by_shard(work, shard_bytes), P.PACKS)


def repeated_spans(docs: DataFrame, tag: Column, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS,
                   shard_bytes: int = SHARD_BYTES, hot_pieces: int = P.HOT_PIECES) -> DataFrame:
    """Word intervals (_o, _tag, a, b) to remove, written once."""
    sent = sent_packs(docs, tag, window, gram, shard_bytes, hot_pieces)
    return stage_table(sent.groupBy("bucket").applyInArrow(_bucket(window), P.INTERVALS), "repeated-words")


_DEDUPED = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _digest(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(*[batch.column(k) for k in range(3)]):
                words = (text.as_py() or "").encode().split()
                gone = P.covered(len(words), spans.as_py())
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                out.append((doc_id.as_py(), len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(),
                            kept.decode()))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
            columns = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5, types)]
            n = 5 if with_text else 4
            yield pa.RecordBatch.from_arrays(columns[:n], names=names[:n])
    return run


def dedup_windows(docs: DataFrame, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS,
                  shard_bytes: int = SHARD_BYTES, with_text: bool = False,
                  hot_pieces: int = P.HOT_PIECES) -> DataFrame:
    """Remove repeated word windows from ``docs`` (doc_id, text), a row per row:
    doc_id, n_words, n_removed, kept_sha256 and, if asked, the kept text.

    NULL text has no words; fewer words than a window lose none.  Documents go
    by doc_id (NULL last), rows that share a doc_id by the hash of their text;
    rows equal in both are one document and get its result each.  An empty table
    gives none; other columns are ignored.  Texts of any length go whole."""
    tag = row_tag(docs)
    found = repeated_spans(docs, tag, window, gram, shard_bytes, hot_pieces)
    release(docs.sparkSession)
    rows = P.with_spans(docs, tag, found)
    return rows.mapInArrow(_digest(with_text), _DEDUPED + (", kept string" if with_text else ""))


def op2_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dedup_windows`` over the whole documents table (NULL and empty texts keep
    nothing and lose nothing; repeated rows get their document's result each; an
    empty table gives none; other columns are ignored)."""
    return dedup_windows(table(spark, sf_dir, "documents"))


SQL = f"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM d),
w AS (SELECT doc_id, i, words[i] AS word,
  CASE WHEN i + {WINDOW_WORDS - 1} <= len(words) THEN array_to_string(words[i:i + {WINDOW_WORDS - 1}], ' ') END AS win FROM p),
r AS (SELECT doc_id, i, word,
  CASE WHEN win IS NULL THEN 0 WHEN row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1 THEN 1 ELSE 0 END AS again FROM w),
c AS (SELECT doc_id, i, word, max(again) OVER (PARTITION BY doc_id ORDER BY i
  ROWS BETWEEN {WINDOW_WORDS - 1} PRECEDING AND CURRENT ROW) AS gone FROM r),
k AS (SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed,
  string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

QUERIES = {"op2_super_kmers": op2_super_kmers}
ORACLES = {"op2_super_kmers": SQL}
