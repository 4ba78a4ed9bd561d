"""Operator 11, best-fit packing after a dominance reduction.

Lengths lie between 1 and the sequence length, so a packing instance is a
histogram of that many counts, whatever the number of documents:

1. tasks tokenise and cut the documents and number the pieces of each length;
2. on the histogram, sets of one to three lengths that provably dominate every
   other set with their longest piece are fixed, many at once, until no set is
   left to fix (Martello and Toth's reduction);
3. the rest is packed best fit, longest first, again many equal pieces at once;
4. both leave runs of equal pieces, and every piece finds its sequence and
   offset from its own number by binary search.

The driver sees counts by length and runs of them, never documents.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.common import stage_table, table, workers_import

#: Fixed values of the query: tokens of a sequence, id after each document.
SEQUENCE_TOKENS, END_ID = 4096, 1
#: A task forgets its words when it knows so many, or so many ids of theirs.
KNOWN_WORDS, KNOWN_IDS = 600_000, 6_000_000
#: Latin-1 texts, without the controls about whose class libraries differ.
PLAIN = re.compile("[\x00-\x1b\x20-\x84\x86-\xff]*")
#: The tokenizer's pre-token pattern on lower-cased Latin-1.
_LETTERS, _NUMBERS, _SPACES = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\x09-\x0d\x20\xa0"
PRETOKENS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}{_SPACES}]+")
#: The characters that stand for bytes in the vocabulary; those
#: without a visible one take the next from 256 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: 0x100 + i for i, b in enumerate(b for b in range(0x100) if b not in _VISIBLE)}

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"
_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
#: Room for a rank within one length in a search key.
_RANK_BITS = 48


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer file (never copied into the repository)."""
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class _Numbers(dict):
    """Numbers words as they come and keeps the new ones apart."""

    def __init__(self):
        super().__init__()
        self.new: list[str | bytes] = []

    def __missing__(self, word: str | bytes) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class _Vocabulary:
    """Ids of the words met so far; each is encoded once.

    In texts of Latin-1 characters, whose normal form and lower case are plain,
    a word is a pre-token (kept as str) and goes to the tokenizer's model.  In
    others it is a run without white space, which ends every pre-token (kept as
    bytes), and goes through the whole tokenizer."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.number = _Numbers()
        self.starts, self.sizes = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(4096, "<u4"), 0

    def _encode(self, word: str | bytes) -> list[int]:
        if isinstance(word, str):
            return [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(BYTE_CHARS))]
        return self.tokenizer.encode(word.decode(), add_special_tokens=False).ids

    def _learn(self) -> None:
        new, self.number.new = self.number.new, []
        found = [self._encode(w) for w in new]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        last, first = len(self.number), len(self.number) - len(new)
        if last > len(self.sizes):
            self.starts, self.sizes = (np.concatenate([x, np.zeros(last, np.int64)]) for x in (self.starts, self.sizes))
        end = self.used + int(sizes.sum())
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(end, "<u4")])
        self.sizes[first:last], self.starts[first:last] = sizes, self.used + np.cumsum(sizes) - sizes
        self.flat[self.used:end] = np.fromiter(chain.from_iterable(found), "<u4", end - self.used)
        self.used = end

    def ids(self, text: str) -> np.ndarray:
        if len(self.number) > KNOWN_WORDS or self.used > KNOWN_IDS:
            self._forget()
        if PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            words = PRETOKENS.findall(text.lower())
        else:
            words = text.encode("utf-8", "replace").split()
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        if self.number.new:
            self._learn()
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(total)]


def _cut(path: str, capacity: int, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Step 1: pieces of every document; ``place`` numbers a task's pieces of
    one length."""
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, places, known = TaskContext.get().partitionId(), [0] * (capacity + 1), _Vocabulary(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(known.ids(text.as_py() or ""), np.array([end_id], "<u4")).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    n = len(part)
                    rows.append((doc_id, piece, start, n, zlib.crc32(part.tobytes()), task, places[n]))
                    places[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 7, types)],
                                             names=names)

    return run


def _dominating(left: np.ndarray, w: int, capacity: int) -> tuple[int, ...] | None:
    """A set with length ``w`` that dominates every other set with it: parts of
    the other set can be exchanged, part by part, for at least as long pieces of
    this one, so some best packing holds it.  None if no rule proves one."""
    room = capacity - w
    left[w] -= 1
    try:
        fits = np.flatnonzero(left[:room + 1])
        if len(fits) == 0:
            return (w,)
        k = int(fits[-1])
        if k == room:
            return (w, k)  # whatever else goes with w is no longer than k
        small = np.repeat(fits[:3], np.minimum(left[fits[:3]], 3))[:3].tolist()
        if len(small) < 2 or small[0] + small[1] > room:
            return (w, k)  # only one more fits, and k is the longest
        if len(small) > 2 and sum(small) <= room:
            return None
        # at most two more fit; the best partner of each length:
        best = fits[np.maximum(np.searchsorted(fits, room - fits, "right") - 1, 0)]
        ok = (fits + best <= room) & ((fits != best) | (left[fits] > 1))
        # a length that is its own best partner but comes once takes the next shorter
        alone = (fits == best) & (left[fits] == 1)
        sums = np.where(ok, fits + best, 0)
        for i in np.flatnonzero(alone).tolist():
            if i:
                sums[i] = fits[i] + fits[i - 1] if fits[i] + fits[i - 1] <= room else 0
        if k >= sums.max():
            return (w, k)
        left[k] -= 1
        partners = np.flatnonzero(left[:room - k + 1])
        left[k] += 1
        if len(partners) == 0:
            return None
        b = int(partners[-1])
        above = fits[fits > b]
        two = np.repeat(above[:2], np.minimum(left[above[:2]], 2))[:2].tolist()
        if len(two) == 2 and sum(two) <= room:
            return None  # a pair longer than b in both parts fits as well
        return (w, k, b)
    finally:
        left[w] += 1


def fixed_sets(counts: np.ndarray, capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Step 2: (lengths, times) of the sets fixed, and the counts that remain.

    A rule that holds for a set holds for as many copies as its scarcest length
    allows: taking pieces away leaves fewer sets to dominate."""
    left, fixed, again = counts.astype(np.int64).copy(), [], True
    while again:
        again = False
        for w in range(capacity, 0, -1):
            while left[w] > 0:
                found = _dominating(left, w, capacity)
                if found is None:
                    break
                need = Counter(found)
                times = int(min(left[x] // n for x, n in need.items()))
                for x, n in need.items():
                    left[x] -= n * times
                fixed.append((found, times))
                again = True
    return fixed, left


def _best_fit(left: np.ndarray, capacity: int, next_sequence: int, ranks: np.ndarray) -> list[tuple]:
    """Step 3: best fit of the remaining counts, longest first.  Sequences with
    the same room are kept as runs of numbers."""
    runs: dict[int, list[tuple[int, int]]] = {}
    rooms = np.zeros(capacity + 1, bool)
    out = []

    def put_back(room: int, start: int, n: int) -> None:
        if n and room:
            runs.setdefault(room, []).append((start, n))
            rooms[room] = True

    for w in range(capacity, 0, -1):
        n = int(left[w])
        while n:
            fitting = np.flatnonzero(rooms[w:])
            if len(fitting):
                room = int(fitting[0]) + w
                start, m = runs[room].pop()
                rooms[room] = bool(runs[room])
            else:
                room, start = capacity, next_sequence
                m = -(-n // (capacity // w))
                next_sequence += m
            each = room // w
            full = min(m, n // each)
            if full:
                taken = full * each
                put_back(room - each * w, start, full)
            else:
                full, each, taken = 1, n, n
                put_back(room - n * w, start, 1)
            out.append((w, int(ranks[w]), taken, start, each, capacity - room))
            put_back(room, start + full, m - full)
            ranks[w] += taken
            n -= taken
    return out


def plan(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (length, first rank, pieces, first sequence, pieces in each
    sequence, offset of the first) that place every piece of the histogram
    ``counts``; their number depends on ``capacity``, not on the counts."""
    fixed, left = fixed_sets(counts, capacity)
    ranks, sequence, out = np.zeros(capacity + 1, np.int64), 0, []
    for lengths, times in fixed:
        offset = 0
        for x, n in Counter(lengths).items():
            out.append((x, int(ranks[x]), n * times, sequence, n, offset))
            ranks[x] += n * times
            offset += n * x
        sequence += times
    out += _best_fit(left, capacity, sequence, ranks)
    rows = np.array(out, np.int64).reshape(-1, 6)
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def least_number(counts: np.ndarray, capacity: int) -> int:
    """No packing of ``counts`` has fewer sequences: longer pieces than half a
    sequence lie apart, and for every k the pieces of at least k that do not fit
    beside them need room of their own."""
    length = np.arange(capacity + 1)
    best = 0
    for k in range(capacity // 2 + 1):
        alone = counts[length > capacity - k].sum()
        long = (length > capacity // 2) & (length <= capacity - k)
        short = (length >= k) & (length <= capacity // 2)
        room = counts[long].sum() * capacity - (counts * length)[long].sum()
        more = (counts * length)[short].sum() - room
        best = max(best, int(alone + counts[long].sum() + max(0, -(-more // capacity))))
    return best


def _place(rows: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Step 4: sequence and offset of every piece by its rank in its length."""
    keys = (rows[:, 0] << _RANK_BITS) | rows[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = rows[np.searchsorted(keys, (length << _RANK_BITS) | rank, "right") - 1]
            within = rank - at[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(at[:, 3] + within // at[:, 4]), pa.array(at[:, 5] + within % at[:, 4] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, path: str, capacity: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Pack all texts of ``docs`` (doc_id, text) into sequences of at most
    ``capacity`` tokens.

    Returns a row per piece: doc_id, piece, start (ids of its document before
    it), length, ids_crc32, sequence_id (from 0, without gaps) and offset.  A
    NULL or empty text is the end id alone.  A document longer than a sequence
    is cut into whole sequences and a rest.  Repeated rows are packed each, a
    NULL doc_id stays NULL, an empty table gives no row.  Which of equally long
    pieces takes which place is free.  Other columns of ``docs`` are ignored."""
    workers_import(docs.sparkSession)
    pieces = stage_table(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                         .mapInArrow(_cut(path, capacity, end_id), _PIECES), "pieces")
    totals = stage_table(pieces.groupBy("length", "task").agg((F.max("place") + 1).alias("n")), "piece_totals")
    counts = np.zeros(capacity + 1, np.int64)
    for r in totals.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row a length
        counts[r["length"]] = r["n"]
    # one row a task in each window, not one a piece
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("length").alias("_l"), F.col("task").alias("_t"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    ranked = pieces.join(starts, (F.col("length") == F.col("_l")) & (F.col("task") == F.col("_t"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("place")).alias("rank"))
    return ranked.mapInArrow(_place(plan(counts, capacity)), _PACKED)


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pack`` over the whole documents table (NULL text: empty; repeated rows:
    a place each; an empty table: no row; other columns are ignored)."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {"op11_best_fit": op11_best_fit}
ORACLES: dict[str, str] = {}
