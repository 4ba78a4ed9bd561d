"""Operator 10, byte-level BPE encoding and decoding by distinct words.

A word's ids do not depend on the text around it, so each distinct word of the
corpus is encoded once:

1. texts are exploded into pre-tokens with positions, chunk by chunk: a chunk
   keeps its texts as numbers into its own list of distinct words;
2. the word lists go to word buckets, each distinct word is encoded there once,
   and the ids return to the chunks that asked;
3. each chunk puts its texts together by position and decodes the ids by the
   token-byte table.

A frequent word travels once per chunk, however often it stands in the corpus.
The numbered texts stay where they are written (a table bucketed by chunk); only
word lists and their ids are shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import shuffle_partitions, stage_path, table, workers_import

#: A chunk ends when it has so many distinct words or characters of text.
CHUNK_WORDS = 200_000
CHUNK_CHARS = 16_000_000
#: Word buckets per shuffle partition.
PARTS_PER_PARTITION = 4

#: White space of the pre-token pattern (Unicode White_Space).
SPACES = ((0x9, 0xD), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
          (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
#: The pattern's contractions.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3

DOCS = -1
_CHUNKED = "chunk long, part int, doc_id long, n_bytes long, payload binary"
_IDS = "chunk long, part int, payload binary"
_ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Place of a public vocabulary file (never copied into the repository)."""
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: all tokens in one byte array, by rank their start
    and length."""
    ranks = load_ranks(path)
    size = max(ranks.values()) + 1
    lengths = np.zeros(size, np.int64)
    tokens = [b""] * size
    for token, rank in ranks.items():
        tokens[rank], lengths[rank] = token, len(token)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    import regex
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, range(0xD800))) + "" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            out[m.start():m.end()] = kind
    for a, b in SPACES:
        out[a:b + 1] = SPACE
    return out


def pretoken_starts(text: str) -> np.ndarray:
    """Where the pre-tokens of a text start, in code points.

    A pre-token is a run of one class.  A single blank before a run belongs to
    it; longer white space before a run gives up its last character; the
    contractions split after an apostrophe that starts a pre-token."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = char_classes()[points]
    first = np.empty(n, bool)
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    runs = np.flatnonzero(first)
    space = kind[runs] == SPACE
    start = first
    after = runs[(~space) & (runs > 0)]
    start[after[points[after - 1] == 0x20]] = False
    # white space runs of two or more before something else
    ends = np.append(runs[1:], n)
    long = space & (ends - runs > 1) & (ends < n)
    start[ends[long] - 1] = True
    marks = np.flatnonzero(points == 0x27)
    for p in marks[start[marks]].tolist():
        for tail in CONTRACTIONS:
            if text.startswith(tail, p + 1):
                start[p + 1] = False
                if p + 1 + len(tail) < n:
                    start[p + 1 + len(tail)] = True
                break
    return np.flatnonzero(start)


def pretokens(text: str) -> list[str]:
    starts = pretoken_starts(text).tolist()
    return [text[a:b] for a, b in zip(starts, starts[1:] + [len(text)])]


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the pair of lowest rank, the leftmost first, until none is left."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > 200:
        return _encode_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
    while pairs:
        low = min(pairs)
        if low == 1 << 60:
            break
        i = pairs.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
    return [ranks[p] for p in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for long words, by a heap over a linked list of parts."""
    n = len(word)
    end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = []

    def push(i: int) -> None:
        j = right[i]
        if j < n:
            rank = ranks.get(word[i:end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[i], end[j]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, middle, last = heapq.heappop(heap)
        j = right[i] if alive[i] else n
        if not alive[i] or end[i] != middle or j >= n or end[j] != last:
            continue
        end[i], right[i], alive[j] = last, right[j], False
        if right[j] < n:
            left[right[j]] = i
        if left[i] >= 0:
            push(left[i])
        push(i)
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


class _Words(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 by byte planes, which compress better."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _word_part(word: bytes, parts: int) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little") % parts


def _number_texts(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Step 1: rows of texts as numbers, and of the chunk's words by bucket."""
    schema = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("doc_id", pa.int64()),
                        ("n_bytes", pa.int64()), ("payload", pa.binary())])

    def flush(chunk: int, words: _Words, docs: list) -> Iterator[pa.RecordBatch]:
        by_part: dict[int, list[tuple[bytes, int]]] = {}
        for word, number in words.items():
            raw = word.encode()
            by_part.setdefault(_word_part(raw, parts), []).append((raw, number))
        place = np.empty(len(words), np.int64)
        at, pack = 0, zstandard.ZstdCompressor(level=3)
        rows = []
        for part in sorted(by_part):
            entries = sorted(by_part[part])
            place[[n for _, n in entries]] = np.arange(at, at + len(entries))
            at += len(entries)
            sizes = np.array([len(w) for w, _ in entries], "<u4").tobytes()
            rows.append((chunk, part, None, None, pack.compress(
                len(entries).to_bytes(4, "little") + sizes + b"".join(w for w, _ in entries))))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema) \
            if rows else pa.RecordBatch.from_pylist([], schema=schema)
        for i in range(0, len(docs), 500):
            some = docs[i:i + 500]
            yield pa.RecordBatch.from_arrays([
                pa.array([chunk] * len(some), pa.int64()), pa.array([DOCS] * len(some), pa.int32()),
                pa.array([d[0] for d in some], pa.int64()), pa.array([d[1] for d in some], pa.int64()),
                pa.array([_planes(place[d[2]]) for d in some], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, words, docs, chars = TaskContext.get().partitionId() << 32, _Words(), [], 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                numbers = np.fromiter(map(words.__getitem__, pretokens(text)), np.int64)
                docs.append((ids[i].as_py(), len(text.encode()), numbers))
                chars += len(text)
                if len(words) >= CHUNK_WORDS or chars >= CHUNK_CHARS:
                    yield from flush(chunk, words, docs)
                    chunk, words, docs, chars = chunk + 1, _Words(), [], 0
        if docs:
            yield from flush(chunk, words, docs)

    return run


def _unpack_words(data: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(data[:4], "little")
    ends = (np.cumsum(np.frombuffer(data, "<u4", n, 4), dtype=np.int64) + 4 + 4 * n).tolist()
    return [data[a:b] for a, b in zip([4 + 4 * n, *ends], ends)]


def _encode_words(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Step 2: word lists, sorted by bucket, become lists of ids."""
    schema = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, known, now = load_ranks(path), {}, None
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, part, data = (batch.column(k)[i].as_py() for k in range(3))
                if part != now:
                    known, now = {}, part
                ids = []
                for word in _unpack_words(data):
                    got = known.get(word)
                    if got is None:
                        got = known[word] = np.array(encode_word(word, ranks), "<u4").tobytes()
                    ids.append(got)
                sizes = np.array([len(x) >> 2 for x in ids], "<u4")
                flat = np.frombuffer(b"".join(ids), "<u4")
                out = pack.compress(len(ids).to_bytes(4, "little") + _planes(sizes) + _planes(flat))
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([part], pa.int32()),
                                                  pa.array([out], pa.binary())], schema=schema)

    return run


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces flat[start:start+size], one after the other."""
    ends = np.cumsum(sizes)
    if len(ends) == 0:
        return flat[:0]
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])]


def decode(ids: np.ndarray, path: str) -> bytes:
    """Bytes of token ids by the token-byte table, in blocks."""
    data, starts, sizes = token_bytes(path)
    return b"".join(_gather(data, starts[ids[i:i + 1_000_000]], sizes[ids[i:i + 1_000_000]]).tobytes()
                    for i in range(0, len(ids), 1_000_000))


def _reassemble(path: str, with_ids: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Step 3: a chunk's texts from its words' ids."""
    def run(docs: pa.Table, ids: pa.Table) -> pa.Table:
        parts = sorted(zip(ids.column("part").to_pylist(), ids.column("payload").to_pylist()))
        all_sizes, all_ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, data in parts:
            data = zstandard.ZstdDecompressor().decompress(data)
            n = int.from_bytes(data[:4], "little")
            all_sizes.append(_from_planes(data[4:4 + 4 * n]))
            all_ids.append(_from_planes(data[4 + 4 * n:]))
        sizes, flat = np.concatenate(all_sizes), np.concatenate(all_ids)
        starts = np.cumsum(sizes) - sizes
        out = []
        for doc_id, data in zip(docs.column("doc_id").to_pylist(), docs.column("payload")):
            numbers = _from_planes(data.as_py())
            found = _gather(flat, starts[numbers], sizes[numbers])
            out.append((doc_id, len(found), hashlib.sha256(found.astype("<u4").tobytes()).hexdigest(),
                        hashlib.sha256(decode(found, path)).hexdigest(), found.tolist() if with_ids else None))
        columns = list(zip(*out)) or [[]] * 5
        types = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
        types |= {"ids": pa.list_(pa.int32())} if with_ids else {}
        return pa.table({k: pa.array(c, t) for (k, t), c in zip(types.items(), columns)})

    return run


def encode_documents(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Encode every text of ``docs`` (doc_id, text) and decode it again.

    Returns doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit
    integers) and decoded_sha256 (bytes decoded from the ids), a row per row;
    ``with_ids`` adds the ids.  NULL text counts as empty: no tokens.  Repeated
    rows return a row each, a NULL doc_id stays NULL, an empty table gives none.
    Other columns of ``docs`` are ignored.  A text of any length is one row; a
    chunk holds at most CHUNK_CHARS characters and one text more."""
    spark = docs.sparkSession
    workers_import(spark)
    parts = PARTS_PER_PARTITION * shuffle_partitions(spark)
    name = f"llm_numbered_{uuid.uuid4().hex}"
    numbered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _number_texts(parts), _CHUNKED)
    (numbered.write.option("compression", "zstd").option("path", stage_path(spark, "numbered"))
     .bucketBy(shuffle_partitions(spark), "chunk").saveAsTable(name))
    rows = spark.table(name)
    words = (rows.where(F.col("part") != DOCS).select("chunk", "part", "payload")
             .repartition(shuffle_partitions(spark), "part").sortWithinPartitions("part"))
    ids = words.mapInArrow(_encode_words(path), _IDS)
    texts = rows.where(F.col("part") == DOCS).select("chunk", "doc_id", "payload")
    result = _ENCODED + (", ids array<int>" if with_ids else "")
    return texts.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(_reassemble(path, with_ids), result)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``encode_documents`` over the whole documents table (NULL text: no tokens;
    repeated rows are listed each; an empty table gives none)."""
    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {"op10_bpe": op10_bpe}
ORACLES: dict[str, str] = {}
