"""Operator 3, SimHash near-duplicates by Golay-code fuzzy hashing.

The perfect Golay code (23, 12) puts every 23-bit word within 3 bits of exactly
one codeword.  A word's own codeword and those of its one-bit neighbours are at
most six; two words that differ in one bit always share one: the codeword of
either is among the six of the other.

A 64-bit fingerprint is cut into three segments.  Of at most 3 differing bits,
either some segment has none and another at most one, or all three have exactly
one.  So two fingerprints meet

* at the whole of one segment with a codeword of another (six ordered pairs), or
* at a codeword of all three.

One side of the join brings its own codeword, the other its up to six, which
keeps the keys few (84 rows a fingerprint) and long (33 bits or more, so that
chance meetings stay rare when there are many fingerprints).  Each meeting is
checked by counting bits, in the join condition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import NULL_ID, doc_order, stage_table, table, text_tag, whole_rows, workers_import
from orderlens.llm.components import components

#: Fixed values of the binary Golay code: generator polynomial, check bits.
GOLAY_GENERATOR, CHECK_BITS = 0b101011100011, 11
#: Segments of a fingerprint, from the low bit: place and width.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
HASH_SEED = 42
SHINGLE_WORDS, MAX_BITS = 3, 3


def _remainder(word: int) -> int:
    for bit in range(22, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GOLAY_GENERATOR << (bit - CHECK_BITS)
    return word


def _golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of the upper 12 bits; error pattern of each remainder."""
    upper = np.array([_remainder(i << CHECK_BITS) for i in range(1 << 12)], np.int64)
    single = [_remainder(1 << i) for i in range(23)]
    error = np.zeros(1 << CHECK_BITS, np.int64)
    for i in range(23):
        error[single[i]] = 1 << i
        for j in range(i):
            error[single[i] ^ single[j]] = 1 << i | 1 << j
            for k in range(j):
                error[single[i] ^ single[j] ^ single[k]] = 1 << i | 1 << j | 1 << k
    return upper, error


UPPER, ERROR = _golay_tables()


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Message (0..4095) of the codeword nearest to each 23-bit word."""
    return (words ^ ERROR[UPPER[words >> CHECK_BITS] ^ (words & ((1 << CHECK_BITS) - 1))]) >> CHECK_BITS


def codeword_indices(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of each word's own codeword and its neighbours' ones, sorted, and
    which of them are first of their value."""
    flips = np.array([0] + [1 << i for i in range(width)], np.int64)
    found = np.sort(codeword_index(words[:, None] ^ flips[None, :]), axis=1)
    return found, np.concatenate([np.ones((len(words), 1), bool), found[:, 1:] != found[:, :-1]], axis=1)


def fingerprint(data: bytes, words_in_shingle: int) -> int:
    """SimHash of a text (UTF-8): a bit is set if over half of the shingles'
    hashes have it.  Fewer words than a shingle: the whole sequence; none: 0."""
    import xxhash
    words = data.lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= words_in_shingle:
        return digest(joined, HASH_SEED)
    starts = np.cumsum([0] + [len(w) + 1 for w in words])
    hashes = [digest(joined[a:b], HASH_SEED) for a, b in
              zip(starts[:-words_in_shingle].tolist(), (starts[words_in_shingle:] - 1).tolist())]
    bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        block = np.array(hashes[i:i + 65536], np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big")


def _fingerprints(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint((t.as_py() or "").encode(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_o"), batch.column("_tag"),
                 pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "_o", "_tag", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, _o, _tag, fp) for every row, written once."""
    workers_import(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), doc_order().alias("_o"), text_tag().alias("_tag"),
                       F.col("text").cast("string"))
    return stage_table(rows.mapInArrow(_fingerprints(shingle), "doc_id long, _o long, _tag long, fp long"),
                       "fingerprints")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key rows of fingerprints: (side, key, fp).  A key holds its kind (which
    segments), so kinds never meet; side 0 brings own codewords."""
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(every), 4096):
            fps = every[at:at + 4096]
            bits = fps.view(np.uint64)
            segments = [((bits >> np.uint64(p)) & np.uint64((1 << w) - 1)).astype(np.int64) for p, w in SEGMENTS]
            own = [codeword_index(s) for s in segments]
            six = [codeword_indices(s, w) for s, (_, w) in zip(segments, SEGMENTS)]
            rows: list[tuple[int, np.ndarray, np.ndarray]] = []
            kind = 0
            for i in range(3):
                for j in range(3):
                    if i != j:
                        head = (kind << 34) + (segments[i] << 12)
                        rows.append((0, head + own[j], fps))
                        found, first = six[j]
                        rows.append((1, (head[:, None] + found)[first], np.repeat(fps, first.sum(axis=1))))
                        kind += 1
            head = kind << 36
            found, first = six[1]
            side = head + (own[0][:, None] << 24) + (found << 12) + own[2][:, None]
            rows.append((0, side[first], np.repeat(fps, first.sum(axis=1))))
            (f0, k0), (f2, k2) = six[0], six[2]
            both = k0[:, :, None] & k2[:, None, :]
            # few of the pairs are first ones: take them by place
            n, x, y = np.nonzero(both)
            rows.append((1, head + (f0[n, x] << 24) + (own[1][n] << 12) + f2[n, y], fps[n]))
            for side_no, keys, values in rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), side_no, np.int8)), pa.array(keys), pa.array(values)],
                    names=["side", "key", "fp"])


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of different fingerprints (column fp) that differ in
    ``max_bits`` bits or fewer; up to 3 bits, which is what the keys promise."""
    if max_bits > 3:
        raise ValueError("Golay keys find pairs of up to 3 differing bits")
    workers_import(distinct.sparkSession)
    # a fingerprint makes some hundred keys, which the size estimate of the key
    # rows does not know: the hint keeps either side from being broadcast by it
    keys = distinct.select("fp").mapInArrow(_keys, "side byte, key long, fp long")
    a = keys.where(F.col("side") == 0).select("key", F.col("fp").alias("a"))
    b = keys.where(F.col("side") == 1).select(F.col("key").alias("key_b"), F.col("fp").alias("b"))
    near = ((F.col("key") == F.col("key_b")) & (F.col("a") < F.col("b"))
            & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    return a.join(b.hint("merge"), near).select("a", "b").distinct()


def with_components(found: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fingerprints`` rows with ``root``, the fingerprint that stands for the
    component, and ``component_o``, the smallest document order in it.

    Copies share a fingerprint and collapse before any key is made."""
    by_fp = stage_table(found.groupBy("fp").agg(F.min("_o").alias("first_o")), "distinct-fingerprints")
    labels = components(links(by_fp, max_bits))
    rooted = by_fp.join(labels, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_o", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("first_o").alias("component_o"))
    known = rooted.select("fp", "root").join(first, "root").select(F.col("fp").alias("_fp"), "root", "component_o")
    return found.join(known, F.col("fp") == F.col("_fp")).drop("_fp")


def _hex(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Near-duplicate components of ``docs`` (doc_id, text), a row per row:
    doc_id, fingerprint (16 hex digits), component_id.

    A text without words (NULL, empty, blank) has fingerprint zero and links
    like any other.  Repeated rows are each listed.  A NULL doc_id counts as the
    largest, so component_id is NULL only where no id is known.  An empty table
    gives none; other columns are ignored.  Texts of any length are hashed
    whole."""
    rows = with_components(fingerprints(docs, shingle), max_bits)
    return rows.select("doc_id", _hex("fp").alias("fingerprint"),
                       F.when(F.col("component_o") != NULL_ID, F.col("component_o")).alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: the one of smallest doc_id.

    Where several rows have that doc_id, the one of smallest text hash stays;
    of rows equal in both, the first by the columns that can be ordered.  Texts
    without words are one component.  An empty table stays empty; columns may
    have any names and keep their values and types."""
    rows = with_components(fingerprints(docs, shingle), max_bits)
    stays = rows.groupBy("root").agg(F.min(F.struct("_o", "_tag")).alias("s")).select(
        F.col("s._o").alias("_so"), F.col("s._tag").alias("_st"))
    kept = whole_rows(docs).join(stays, (F.col("_o") == F.col("_so")) & (F.col("_tag") == F.col("_st")), "left_semi")
    order = [f.name for f in docs.schema.fields if "map" not in f.dataType.simpleString()]
    by = F.struct(*[F.col("_row").getField(c).alias(f"c{i}") for i, c in enumerate(order)])
    return kept.groupBy("_o", "_tag").agg(F.min_by("_row", by).alias("_row")).select("_row.*")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``near_duplicates`` over the whole documents table (texts without words:
    fingerprint zero; repeated rows are listed each; an empty table gives none)."""
    return near_duplicates(table(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)


QUERIES = {"op3_simhash": op3_simhash}
ORACLES: dict[str, str] = {}
