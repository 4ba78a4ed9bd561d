"""Operator 6, benchmark decontamination by greedy string tiling.

Benchmark items come in blocks of bounded size; each block's seeds (windows of
five words) go to the tasks, which join them with the rolling hashes of their
documents.  A tile is made of shared seeds, so an item whose words are not
covered by seeds well enough needs no tiling.  For the rest, the longest
unmarked common run is marked again and again; tiles may stand in any order in
the document, so reordered passages count.  Documents are not shuffled; only
hits are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import doc_order, stage_path, table, text_tag, whole_rows, workers_import

#: Least tile in words, and the share of an item's words that tiles must cover.
MIN_TILE, MIN_COVERAGE = 5, 0.8
#: Words of benchmark text that go to the tasks at once.
BLOCK_WORDS = 1_000_000

_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def words_of(text: str) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    return text.lower().encode().translate(None, _PUNCTUATION).split()


def rolling_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2^64) of all windows of ``width`` numbers."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc, values = np.zeros(n, np.uint64), ids.astype(np.uint64) + np.uint64(1)
    for k in range(width):
        acc = acc * _BASE + values[k:k + n] * np.uint64(0xBF58476D1CE4E5B9)
    return acc ^ (acc >> np.uint64(31))


class Windows:
    """Karp-Rabin hashes (modulo 2^64) of a number sequence's windows of any
    width, from running sums: a window's sum over powers of the base, moved back
    to power zero."""

    def __init__(self, ids: np.ndarray):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(ids), _BASE)]))
        values = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:-1], dtype=np.uint64)])
        self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(ids), _BASE_INVERSE)]))

    def hashes(self, width: int) -> np.ndarray:
        sums = self.sums[width:] - self.sums[:len(self.sums) - width]
        return sums * self.back[:len(sums)]


def unmarked(marks: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` words, whether none of them is marked."""
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[width:] == total[:len(total) - width]


class Matches:
    """Equal unmarked windows of one width: places in the text are kept by hash,
    so memory follows the words, never the pairs of equal windows."""

    def __init__(self, text: tuple[np.ndarray, Windows, np.ndarray], item: tuple[np.ndarray, Windows, np.ndarray], width: int):
        (self.text, text_windows, self.in_text), (self.item, item_windows, in_item) = text, item
        self.width, self.in_item = width, in_item
        self.at_item = np.flatnonzero(unmarked(in_item, width))
        if not len(self.at_item):
            return
        keys, self.key_of = np.unique(item_windows.hashes(width)[self.at_item], return_inverse=True)
        found = text_windows.hashes(width)
        place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        at = np.flatnonzero((keys[place] == found) & unmarked(self.in_text, width))
        self.at_text = at[np.argsort(place[at], kind="stable")]
        self.ends = np.cumsum(np.bincount(place[at], minlength=len(keys)))

    def in_order(self) -> Iterator[tuple[int, int]]:
        """(place in item, place in text), earlier in the item first, each with its
        earliest place in the text; marks made between two of them count."""
        free = None
        for k, i in enumerate(self.at_item.tolist()):
            if self.in_item[i:i + self.width].any():
                continue
            low = self.ends[self.key_of[k] - 1] if self.key_of[k] else 0
            places = self.at_text[low:self.ends[self.key_of[k]]]
            if free is not None:
                places = places[free[places]]
            # hashes propose, the numbers themselves decide
            t = next((t for t in places.tolist() if np.array_equal(
                self.text[t:t + self.width], self.item[i:i + self.width])), None)
            if t is not None:
                yield i, t
                free = unmarked(self.in_text, self.width)


def tiles(text: np.ndarray, item: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy tiling of two number sequences: (length, place in item, place in
    text) of runs that do not overlap in either, longest first (ties: earlier
    in the item, then in the text).

    The longest common run of unmarked words is found by trying widths, as a run
    holds all shorter ones; all runs of that width are marked in their order,
    then the next width is looked for below it.  Marked runs of different widths
    add up to the item at most, so there are about sqrt(2 x its words) widths."""
    out, top = [], min(len(text), len(item))
    if top < least:
        return out
    in_item, in_text = np.zeros(len(item), bool), np.zeros(len(text), bool)
    sides = (text, Windows(text), in_text), (item, Windows(item), in_item)
    while top >= least:
        # widths above ``top`` have no run left; go down by doubled steps, then halve the gap
        low, step = top, 1
        while low >= least and next(Matches(*sides, low).in_order(), None) is None:
            top, low = low - 1, (max(low - step, least) if low > least else least - 1)
            step *= 2
        if low < least:
            return out
        while low < top:
            middle = (low + top + 1) // 2
            if next(Matches(*sides, middle).in_order(), None) is None:
                top = middle - 1
            else:
                low = middle
        for i, t in Matches(*sides, low).in_order():
            in_item[i:i + low] = in_text[t:t + low] = True
            out.append((low, i, t))
        top = low - 1
    return out


class Block:
    """Benchmark items of one block with their seeds."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.number: dict[bytes, int] = {}
        self.least, self.ids, self.items = least, [], []
        for item_id, text in items:
            words = words_of(text)
            if len(words) >= least:
                self.ids.append(item_id)
                self.items.append(np.array([self.number.setdefault(w, len(self.number) + 1) for w in words], np.int64))
        hashes = [rolling_hashes(x, least) for x in self.items]
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.seeds = flat[order]
        self.item_of = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])[order]
        self.place_of = np.concatenate([np.arange(len(h)) for h in hashes])[order] if hashes else order

    def hits(self, text: str, coverage: float) -> list[tuple[int, float, int]]:
        """(item_id, share of its words under tiles, tiles) of every item that
        the text covers well enough."""
        words = words_of(text)
        get = self.number.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        found = rolling_hashes(ids, self.least)
        low = np.searchsorted(self.seeds, found, "left")
        shared = np.flatnonzero(self.seeds[np.minimum(low, len(self.seeds) - 1)] == found) if len(self.seeds) else []
        if len(shared) == 0:
            return []
        keys = np.unique(found[shared])
        low, high = np.searchsorted(self.seeds, keys, "left"), np.searchsorted(self.seeds, keys, "right")
        at = np.concatenate([np.arange(a, b) for a, b in zip(low, high)])
        # the words near shared seeds are all that a tile can use
        near = np.zeros(len(ids) + 1, np.int64)
        np.add.at(near, shared, 1)
        np.add.at(near, shared + self.least, -1)
        near = np.cumsum(near)[:-1] > 0
        gaps = np.flatnonzero(near)
        pieces = np.split(gaps, np.flatnonzero(np.diff(gaps) > 1) + 1)
        part = np.concatenate([x for p in pieces for x in (ids[p], [0])])
        out = []
        for k in np.unique(self.item_of[at]):
            item, places = self.items[k], self.place_of[at[self.item_of[at] == k]]
            covered = np.zeros(len(item), bool)
            covered[(places[:, None] + np.arange(self.least)).ravel()] = True
            if covered.sum() < coverage * len(item):
                continue
            got = tiles(part, item, self.least)
            share = sum(n for n, _, _ in got) / len(item)
            if share >= coverage:
                out.append((self.ids[k], share, len(got)))
        return out


_HITS = "_o long, _tag long, item_id long, coverage double, n_tiles long"


def _find(block: Block, coverage: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(o.as_py(), tag.as_py(), *hit) for o, tag, text in zip(*[batch.column(k) for k in range(3)])
                    for hit in block.hits(text.as_py() or "", coverage)]
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()))],
                names=["_o", "_tag", "item_id", "coverage", "n_tiles"])
    return run


def _blocks(benchmark: DataFrame, least: int, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks: each is at most about ``block_words`` words of
    text on the driver, or one item.  Equal items count once."""
    items = benchmark.where(F.col("text").isNotNull()).groupBy("text").agg(
        F.min(F.col("item_id").cast("long")).alias("item_id"))
    size = (F.length("text") / 6).cast("long") + 1
    total = items.agg(F.sum(size)).first()[0] or 0
    blocks = -(-2 * total // block_words)
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).select("item_id", "text").collect()
        yield Block(sorted(((r[0] if r[0] is not None else -1), r[1]) for r in rows), least)


def hits(docs: DataFrame, benchmark: DataFrame, least: int = MIN_TILE, coverage: float = MIN_COVERAGE,
         block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every (document, item) whose tiles cover the item: one row each.

    The hits of a block are written before the next one is read, so the driver
    holds one block at a time; each block is a scan of the documents."""
    spark = docs.sparkSession
    workers_import(spark)
    rows = docs.select(doc_order().alias("_o"), text_tag().alias("_tag"), F.col("text").cast("string"))
    path = stage_path(spark, "benchmark-hits")
    spark.createDataFrame([], _HITS).write.parquet(path)
    for block in _blocks(benchmark, least, block_words):
        # an item is in one block, so repeated documents are told apart here
        rows.mapInArrow(_find(block, coverage), _HITS).distinct().write.mode("append").parquet(path)
    return spark.read.schema(_HITS).parquet(path)


def contamination(docs: DataFrame, benchmark: DataFrame, least: int = MIN_TILE, coverage: float = MIN_COVERAGE,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row for every row of ``docs`` (doc_id, text): doc_id, contaminated,
    n_items (benchmark items it holds), item_id and coverage of the best one
    (ties: the smaller id; NULL and 0 without any), n_tiles of that one.

    An item is held if tiles of ``least`` words or more cover at least
    ``coverage`` of its words.  Items of fewer words than a tile, NULL or empty
    ones are never held; an item without id reports -1.  NULL and empty texts
    hold nothing.  Repeated rows are each listed; an empty table gives none, an
    empty benchmark no contamination.  Other columns are ignored."""
    best = hits(docs, benchmark, least, coverage, block_words).groupBy("_o", "_tag").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct(
            F.col("coverage"), (-F.col("item_id")).alias("neg"), F.col("n_tiles"))).alias("best")).select(
        F.col("_o").alias("_ho"), F.col("_tag").alias("_ht"), "n", "best")
    rows = docs.select("doc_id", doc_order().alias("_o"), text_tag().alias("_tag"))
    return rows.join(best, (F.col("_o") == F.col("_ho")) & (F.col("_tag") == F.col("_ht")), "left").select(
        "doc_id", F.col("n").isNotNull().alias("contaminated"), F.coalesce("n", F.lit(0)).alias("n_items"),
        (-F.col("best.neg")).alias("item_id"), F.coalesce("best.coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("best.n_tiles", F.lit(0)).alias("n_tiles"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, least: int = MIN_TILE, coverage: float = MIN_COVERAGE,
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns.

    NULL and empty texts hold none and stay, repeated rows stay or go together,
    an empty table stays empty.  Columns may have any names and keep their
    values and types."""
    bad = hits(docs, benchmark, least, coverage, block_words).select(
        F.col("_o").alias("_ho"), F.col("_tag").alias("_ht")).distinct()
    return whole_rows(docs).join(bad, (F.col("_o") == F.col("_ho")) & (F.col("_tag") == F.col("_ht")),
                                 "left_anti").select("_row.*")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``contamination`` over the whole documents table (NULL and empty texts
    hold nothing; repeated rows are listed each; an empty table gives none)."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op6_decontaminate": op6_decontaminate}
ORACLES: dict[str, str] = {}
