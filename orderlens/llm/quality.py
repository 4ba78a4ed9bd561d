"""Operator 1, quality rules: base rules on exact counts, then gradient-boosted
trees over document statistics.

Statistics are row-local and taken once into a small stage table; the trees are
fitted on a bounded sample of labelled rows and score the stage table in vector
form.  Texts are read once and never shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import boosting
from orderlens.llm.common import doc_order, stage_table, table, text_tag, workers_import

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30

#: Labelled rows the trees are fitted on, at most; fewer than MIN_TRAIN, or one
#: class only, and the base rules decide alone.
TRAIN_ROWS, MIN_TRAIN = 6000, 40
#: Labelled ids looked up for them, as a multiple (some fail the base rules), and
#: kept rows that a task hands back at a time.
SPARE, OUT_ROWS = 2, 256
#: A document stays if its score reaches this.
MIN_SCORE = 0.5

#: Statistics the trees see, with the direction in which quality may move.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "upper_share": -1, "mark_share": -1, "digit_share": 0, "distinct_share": 0, "top_word_share": -1,
    "line_words": 0, "pipe_share": -1,
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_WHITE = bytes([0x20, *range(0x09, 0x0E)])
_NOT_FIRST = bytes(range(0x80, 0xC0))
_UPPER, _LOWER = bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
_DIGITS = bytes(range(0x30, 0x3A))
_MARKS = b"!\"',-./:;?()[]{}_=+~^`@\\"


def _count(data: bytes, these: bytes) -> int:
    return len(data) - len(data.translate(None, these))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that the text holds twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    if len(number) == len(words):
        return 0
    # no two equal hashes: no two equal windows
    mixed = ids * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    mixed ^= mixed >> np.uint64(29)
    acc = np.zeros(n, np.uint64)
    for k in range(window):
        acc = acc * np.uint64(0xBF58476D1CE4E5B9) + mixed[k:k + n]
    ordered = np.sort(acc)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    windows = np.lib.stride_tricks.sliding_window_view(ids, window)
    near = np.flatnonzero(np.isin(acc, ordered[1:][ordered[1:] == ordered[:-1]]))
    _, place, count = np.unique(windows[near], axis=0, return_inverse=True, return_counts=True)
    covered = np.zeros(len(words) + 1, np.int64)
    twice = near[count[place.ravel()] > 1]
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def statistics(data: bytes) -> tuple[list[int], list[float]]:
    """Base counts and tree statistics of a text (UTF-8)."""
    words = data.split()
    n = len(words)
    word_chars = len(data.translate(None, _WHITE + _NOT_FIRST))
    symbols = _count(data, SYMBOLS)
    seen: set[bytes] = set()
    lines = dup = 0
    for line in data.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeat = repeated_words(words)
    upper, lower = _count(data, _UPPER), _count(data, _LOWER)
    tally = Counter(words)
    per = lambda a, b: a / b if b else 0.0
    return [n, word_chars, symbols, dup, repeat], [
        float(np.log1p(n)), per(word_chars, n), per(symbols, word_chars), per(dup, lines), per(repeat, n),
        per(upper, upper + lower), per(_count(data, _MARKS), word_chars), per(_count(data, _DIGITS), word_chars),
        per(len(tally), n), per(max(tally.values(), default=0), n), per(n, lines), per(data.count(b"|"), n)]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [statistics((t.as_py() or "").encode()) for t in batch.column("text")]
        counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
        shares = np.array([s for _, s in found], np.float64).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "_o", "_tag")]
            + [pa.array(counts[:, i]) for i in range(len(COUNTS))]
            + [pa.array(shares[:, i]) for i in range(len(FEATURES))],
            names=["doc_id", "_o", "_tag", *COUNTS, *FEATURES])


def measure(docs: DataFrame) -> DataFrame:
    """Statistics of every row (no text), written once, with base_failed."""
    workers_import(docs.sparkSession)
    schema = ", ".join(["doc_id long", "_o long", "_tag long", *[f"{c} long" for c in COUNTS],
                        *[f"{c} double" for c in FEATURES]])
    rows = docs.select(F.col("doc_id").cast("long"), doc_order().alias("_o"), text_tag().alias("_tag"),
                       F.col("text").cast("string"))
    return stage_table(rows.mapInArrow(_measure, schema).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))), "statistics")


def fit_quality(measured: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> boosting.FlatTrees | None:
    """Trees for P(quality = 1), fitted on at most ``train_rows`` labelled rows
    that pass the base rules, taken by the hash of their id.  None if there are
    too few or of one class.  A doc_id labelled more than once counts as good
    if most of its labels say so."""
    truth = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("_l")).agg((F.avg("quality") >= 0.5).cast("int").alias("_y"))
    rows = measured.where(~F.col("base_failed")).join(truth, F.col("doc_id") == F.col("_l")).select(
        F.xxhash64("doc_id").alias("_h"), "doc_id", "_tag", "_y", *FEATURES)
    # a share of the hash space with somewhat more rows than wanted comes to the
    # driver in all, not as many rows from every task
    share = min(1.0, 1.2 * train_rows / max(rows.count(), 1))
    near = F.pmod("_h", F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    sample = rows.where(near).orderBy("_h", "doc_id", "_tag").limit(train_rows).collect()
    y = np.array([r["_y"] for r in sample], np.float64)
    if len(y) < MIN_TRAIN or y.min() == y.max():
        return None
    x = np.array([[r[c] for c in FEATURES] for r in sample], np.float64)
    return boosting.fit(x, y, np.array(list(FEATURES.values())))


def _verdict(model: boosting.FlatTrees | None, least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = ~batch.column("base_failed").to_numpy(zero_copy_only=False)
            if model is None:
                score = passed.astype(np.float64)
            else:
                x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in FEATURES], axis=1)
                score = model.score(x)
            keep = [batch.column(c) for c in ("doc_id", "_o", "_tag", *COUNTS, "base_failed")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(passed & (score >= least)), pa.array(score)],
                names=["doc_id", "_o", "_tag", *COUNTS, "base_failed", "kept", "score"])
    return run


def _judged(docs: DataFrame, labels: DataFrame, train_rows: int, least: float) -> DataFrame:
    measured = measure(docs)
    model = fit_quality(measured, labels, train_rows)
    schema = ", ".join(["doc_id long", "_o long", "_tag long", *[f"{c} long" for c in COUNTS],
                        "base_failed boolean", "kept boolean", "score double"])
    return measured.mapInArrow(_verdict(model, least), schema)


def judge(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, least: float = MIN_SCORE) -> DataFrame:
    """Quality verdict for every row of ``docs`` (doc_id, text).

    NULL and empty texts have no words and fail the base rules.  Repeated rows
    are judged each, alike.  A NULL doc_id is judged but never trained on.  An
    empty table gives none; other columns of ``docs`` are ignored.  Without
    enough labels the base rules decide alone (score 1 or 0)."""
    return _judged(docs, labels, train_rows, least).select(
        "doc_id", *COUNTS, "base_failed", "kept", "score")


def _keep(model: boosting.FlatTrees | None, least: float, text: int) -> Callable:
    """Rows whose column ``text`` the base rules and the trees keep."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics((v.as_py() or "").encode()) for v in batch.column(text)]
            counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
            n, repeat = counts[:, COUNTS.index("n_words")], counts[:, COUNTS.index("n_repeat_words")]
            kept = (n >= MIN_WORDS) & (100 * repeat <= MAX_REPEAT_PERCENT * n)
            if model is not None:
                kept &= model.score(np.array([s for _, s in found], np.float64).reshape(-1, len(FEATURES))) >= least
            at = np.flatnonzero(kept)
            for i in range(0, len(at), OUT_ROWS):
                yield batch.take(pa.array(at[i:i + OUT_ROWS]))

    return run


def labelled(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Rows of ``docs`` whose id is among some ``SPARE * train_rows`` labelled
    ids, taken by their hash: enough to train on, and few enough to look up
    without a shuffle of the texts."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select(
        F.col("doc_id").cast("long").alias("_id")).distinct()
    share = min(1.0, SPARE * train_rows / max(ids.count(), 1))
    near = ids.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.join(F.broadcast(near), F.col("doc_id") == F.col("_id"), "left_semi")


def keep_good(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, least: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, any other columns) that pass the base
    rules and the trees, with all their columns.

    The trees are fitted on a bounded sample of labelled rows; then every row is
    judged where it is read, without a shuffle.  NULL and empty texts go.
    Repeated rows are judged alike; a NULL doc_id is judged but not trained on;
    an empty table stays empty.  Columns may have any names.  Without enough
    labels the base rules decide alone."""
    workers_import(docs.sparkSession)
    model = fit_quality(measure(labelled(docs, labels, train_rows)), labels, train_rows)
    # positions for names, as Arrow may not tell two such names apart
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    kept = plain.mapInArrow(_keep(model, least, docs.columns.index("text")), plain.schema)
    return kept.toDF(*docs.columns)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``judge`` over the whole documents table (NULL and empty texts fail the
    base rules; repeated rows are judged each; an empty table gives none)."""
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op1_quality": op1_quality}
ORACLES: dict[str, str] = {}
