"""Operator 13, vector code compression with memoised grid cells.

A vector is cut into equal parts, each named by the nearest entry of its
position's codebook.  A part's components are hashed to a coarse cell of a grid
over the codebook; for a cell met the first time, the entries that another entry
beats all over the cell's box (by least and largest distances) are dropped, and
the others remembered.  Only those are evaluated for the parts in the cell.

Each round is one pass of Spark tasks that sum the parts of each entry; the
codebooks (entries x components, whatever the number of vectors) are all that
comes to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import NULL_ID, stage_table, table, workers_import

#: Fixed values of the query: parts of a vector, entries of a codebook, rounds,
#: integers per unit.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components are clipped here before they are scaled.
LARGEST = float(1 << 42)
#: Cells that the codebook's range has in each dimension, and cells a task
#: remembers for a part.
CUTS, KNOWN_CELLS = 6, 100_000
#: Parts evaluated at a time.
BLOCK = 1024

_SUMS = "part int, entry int, n long, sums array<string>"
_CODED = "vec_id long, label int, code string, error decimal(38,0)"


def integers(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(SCALE * x) of all components, a row per vector, zeros up to
    ``width`` components."""
    values = vectors.values if hasattr(vectors, "values") else pa.array([], pa.float64())
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64) if len(values) else np.zeros(0)
    got = np.floor(np.clip(flat, -LARGEST, LARGEST) * SCALE).astype(np.int64).reshape(len(vectors), -1)
    return np.pad(got, ((0, 0), (0, width - got.shape[1])))


class Grid:
    """Cells over one codebook, with the entries worth evaluating in each."""

    def __init__(self, book: np.ndarray, cuts: int = CUTS, known_cells: int = KNOWN_CELLS):
        self.book, self.known_cells = book, known_cells
        self.low = book.min(axis=0) if book.shape[1] else np.zeros(0, np.int64)
        spread = (book.max(axis=0) - self.low + 1) if book.shape[1] else self.low
        self.width = np.maximum(1, -(-spread // cuts))
        self.known: dict[bytes, np.ndarray] = {}

    def worth(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each box: entries that its rival does not beat all over the box.
        The rival is the entry of smallest largest distance; an entry goes if
        the least of (its distance - the rival's) over the box is positive, which
        holds wherever its least distance is beyond the rival's largest."""
        out = []
        for i in range(0, len(cells), 32):
            low = (self.low + cells[i:i + 32] * self.width)[:, None, :]
            high = low + self.width - 1
            far = np.maximum(np.abs(low - self.book), np.abs(self.book - high))
            rival = self.book[(far * far).sum(axis=2).argmin(axis=1)][:, None, :]
            # (x - e)^2 - (x - r)^2 = (r - e)(2x - e - r): least at an end of the box
            slope, middle = rival - self.book, rival + self.book
            least = np.where(slope > 0, slope * (2 * low - middle), slope * (2 * high - middle)).sum(axis=2)
            out += [np.flatnonzero(row) for row in least <= 0]
        return out

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry (ties: the lower) and squared distance of every part."""
        entry, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        for i in range(0, len(parts), BLOCK):
            some = parts[i:i + BLOCK]
            cells = np.ascontiguousarray((some - self.low) // self.width)
            keys = cells.view(np.dtype((np.void, max(1, cells.strides[0])))).ravel() if cells.shape[1] else \
                np.zeros(len(some), "V1")
            names, first, at = np.unique(keys, return_index=True, return_inverse=True)
            names = [k.tobytes() for k in names]
            if len(self.known) + len(names) > self.known_cells:
                self.known.clear()
            new = [j for j, k in enumerate(names) if k not in self.known]
            for j, found in zip(new, self.worth(cells[first[new]]) if new else []):
                self.known[names[j]] = found
            candidates = [self.known[k] for k in names]
            sizes = np.array([len(c) for c in candidates], np.int64)
            # (part, entry) pairs, the parts of a cell with its entries only
            of_part = sizes[at]
            ends = np.cumsum(of_part)
            starts = ends - of_part
            cell_starts = np.cumsum(sizes) - sizes
            pair = np.concatenate(candidates)[np.repeat(cell_starts[at] - starts, of_part) + np.arange(ends[-1])]
            apart = np.repeat(some, of_part, axis=0) - self.book[pair]
            packed = np.minimum.reduceat((apart * apart).sum(axis=1) * ENTRIES + pair, starts)
            entry[i:i + BLOCK], error[i:i + BLOCK] = packed % ENTRIES, packed // ENTRIES
        return entry, error


def _by_python_integers(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for components whose squares leave 64 bits."""
    entry, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), object)
    entries = book.tolist()
    for i, x in enumerate(parts.tolist()):
        error[i], entry[i] = min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(entries))
    return entry, error


class _Coder:
    """Codes of integer vectors for codebooks (part, entry, component)."""

    def __init__(self, books: np.ndarray):
        self.books, self.grids = books, [Grid(b) for b in books]
        self.largest = int(np.abs(books).max(initial=0))

    def code(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries (row, part) and total error of every row."""
        size = self.books.shape[2]
        widest = 3 * (self.largest + int(np.abs(rows).max(initial=0)) + 1)
        plain = widest * widest * max(size, 1) * ENTRIES < 1 << 62
        entries, total = np.zeros((len(rows), PARTS), np.int64), np.zeros(len(rows), np.int64 if plain else object)
        for k in range(PARTS):
            part = rows[:, k * size:(k + 1) * size]
            entries[:, k], error = self.grids[k].nearest(part) if plain else _by_python_integers(part, self.books[k])
            total = total + error
        return entries, total


def _sum_parts(books: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One round in a task: number and component sums of each entry's parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, size = _Coder(books), books.shape[2]
        n, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, object)
        for batch in batches:
            rows = integers(batch.column("vector"), PARTS * size)
            entries, _ = coder.code(rows)
            for k in range(PARTS):
                order = np.argsort(entries[:, k], kind="stable")
                used, first = np.unique(entries[order, k], return_index=True)
                n[k] += np.bincount(entries[:, k], minlength=books.shape[1])
                if len(used) and size:
                    # a batch is far too short for 64 bits to overflow below 2^52
                    sums[k, used] += np.add.reduceat(rows[order, k * size:(k + 1) * size], first, axis=0).astype(object)
        found = [(k, e, int(n[k, e]), [str(v) for v in sums[k, e]]) for k, e in zip(*np.nonzero(n))]
        columns = list(zip(*found)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
             pa.array(columns[3], pa.list_(pa.string()))], names=["part", "entry", "n", "sums"])

    return run


def _code_rows(books: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    import decimal

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _Coder(books)
        for batch in batches:
            entries, error = coder.code(integers(batch.column("vector"), PARTS * books.shape[2]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([bytes(e).hex() for e in entries.astype(np.uint8)], pa.string()),
                 pa.array([decimal.Decimal(int(e)) for e in error], pa.decimal128(38, 0))],
                names=["vec_id", "label", "code", "error"])

    return run


def kept_vectors(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """Rows whose vector is there, whole and finite."""
    whole = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(vector).isNotNull() & F.coalesce(whole, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"),
        F.col(label).cast("int").alias("label"))


def train(kept: DataFrame, width: int, first: list, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) after ``rounds`` rounds from the first
    vectors ``first``."""
    size = width // PARTS
    start = integers(pa.array(first, pa.list_(pa.float64())), width)
    books = np.stack([start[:, k * size:(k + 1) * size] for k in range(PARTS)])
    for _ in range(rounds):
        sums = kept.select("vector").mapInArrow(_sum_parts(books), _SUMS)
        # n rides along as one more component; a row an entry and component
        parts = sums.select("part", "entry", F.posexplode(F.concat(F.array(F.col("n").cast("string")), "sums")).alias("at", "v"))
        found = (parts.groupBy("part", "entry", "at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
                 .groupBy("part", "entry").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("v")).collect())
        books = books.copy()
        for r in found:  # at most PARTS x ENTRIES rows
            n, *of = [int(x["v"]) for x in r["v"]]
            books[r["part"], r["entry"]] = [s // n for s in of]
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
             rounds: int = ROUNDS) -> DataFrame:
    """Product codes of all whole vectors of ``vectors``.

    Returns vec_id, code, error, label_error and codebooks_sha256, a row per
    kept row.  Rows whose vector is NULL or holds a NULL or non-finite component
    are dropped, and so are vectors of another length than that of the smallest
    vec_id; a length that four does not divide is filled up with zeros.  NULL
    vec_ids sort last, equal ones by their vectors.  Repeated rows count and are
    coded each.  NULL labels are one label.  Components are clipped at 2^42; an
    error beyond a long is NULL.  An empty table gives no row; other columns are
    ignored."""
    spark = vectors.sparkSession
    workers_import(spark)
    kept = kept_vectors(vectors, vec_id, vector, label)
    smallest = [F.coalesce("vec_id", F.lit(NULL_ID)), F.col("vec_id").isNull(), F.col("vector")]
    head = kept.orderBy(*smallest).select("vector").first()
    length = len(head["vector"]) if head else 0
    kept = kept.where(F.size("vector") == length)
    first = [r["vector"] for r in kept.orderBy(*smallest).limit(ENTRIES).select("vector").collect()]
    if not first:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    books = train(kept, -(-length // PARTS) * PARTS, first, rounds)
    coded = stage_table(kept.mapInArrow(_code_rows(books), _CODED), "codes")
    totals = stage_table(coded.groupBy(F.col("label").alias("_l")).agg(F.sum("error").alias("_e")), "label_errors")

    def as_long(c: Column) -> Column:
        return F.when(c <= F.lit((1 << 63) - 1).cast("decimal(38,0)"), c.cast("long"))

    # a label may hold a third of all rows: its total is one small row, which
    # Spark broadcasts by the size of the written table or joins with skew splits
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_l"))).select(
        "vec_id", "code", as_long(F.col("error")).alias("error"), as_long(F.col("_e")).alias("label_error"),
        F.lit(books_digest(books)).alias("codebooks_sha256"))


def op13_grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``compress`` over the whole embeddings table (rows without a whole finite
    vector are dropped; repeated rows are coded each; an empty table: no row;
    other columns are ignored)."""
    return compress(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    apart = "list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    ctes = [f"""kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid,
    list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""",
            f"""x AS (SELECT rid, part, list_slice(v, part * len(v) // {PARTS} + 1, (part + 1) * len(v) // {PARTS}) AS v
  FROM kept, (SELECT unnest(range({PARTS}))::INTEGER AS part))""",
            f"b0 AS (SELECT part, (rid - 1)::INTEGER AS entry, v FROM x WHERE rid <= {ENTRIES})"]
    for i in range(ROUNDS + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT x.rid, x.part, min(struct_pack(d := {apart}, e := b.entry)) AS best
  FROM x JOIN b{i} b USING (part) GROUP BY x.rid, x.part)""")
        if i < ROUNDS:
            ctes.append(f"""s{i} AS (SELECT part, entry, list(v ORDER BY pos) AS v FROM (
    SELECT a.part, a.best.e AS entry, pos,
      (CASE WHEN sum(c) % count(*) < 0 THEN sum(c) // count(*) - 1 ELSE sum(c) // count(*) END)::BIGINT AS v
    FROM a{i} a JOIN (SELECT rid, part, unnest(v) AS c, unnest(range(len(v))) AS pos FROM x) c USING (rid, part)
    GROUP BY a.part, a.best.e, pos) GROUP BY part, entry)""")
            ctes.append(f"b{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(s.v, b.v) AS v FROM b{i} b LEFT JOIN s{i} s USING (part, entry))")
    last = ROUNDS
    ctes += [f"""coded AS (SELECT rid, string_agg(lower(lpad(to_hex(best.e), 2, '0')), '' ORDER BY part) AS code,
    sum(best.d)::BIGINT AS error FROM a{last} GROUP BY rid)""",
             f"""digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256
  FROM b{last})""",
             "rows_ AS (SELECT vec_id, label, code, error FROM kept JOIN coded USING (rid))",
             "labels_ AS (SELECT label, sum(error)::BIGINT AS label_error FROM rows_ GROUP BY label)"]
    return ("WITH " + ",\n".join(ctes) + """
SELECT r.vec_id, r.code, r.error, l.label_error, d.codebooks_sha256
FROM rows_ r JOIN labels_ l ON r.label IS NOT DISTINCT FROM l.label, digest d
""")


QUERIES = {"op13_grid_cells": op13_grid_cells}
ORACLES = {"op13_grid_cells": _sql()}
