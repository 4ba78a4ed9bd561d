"""Operator 12, source divergence audit by hash-consed segment trees.

Terms of a language are dealt into blocks by hash.  In a block every group
(source) has a segment tree over the block's term ids, whose leaves are its
counts; equal count subtrees of all groups are one node.  Two groups are
compared by walking both trees at once, level by level: a pair of nodes that
comes more than once on a level is kept once with its number of times, and a
pair of counts is priced once.  Spark adds the blocks' parts.

Texts are read once, counted in the tasks, and never shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.common import stage_table, table, workers_import

#: Fixed values of the audit: documents that a term needs, scale of a share,
#: ranks of the term part.
LEAST_DOCS, SCALE, TERM_RANKS = 3, 1_000_000_000, 200
#: Terms of a block, at most, and cells (groups x terms) of its trees.
BLOCK_TERMS, BLOCK_CELLS = 16384, 4_000_000
#: A task passes its counts on when it holds so many.
HELD_COUNTS = 400_000

#: A leaf without a term.
NO_TERM = -1
#: The bytes of terms; A-Z are lower-cased, others part terms.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

_COUNTED = "lang string, source string, term string, n long, df long"
_PARTS = "lang string, source string, part string, item string, value long"


def terms(text: str) -> list[bytes]:
    """Terms of a text: runs of letters a-z, A-Z (lower-cased) and of
    characters beyond ASCII."""
    return text.encode("utf-8", "replace").translate(_TERM_BYTES).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and document counts by group and term; a NULL term tells that the
    group occurs."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (count, seen) in held.items():
            n = len(count) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang, pa.string()), n), pa.repeat(pa.scalar(source, pa.string()), n),
                 pa.array([None, *(t.decode() for t in count)], pa.string()),
                 pa.array([0, *count.values()], pa.int64()), pa.array([0, *map(seen.__getitem__, count)], pa.int64())],
                names=["lang", "source", "term", "n", "df"])
        held.clear()

    size = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            found = terms(text.as_py() or "")
            count, seen = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(count)
            count.update(found)
            seen.update(set(found))
            size += len(count)
            if size > HELD_COUNTS:
                yield from flush()
                size = 0
    yield from flush()


def shares(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (total + kept)), exactly: a long division
    by thousands, so that nothing leaves 64 bits."""
    below = max(total + kept, 1)
    whole, rest = np.divmod(count.astype(np.int64) + 1, below)
    scale = SCALE
    while scale > 1:
        more, rest = np.divmod(rest * 1000, below)
        whole, scale = whole * 1000 + more, scale // 1000
    return whole + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Forest:
    """Segment trees of several count rows over the same ids, equal subtrees
    once.  ``ids[k][row, i]`` is the node of a row's i-th subtree of height k,
    ``children[k]`` the two nodes below each node; at height 0 a node is its
    count."""

    def __init__(self, counts: np.ndarray):
        self.children: list[np.ndarray] = []
        values, at = np.unique(counts, return_inverse=True)
        self.values, level = values, at.reshape(counts.shape)
        while level.shape[1] > 1:
            size = int(level.max()) + 1
            pairs, at = np.unique(level[:, 0::2].astype(np.int64) * size + level[:, 1::2], return_inverse=True)
            self.children.append(np.stack(np.divmod(pairs, size), axis=1))
            level = at.reshape(level.shape[0], -1)
        self.roots = level[:, 0]

    def count_pairs(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of counts of rows a and b over all ids, each once, with the
        number of ids that have it."""
        left, right, times = self.roots[a:a + 1], self.roots[b:b + 1], np.ones(1, np.int64)
        for children in reversed(self.children):
            below_left, below_right = children[left].T.ravel(), children[right].T.ravel()
            size = int(below_right.max()) + 1
            pairs, at = np.unique(below_left * size + below_right, return_inverse=True)
            # the two children's occurrences lie one after the other
            times = np.bincount(at, np.concatenate([times, times]), len(pairs)).astype(np.int64)
            left, right = np.divmod(pairs, size)
        return self.values[left], self.values[right], times


def _audit_block(key: tuple, rows: pa.Table) -> pa.Table:
    """Parts of one block: sums over its terms for every ordered pair of groups,
    and each group's best terms of the block."""
    lang = key[0].as_py()
    source, term = rows.column("source").to_pylist(), rows.column("term").to_pylist()
    n, total = rows.column("n").to_numpy(), rows.column("total").to_numpy()
    is_group = np.array([t is None for t in term], bool)
    whole: dict[str | None, int] = {}
    kept = 0
    for i in np.flatnonzero(is_group).tolist():
        whole[source[i]], kept = int(n[i]), int(total[i])
    groups = sorted(s for s in whole if s is not None)
    row_of = {s: i for i, s in enumerate(groups)}
    lines = np.flatnonzero(~is_group)
    found = {term[i]: int(total[i]) for i in lines.tolist()}
    # frequent terms first: the rare ones' subtrees, mostly of zeros, are shared
    ordered = sorted(found, key=lambda t: (-found[t], t))
    column_of = {t: i for i, t in enumerate(ordered)}
    width = 1 << max(0, len(ordered) - 1).bit_length()
    counts = np.full((len(groups), width), NO_TERM, np.int64)
    counts[:, :len(ordered)] = 0
    of_row = np.array([row_of[source[i]] for i in lines.tolist()], np.int64)
    of_column = np.array([column_of[term[i]] for i in lines.tolist()], np.int64)
    counts[of_row, of_column] = n[lines]

    out: list[tuple] = []
    forest = Forest(counts) if groups else None
    for a, left in enumerate(groups):
        for b in range(a + 1, len(groups)):
            right = groups[b]
            left_count, right_count, times = forest.count_pairs(a, b)
            real = left_count != NO_TERM
            p = shares(left_count[real], whole[left], kept)
            q = shares(right_count[real], whole[right], kept)
            out.append((left, "pair", right, int((price(p, q) * times[real]).sum())))
            out.append((right, "pair", left, int((price(q, p) * times[real]).sum())))
    q_all = shares(np.array([found[t] for t in ordered], np.int64), whole.get(None, 0), kept)
    for a, left in enumerate(groups):
        mine = np.flatnonzero(counts[a, :len(ordered)] > 0)
        p, q = shares(counts[a, mine], whole[left], kept), q_all[mine]
        above = p > q
        mine, value = mine[above], price(p[above], q[above])
        best = sorted(zip((-value).tolist(), (ordered[i] for i in mine.tolist())),
                      key=lambda x: (x[0], x[1].encode()))[:TERM_RANKS]
        out += [(left, "term", t, -v) for v, t in best]
    columns = list(zip(*out)) or [[]] * 4
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "source": pa.array(columns[0], pa.string()),
                     "part": pa.array(columns[1], pa.string()), "item": pa.array(columns[2], pa.string()),
                     "value": pa.array(columns[3], pa.int64())})


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Divergence of every (lang, source) group of ``docs`` (text, lang, source)
    from the other sources of its language and from the language as a whole.

    Returns lang, source, part, item, value, rank.  NULL text, lang and source
    count as ''.  A group without terms, or of a language without kept terms,
    has pair rows all the same (value 0 without kept terms) and no term rows.
    A repeated row counts as one more document.  Ties rank by item in UTF-8
    order.  An empty table gives no row; other columns of ``docs`` are
    ignored."""
    workers_import(docs.sparkSession)
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    counts = stage_table(docs.select(text_of("lang"), text_of("source"), text_of("text")).mapInArrow(_count, _COUNTED)
                         .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")),
                         "group_counts")
    in_lang = (counts.where(F.col("term").isNotNull()).groupBy("lang", "term")
               .agg(F.sum("n").alias("total"), F.sum("df").alias("df")).where(F.col("df") >= least_docs)
               .select(F.col("lang").alias("_lang"), F.col("term").alias("_term"), "total"))
    kept = stage_table(counts.join(in_lang, (F.col("lang") == F.col("_lang")) & (F.col("term") == F.col("_term")))
                       .select("lang", "source", "term", "n", "total"), "kept_counts")
    # groups and languages: small tables, one row each
    groups = counts.where(F.col("term").isNull()).select("lang", "source")
    sums = kept.groupBy(F.col("lang").alias("_l"), F.col("source").alias("_s")).agg(F.sum("n").alias("n"))
    groups = stage_table(groups.join(sums, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")), "left")
                         .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")), "groups")
    vocabulary = in_lang.groupBy(F.col("_lang").alias("_v")).agg(F.count(F.lit(1)).alias("kept"))
    langs = (groups.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"))
             .join(vocabulary, F.col("lang") == F.col("_v"), "left")
             .withColumn("kept", F.coalesce("kept", F.lit(0))))
    size = F.greatest(F.lit(1.0), F.least(F.lit(float(block_terms)), F.lit(float(BLOCK_CELLS)) / F.col("groups")))
    langs = stage_table(langs.select(F.col("lang").alias("_lang"), F.col("n").alias("_n"), "kept",
                                     F.greatest(F.lit(1), F.ceil(F.col("kept") / size)).cast("int").alias("blocks")),
                        "languages")
    # every block gets its terms' counts and, without a term, all groups of the
    # language; the language itself has no source
    of_terms = kept.join(langs, F.col("lang") == F.col("_lang")).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "source", "term", "n", "total")
    all_groups = groups.union(langs.select("_lang", F.lit(None).cast("string"), "_n"))
    of_groups = all_groups.join(langs, F.col("lang") == F.col("_lang")).select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source",
        F.lit(None).cast("string").alias("term"), "n", F.col("kept").alias("total"))
    parts = stage_table(of_terms.union(of_groups).groupBy("lang", "block").applyInArrow(_audit_block, _PARTS),
                        "divergence_parts")
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranks = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (pairs.union(parts.where("part = 'term'")).withColumn("rank", F.row_number().over(ranks))
            .where((F.col("part") == "pair") | (F.col("rank") <= TERM_RANKS)))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``audit`` over the whole documents table (NULL text, lang, source: '';
    repeated rows count each; an empty table: no row; other columns are
    ignored)."""
    return audit(table(spark, sf_dir, "documents"))


_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= {LEAST_DOCS}),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, coalesce(sum(n), 0)::HUGEINT AS total, count(k.term) AS kept
      FROM (SELECT DISTINCT lang FROM d) LEFT JOIN k USING (lang) GROUP BY lang),
gt AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT gt.lang, gt.source, k.term, coalesce(c.n, 0) AS n,
    1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (gt.total + l.kept) AS p,
    1 + ({SCALE}::HUGEINT * (k.n + 1)) // (l.total + l.kept) AS q
  FROM gt JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = gt.lang AND c.source = gt.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
          FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {TERM_RANKS}
"""

QUERIES = {"op12_divergence": op12_divergence}
ORACLES = {"op12_divergence": _SQL}
