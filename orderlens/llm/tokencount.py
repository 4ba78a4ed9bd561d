"""Operator 8, token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are a sum of signed deltas: an
insert adds a document's counts, a delete takes them away, a revision takes the
old counts away and adds the new ones.  A batch is summed before it is written
and lies in a partition of its own name in the ledger; committing it again
replaces that partition with the same rows, so a replay changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.bpe import load_ranks, pretoken_starts, tokenizer_path
from orderlens.llm.common import doc_order, stage_path, stage_table, table, workers_import

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens", "n_bytes")
#: Tokenizer versions: words between ASCII white space, pre-tokens of the public
#: pattern (which revise the words), and ids of the public byte-level BPE.
WORDS, PRETOKENS, BPE = "words-1", "words-2", "byte_bpe_50k"


def _encoder(path: str):
    import public_tokenizers
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path),
                             special_tokens={})


def _count(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            words, pretokens, ids = [], [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                words.append(len(text.encode().split()))
                pretokens.append(len(pretoken_starts(text)))
                ids.append(len(encoder.encode_ordinary(text)))
            keep = [batch.column(c) for c in ("_o", "source", "lang", "n_bytes", "hash")]
            yield pa.RecordBatch.from_arrays([*keep, *[pa.array(c, pa.int64()) for c in (words, pretokens, ids)]],
                                             names=["_o", "source", "lang", "n_bytes", "hash", "words", "pretokens", "ids"])
    return run


def counted(docs: DataFrame, path: str) -> DataFrame:
    """Counts of every row by each tokenizer version, written once, no text."""
    workers_import(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(doc_order().alias("_o"), F.col("source").cast("string"), F.col("lang").cast("string"),
                       F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("hash"),
                       text.alias("text"))
    schema = "_o long, source string, lang string, n_bytes long, hash string, words long, pretokens long, ids long"
    return stage_table(rows.mapInArrow(_count(path), schema), "token-counts")


def signed(rows: DataFrame, versions: dict[str, str], sign: int) -> DataFrame:
    """Delta rows of documents: ``versions`` names the count column of each
    tokenizer version; ``sign`` is +1 for an insert, -1 for a delete."""
    each = F.explode(F.array(*[F.struct(F.lit(v).alias("tokenizer"), F.col(c).alias("n")) for v, c in versions.items()]))
    return rows.select("source", "lang", "n_bytes", each.alias("t")).select(
        "source", "lang", "t.tokenizer", F.lit(sign).cast("long").alias("n_docs"),
        (sign * F.col("t.n")).alias("n_tokens"), (sign * F.col("n_bytes")).alias("n_bytes"))


LEDGER = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_bytes long"


class Rollup:
    """Additive totals over a ledger of batches in a folder of shared storage."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def commit(self, batch_id: str, deltas: DataFrame) -> None:
        """Add a batch (columns KEYS and SUMS, signed).  The partition of the
        batch is replaced as a whole: a batch that failed half-way or comes
        again leaves its own rows once.  Each partition holds one row of zeros
        besides, so that an empty batch replaces what its id had before."""
        summed = deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        mark = self.spark.createDataFrame([(None, None, None, 0, 0, 0)], LEDGER)
        (summed.unionByName(mark).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(self.path))

    def totals(self) -> DataFrame:
        """Totals of all committed batches; groups without documents are left out."""
        ledger = self.spark.read.schema(f"{LEDGER}, batch_id string").parquet(self.path)
        return ledger.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).where(F.col("n_docs") != 0)


def leaders(rows: DataFrame) -> DataFrame:
    """One row of ``counted`` for each text, that of the earliest document
    (smallest doc_id, then source and language).  An aggregate that combines on
    the map side: copies of a text collapse before they are dealt out."""
    kept = ("_o", "source", "lang", "n_bytes", "words", "pretokens", "ids")
    return rows.groupBy("hash").agg(F.min(F.struct(*kept)).alias("first")).select("first.*")


def token_rollup(docs: DataFrame, path: str, ledger: str) -> DataFrame:
    """Totals after four commits over ``docs`` (doc_id, text, source, lang):

    1. ``load`` inserts every row under the word and BPE tokenizers;
    2. ``dedup`` deletes the rows whose text an earlier document has;
    3. ``revise`` replaces the word counts of the rest by the revised version;
    4. ``dedup`` and ``load`` come again, as after a lost driver, to no effect.

    Returns source, lang, tokenizer, n_docs, n_tokens, n_bytes.  NULL text
    counts as empty, NULL source and language are groups of their own, NULL ids
    come last.  Repeated rows are copies of each other.  An empty table gives
    no rows; other columns are ignored."""
    rows = counted(docs, path)
    stays = stage_table(leaders(rows), "token-leaders")
    first = {WORDS: "words", BPE: "ids"}
    load = signed(rows, first, 1)
    dedup = signed(rows, first, -1).union(signed(stays, first, 1))  # all rows but the leaders go
    old, new = signed(stays, {WORDS: "words"}, -1), signed(stays, {PRETOKENS: "pretokens"}, 1)
    rollup = Rollup(docs.sparkSession, ledger)
    rollup.commit("load", load)
    rollup.commit("dedup", dedup)
    rollup.commit("revise", old.union(new))
    rollup.commit("dedup", dedup)
    rollup.commit("load", load)
    return rollup.totals()


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``token_rollup`` over the whole documents table (NULL text: no tokens; NULL
    source or language: a group of its own; an empty table gives none)."""
    return token_rollup(table(spark, sf_dir, "documents"), tokenizer_path(), stage_path(spark, "token-ledger"))


QUERIES = {"op8_token_rollup": op8_token_rollup}
ORACLES: dict[str, str] = {}
