"""Operator 5, sharding by jump consistent hashing (native).

The shard of a row depends on its key and the number of shards alone: no ring
table, no state, and one more shard only takes rows into itself, a fraction
1/(n+1) of them.  Everything is a DataFrame expression; the only shuffle moves
(key, size, checksum) rows, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.common import table

#: Fixed values of the jump consistent hash: multiplier of its 64-bit linear
#: congruential generator, its modulus, and the bits of a draw.
JUMP_MULTIPLIER = 2862933555777941757
JUMP_MODULUS = 18446744073709551616
JUMP_SHIFT = 8589934592
JUMP_SCALE = 2147483648

#: Blocks in which the rows of one shard are numbered side by side (a prime, so
#: that regular ids still spread).
SLOT_BLOCKS = 4093


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0..shards-1 of a long key (NULL counts as key 0).

    The generator's state is an exact decimal below 2^64; a
    jump always moves forward, so ``shards`` steps suffice."""
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    unsigned = (key.cast("decimal(20,0)")
                + F.when(key < 0, F.expr(f"{JUMP_MODULUS}BD")).otherwise(F.expr("0BD"))).cast("decimal(20,0)")
    start = F.struct(unsigned.alias("k"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(acc: Column, _: Column) -> Column:
        k = ((acc["k"] * F.expr(f"{JUMP_MULTIPLIER}BD") + F.expr("1BD"))
             % F.expr(f"{JUMP_MODULUS}BD")).cast("decimal(20,0)")
        # the upper 31 bits of the state
        draw = F.floor((k - k % F.expr(f"{JUMP_SHIFT}BD")) / F.expr(f"{JUMP_SHIFT}BD")).cast("long")
        ahead = F.floor((acc["j"] + 1) * (F.lit(float(JUMP_SCALE)) / (draw + 1).cast("double"))).cast("long")
        return F.when(acc["j"] < shards,
                      F.struct(k.alias("k"), acc["j"].alias("b"), ahead.alias("j"))).otherwise(acc)

    steps = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(steps, start, step, lambda acc: acc["b"].cast("int"))


def with_slots(rows: DataFrame, shard: str, order: list[str], block_of: str = "doc_id",
               blocks: int = SLOT_BLOCKS) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... without gaps within each shard.

    A shard is a large part of all rows, so it is not numbered in one task:
    rows are numbered within (shard, block of the key), and each block starts
    after the rows of the blocks before it.  The block totals are at most
    shards x blocks rows."""
    block = F.coalesce(F.pmod(F.col(block_of).cast("long"), F.lit(blocks)), F.lit(0)).cast("int")
    rows = rows.withColumn("_block", block)
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(shard, "_block").agg(F.count(F.lit(1)).alias("_n"))
              .select(F.col(shard).alias("_s"), F.col("_block").alias("_b"),
                      F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    within = Window.partitionBy(shard, "_block").orderBy(*order)
    numbered = rows.withColumn("_r", F.row_number().over(within) - 1)
    return (numbered.join(starts, (F.col(shard) == F.col("_s")) & (F.col("_block") == F.col("_b")))
            .withColumn("slot", (F.col("_start") + F.col("_r")).cast("long"))
            .drop("_block", "_s", "_b", "_start", "_r"))


def jump_shards(docs: DataFrame, shards: int, blocks: int = SLOT_BLOCKS) -> DataFrame:
    """Sharding manifest of ``docs`` (doc_id, text): one row per input row.

    size is the text's UTF-8 bytes plus 1 (NULL text: 1), text_crc32 its
    checksum (NULL: that of the empty text, 0).  A NULL doc_id is sharded as
    key 0.  Repeated rows get the same shard and slots of their own; rows that
    tie in doc_id are numbered by size, then checksum.  An empty table gives an
    empty manifest; other columns of ``docs`` are ignored."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"))
    rows = rows.select("*", F.lit("key").alias("law"),
                       jump_shard(F.col("doc_id"), shards).alias("shard"),
                       jump_shard(F.col("doc_id"), shards + 1).alias("grown_shard"))
    out = with_slots(rows, "shard", ["doc_id", "size", "text_crc32"], blocks=blocks)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op5_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``jump_shards`` over the whole documents table (NULL text: size 1; NULL id:
    key 0; repeated rows get a slot each; an empty table gives none)."""
    return jump_shards(table(spark, sf_dir, "documents"), shards=8)


def _jump_sql(shards: int, name: str, source: str) -> str:
    """CTE chain: one generator step after the other, for all rows."""
    ctes = [f"{name}0 AS (SELECT *, CASE WHEN coalesce(doc_id, 0) < 0 THEN coalesce(doc_id, 0)::HUGEINT + {JUMP_MODULUS} "
            f"ELSE coalesce(doc_id, 0)::HUGEINT END AS k, 0 AS b, 0::BIGINT AS j FROM {source})"]
    for i in range(1, shards + 1):
        ctes.append(
            f"{name}{i}a AS (SELECT * REPLACE (CASE WHEN j < {shards} THEN (k * {JUMP_MULTIPLIER} + 1) % {JUMP_MODULUS} "
            f"ELSE k END AS k, CASE WHEN j < {shards} THEN j ELSE b END AS b), j < {shards} AS going FROM {name}{i - 1}),\n"
            f"{name}{i} AS (SELECT * EXCLUDE (going) REPLACE (CASE WHEN going THEN floor((j + 1) * ({JUMP_SCALE}::DOUBLE / "
            f"((k // {JUMP_SHIFT}) + 1)::DOUBLE))::BIGINT ELSE j END AS j) FROM {name}{i}a)")
    return ",\n".join(ctes)


def _sql() -> str:
    table_of = ", ".join(
        f"({i})" for i in range(256))
    return f"""
WITH RECURSIVE crc(i, v, step) AS (
  SELECT i::UBIGINT, i::UBIGINT, 0 FROM (VALUES {table_of}) AS t(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, step + 1 FROM crc WHERE step < 8),
lookup AS (SELECT list(v ORDER BY i) AS t FROM crc WHERE step = 8),
d AS (
  SELECT doc_id, (octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS size,
    list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda x: ('0x' || x)::UBIGINT)) AS bytes, t
  FROM documents, lookup),
r AS (
  SELECT doc_id, size,
    xor(list_reduce(bytes, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32,
    coalesce(((doc_id % {SLOT_BLOCKS}) + {SLOT_BLOCKS}) % {SLOT_BLOCKS}, 0) AS block
  FROM d),
{_jump_sql(8, "e", "r")},
s AS (SELECT doc_id, size, text_crc32, block, b::INTEGER AS shard FROM e8),
{_jump_sql(9, "g", "s")}
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY block, doc_id NULLS FIRST, size, text_crc32) - 1)::BIGINT AS slot,
  b::INTEGER AS grown_shard
FROM g9
"""


QUERIES = {"op5_jump_shards": op5_jump_shards}
ORACLES = {"op5_jump_shards": _sql()}
