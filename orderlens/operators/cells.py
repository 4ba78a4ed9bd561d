"""Stored cells of the fact: additive sums and exact, mergeable sets of buyers
(AG4, ME7, AG12, MT8-MT11 from one scan of the fact).

Customers are numbered once; a cell keeps its buyers as bitmaps of those
numbers, one for each stretch of 32,768, and its sums.  Cells of any coarser
slicing come from them by adding sums and by OR-ing bitmaps, so a distinct count
by any subset of the slicers needs no second look at the order lines.

``build`` makes the cells of several key sets in one pass; ``route`` picks the
smallest key set that has a question's slicers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Customers in a block of numbers: the block's hash share stays below the
#: 65,536 numbers it has room for.
BLOCK_CUSTOMERS, BLOCK_NUMBERS = 60_000, 1 << 16

#: Additive columns of a cell, in the marts' names.
SUMS = ("_rev", "_rev_n", "total_orders", "total_units", "_margin", "_disc", "_disc_n", "visits", "cart_additions",
        "completed_orders")
KEY_SETS = (("week_start", "customer_segment", "sales_channel"), ("campaign_name",))
#: Number of the key set a row belongs to.
KEY_SET = "key_set"


def customer_numbers(customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """(key, number): a number for each customer, numbered side by side in
    blocks of the key's hash, never in one task."""
    ids = customers.select(key).where(F.col(key).isNotNull()).distinct()
    blocks = -(-max(ids.count(), 1) // BLOCK_CUSTOMERS)
    ids = ids.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(blocks)))
    within = F.row_number().over(Window.partitionBy("_block").orderBy(key)) - 1
    return ids.select(key, (F.col("_block") * BLOCK_NUMBERS + within).cast("long").alias("number"))


def build(completed: DataFrame, customers: DataFrame, key_sets: Sequence[Sequence[str]] = KEY_SETS) -> DataFrame:
    """Cells of completed order lines: key_set, the keys of all sets (NULL
    outside a row's set), stretch, sums, ``buyers`` and ``repeat_buyers``.

    ``customers`` has customer_id and is_repeat_customer.  Lines are reduced to
    a row per (keys, customer) before the customer's number joins them.  Lines
    without customer count in the sums only."""
    keys = list(dict.fromkeys(k for s in key_sets for k in s))
    rows = completed.groupBy(*keys, "customer_id").agg(
        F.sum("revenue").alias("_rev"), F.count("revenue").alias("_rev_n"), F.count("order_id").alias("total_orders"),
        F.sum("quantity").alias("total_units"), F.sum("margin").alias("_margin"), F.sum("discount").alias("_disc"),
        F.count("discount").alias("_disc_n"), F.sum("visits").alias("visits"),
        F.sum("cart_additions").alias("cart_additions"), F.sum("completed_orders").alias("completed_orders"))
    numbers = customer_numbers(customers).join(
        customers.select(F.col("customer_id").alias("_c"), "is_repeat_customer"), F.col("customer_id") == F.col("_c"))
    rows = rows.join(numbers.select("_c", "number", "is_repeat_customer"), F.col("customer_id") == F.col("_c"), "left")
    position = F.bitmap_bit_position(F.col("number"))
    # one row for each key set: the sets' keys are NULL outside it
    sets = F.explode(F.array(*[F.struct(F.lit(i).alias(KEY_SET), *[
        (F.col(k) if k in s else F.lit(None).cast(completed.schema[k].dataType)).alias(k) for k in keys])
        for i, s in enumerate(key_sets)]))
    rows = rows.select(sets.alias("_s"), *SUMS, F.bitmap_bucket_number(F.col("number")).alias("stretch"), position.alias("_p"),
                       F.when(F.col("is_repeat_customer"), position).alias("_r"))
    # a cell's rows meet before its bitmaps are made: what is sorted and sent is a
    # position, not a bitmap for each task and cell.  A cell has a stretch's buyers
    cell = [KEY_SET, *keys, "stretch"]
    return rows.select("_s.*", *SUMS, "stretch", "_p", "_r").repartition(*cell).groupBy(*cell).agg(
        *[F.sum(c).alias(c) for c in SUMS], F.bitmap_construct_agg(F.col("_p")).alias("buyers"),
        F.bitmap_construct_agg(F.col("_r")).alias("repeat_buyers"))


def route(slicers: Sequence[str], key_sets: Sequence[Sequence[str]] = KEY_SETS) -> int:
    """The key set of fewest keys that has all slicers."""
    able = [(len(s), i) for i, s in enumerate(key_sets) if set(slicers) <= set(s)]
    if not able:
        raise ValueError(f"no cells by {sorted(slicers)}: key sets are {[list(s) for s in key_sets]}")
    return min(able)[1]


def roll_up(cells: DataFrame, by: Sequence[str] = (), where=None, slicers: Sequence[str] = (),
            key_sets: Sequence[Sequence[str]] = KEY_SETS) -> DataFrame:
    """Sums, unique_customers and repeat_customers by ``by`` under a condition
    ``where`` on the columns ``slicers``; the distinct counts are exact."""
    cells = cells.where(F.col(KEY_SET) == route([*by, *slicers], key_sets))
    if where is not None:
        cells = cells.where(where)
    # bitmaps of one stretch meet first, then their counts add up
    stretches = cells.groupBy(*by, "stretch").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.bitmap_or_agg(F.col("buyers")).alias("_b"),
        F.bitmap_or_agg(F.col("repeat_buyers")).alias("_r"))
    return stretches.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.coalesce(F.sum(F.bitmap_count(F.col("_b"))), F.lit(0)).alias("unique_customers"),
        F.coalesce(F.sum(F.bitmap_count(F.col("_r"))), F.lit(0)).alias("repeat_customers"))


def mart_sums(cells: DataFrame, key: str) -> DataFrame:
    """The sums of one mart: a row for each value of ``key``, without NULL."""
    return roll_up(cells, [key]).where(F.col(key).isNotNull())
