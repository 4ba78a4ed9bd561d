"""Cleaning operators (CL1-CL8) and the row-count audit (IO10).

``clean`` reproduces the source model's cleaning step as one lazy chain:

1. CL1 keep-first de-duplication on ``order_id``
2. CL2 coercing numeric casts (bad text -> NULL, NaN -> NULL), CL3 discount NULL -> 0
3. CL4 ``revenue > 0``, ``quantity > 0``, ``unit_price > 0``; CL5 discount in [0, 1]
4. CL6 drop rows missing any key column
5. DT1-DT3 date parts and Monday week start; CL7 completion flag

Cancelled / refunded orders are kept and only flagged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderlens.constants import COMPLETED_STATUS
from orderlens.functions import exprs as E

NUMERIC_COLUMNS = ("quantity", "unit_price", "discount", "revenue", "margin")
KEY_COLUMNS = ("order_id", "customer_id", "product_id", "order_date")


def dedup_keep_first(df: DataFrame, key: str | Sequence[str],
                     order: Sequence[str | Column]) -> DataFrame:
    """CL1: one row per ``key``, the first in ``order`` (ascending, NULLs first).

    Implemented as ``groupBy(key).agg(min(struct(order, row)))`` so that the
    aggregation combines map-side: duplicates of a hot key are reduced in the
    map task before the shuffle and no key's rows are ever buffered whole.
    ``order`` must be a total order of the rows that can differ (e.g. a
    file-position column for file order)."""
    keys = [key] if isinstance(key, str) else list(key)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    order_fields = [oc.alias(f"_o{i}") for i, oc in enumerate(order_cols)]
    payload = [F.col(c) for c in df.columns if c not in keys]
    packed = F.struct(*order_fields, F.struct(*payload).alias("_row"))
    return (df.groupBy(*keys)
            .agg(F.min(packed).alias("_first"))
            .select(*keys, "_first._row.*")
            .select(*df.columns))


def coerce_numeric(df: DataFrame, cols: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """CL2: text columns get a coercing cast to DOUBLE; float columns get
    NaN -> NULL; exact numeric columns (integers, decimals) are kept."""
    types = dict(df.dtypes)
    out = {}
    for c in cols:
        if c not in types:
            continue
        t = types[c]
        if t == "string":
            out[c] = E.coerce_double(c)
        elif t in ("double", "float"):
            out[c] = E.nan_to_null(c)
    return df.withColumns(out) if out else df


def apply_business_rules(df: DataFrame) -> DataFrame:
    """CL3-CL5.  NULL fails every comparison, matching the source where a
    missing value never passes a ``> 0`` mask."""
    df = df.withColumn("discount", F.coalesce(F.col("discount"),
                                              F.lit(0).cast(df.schema["discount"].dataType)))
    return df.filter(
        (F.col("revenue") > 0)
        & (F.col("quantity") > 0)
        & (F.col("unit_price") > 0)
        & F.col("discount").between(0, 1)
    )


def drop_missing_keys(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """CL6."""
    return df.na.drop(subset=[k for k in keys if k in df.columns])


def add_date_parts(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """DT1-DT3, DT8: date normalised to DATE, then year, month, ISO week,
    quarter (all BIGINT) and the Monday ``week_start``."""
    df = df.withColumn(date_col, F.col(date_col).cast("date"))
    parts = E.date_parts(date_col)
    parts["week_start"] = E.week_start(date_col)
    return df.withColumns(parts)


def flag_completed(df: DataFrame, completed_status: str = COMPLETED_STATUS) -> DataFrame:
    """CL7: ``is_completed``; a missing status is not completed."""
    return df.withColumn("is_completed",
                         F.coalesce(F.col("order_status") == F.lit(completed_status), F.lit(False)))


def clean(raw: DataFrame, *, completed_status: str = COMPLETED_STATUS,
          dedup_order: Sequence[str | Column] | None = None, dedup: bool = True,
          drop_columns: Sequence[str] = ()) -> DataFrame:
    """CL8: the whole cleaning step as one lazy chain.

    ``dedup_order`` is the keep-first order (for a CSV landing zone, the file
    position column added by ``read_raw_csv``).  ``dedup=False`` skips CL1
    when it has already been applied upstream (the driver-table adapter does
    it at line grain, below its joins)."""
    df = raw
    if dedup:
        if dedup_order is None:
            raise ValueError("keep-first de-duplication needs an explicit order")
        df = dedup_keep_first(df, "order_id", dedup_order)
    if drop_columns:
        df = df.drop(*drop_columns)
    df = coerce_numeric(df)
    df = apply_business_rules(df)
    df = drop_missing_keys(df)
    df = add_date_parts(df)
    return flag_completed(df, completed_status)


def rule_conditions() -> dict[str, Column]:
    """Rules in the order they are applied, each a condition that a row must meet
    (``discount`` already filled); a row counts for the first it fails."""
    passes = lambda c: F.coalesce(c, F.lit(False))
    return {
        "not_positive": passes((F.col("revenue") > 0) & (F.col("quantity") > 0) & (F.col("unit_price") > 0)),  # CL4
        "discount_out_of_range": passes(F.col("discount").between(0, 1)),  # CL5
        "missing_key": reduce(and_, [F.col(k).isNotNull() for k in KEY_COLUMNS]),  # CL6
    }


def clean_with_audit(raw: DataFrame, *, completed_status: str = COMPLETED_STATUS,
                     dedup_order: Sequence[str | Column], drop_columns: Sequence[str] = ()) -> tuple[DataFrame, Callable]:
    """CL8 with IO10 by rule in the same pass.

    Returns the clean frame and a function that, once an action has run over the
    whole of it (the stage write), returns the counts: rows_before, removed_<rule>
    for duplicates and every rule, discount_filled, rows_after.  A row's failed
    rules are one bit mask; the counts are observed metrics of the plan, so no
    row is read again."""
    seen, kept = Observation(), Observation()
    df = dedup_keep_first(raw.observe(seen, F.count(F.lit(1)).alias("rows_before")), "order_id", dedup_order)
    df = coerce_numeric(df.drop(*drop_columns) if drop_columns else df)
    filled = F.col("discount").isNull()
    df = df.withColumn("_filled", filled).withColumn("discount", F.coalesce(
        F.col("discount"), F.lit(0).cast(df.schema["discount"].dataType)))
    rules = rule_conditions()
    mask = F.lit(0)
    for i, holds in enumerate(rules.values()):
        mask = mask + F.when(holds, 0).otherwise(1 << i)
    df = df.withColumn("_failed", mask)
    low = lambda i: F.col("_failed").bitwiseAND((1 << (i + 1)) - 1) == (1 << i)  # noqa: E731  none before, this one
    df = df.observe(kept, F.count(F.lit(1)).alias("rows_distinct"), F.count_if(F.col("_filled")).alias("discount_filled"),
                    F.count_if(F.col("_failed") == 0).alias("rows_after"),
                    *[F.count_if(low(i)).alias(f"removed_{name}") for i, name in enumerate(rules)])
    df = df.where(F.col("_failed") == 0).drop("_failed", "_filled")

    def counts() -> dict[str, int]:
        got = seen.get | kept.get
        return {"rows_before": got["rows_before"], "removed_duplicate": got["rows_before"] - got["rows_distinct"],
                **{f"removed_{r}": got[f"removed_{r}"] for r in rules}, "discount_filled": got["discount_filled"],
                "rows_after": got["rows_after"]}

    return flag_completed(add_date_parts(df), completed_status), counts


def clean_audit(raw: DataFrame, deduped: DataFrame, cleaned: DataFrame) -> DataFrame:
    """IO10: one-row audit of rows before / after de-duplication / after the
    rules, and rows removed.  The first two counts are scalar subqueries of
    the final one-row aggregate, so no join is involved."""
    before = raw.agg(F.count(F.lit(1))).scalar()
    after_dedup = deduped.agg(F.count(F.lit(1))).scalar()
    return (cleaned.agg(F.count(F.lit(1)).alias("rows_after"))
            .select(before.alias("rows_before"), after_dedup.alias("rows_after_dedup"), "rows_after")
            .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after")))
