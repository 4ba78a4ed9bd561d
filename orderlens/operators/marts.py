"""Star schema and KPI marts (MT4-MT11).

All money is summed as DECIMAL (exact, order-independent) and converted to
DOUBLE only at the output; means are ``double(sum) / count``; ratios are
rounded half-to-even on the scaled double (``exprs.rnd``).

Scale notes:
* every mart is one or two hash aggregates over the clean fact (partial
  aggregation before the shuffle, so a hot key is pre-reduced map-side);
* grand totals (revenue share) are scalar subqueries - a distributed global
  aggregate - rather than an un-partitioned window;
* the only un-partitioned windows (week-over-week lags) run on the weekly
  aggregate, bounded by the number of weeks;
* "repeat customer" counts flag the distinct (group, customer) rows of the
  first aggregation level - never order lines - by joining them to the
  repeat customers, so unique and repeat customers share one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.constants import DIM_DATE_BUFFER_DAYS, FACT_COLUMNS
from orderlens.functions import exprs as E
from orderlens.operators import features as FT

ROW_ORDER = ("order_date", "order_id")

MONEY_COLUMNS = ("unit_price", "discount", "revenue", "margin")


def row_order():
    return F.struct(*[F.col(c) for c in ROW_ORDER])


def completed(df: DataFrame) -> DataFrame:
    """PF1."""
    return df.filter(F.col("is_completed"))


def select_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PF2: projection by an ordered list, skipping absent columns."""
    present = set(df.columns)
    return df.select(*[c for c in cols if c in present])


def fact_orders(clean: DataFrame) -> DataFrame:
    """MT4: the 28-column fact; money columns exported as DOUBLE."""
    df = select_present(clean, FACT_COLUMNS)
    return df.withColumns({c: F.col(c).cast("double") for c in MONEY_COLUMNS if c in df.columns})


def dim_customers(clean: DataFrame, rfm: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """MT5: one row per customer with any order.  Attributes are the first
    non-missing value in row order; RFM values of customers that never
    completed an order are 0 / False.  ``groups`` are the lines'
    ``customer_groups`` where they are at hand."""
    if groups is None:
        o = row_order()
        base = clean.groupBy("customer_id").agg(*[E.first_by(c, o).alias(c) for c in FT.CUSTOMER_ATTRIBUTES])
    else:
        base = FT.first_values(groups, clean, "customer_id", FT.CUSTOMER_ATTRIBUTES)
    out = base.join(rfm.select("customer_id", "days_since_last_purchase", "purchase_frequency",
                               "total_revenue", "avg_order_value", "is_repeat_customer", "is_churned"),
                    "customer_id", "left")
    return out.na.fill({"days_since_last_purchase": 0, "purchase_frequency": 0,
                        "total_revenue": 0.0, "avg_order_value": 0.0,
                        "is_repeat_customer": False, "is_churned": False})


def dim_products(clean: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """MT6: product name / category (first in row order) and mean unit price, 2 dp.
    ``groups`` are the lines' ``product_groups`` where they are at hand."""
    if groups is None:
        o = row_order()
        rows = (clean.groupBy("product_id")
                .agg(*[E.first_by(c, o).alias(c) for c in FT.PRODUCT_ATTRIBUTES],
                     (F.sum("unit_price").cast("double") / F.count("unit_price")).alias("_price")))
    else:
        price = groups.groupBy("product_id").agg(
            (F.sum("_price").cast("double") / F.sum("_price_n")).alias("_price"))
        rows = FT.first_values(groups, clean, "product_id", FT.PRODUCT_ATTRIBUTES).join(price, "product_id")
    return (rows
            .select("product_id", "product_name", "product_category",
                    E.rnd("_price", 2).alias("unit_price")))


def dim_date(clean: DataFrame, buffer_days: int = DIM_DATE_BUFFER_DAYS) -> DataFrame:
    """MT7: one row per day from the first order date to the last + 6 weeks."""
    span = clean.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    days = span.select(F.explode(F.sequence(F.col("lo"), F.date_add(F.col("hi"), buffer_days)))
                       .alias("date"))
    parts = E.date_parts("date")
    return days.select(
        "date",
        E.week_start("date").alias("week_start"),
        parts["year"].alias("year"),
        parts["quarter"].alias("quarter"),
        parts["month"].alias("month"),
        E.month_name("date").alias("month_name"),
        parts["week_number"].alias("week_number"),
        E.iso_year_week("date").alias("year_week"),
    )


def new_customers_by_week(clean: DataFrame) -> DataFrame:
    """AG10: distinct customers (having any order) per signup week, of lines or
    of their ``customer_groups``."""
    return (clean.filter(F.col("customer_signup_date").isNotNull())
            .groupBy(E.week_start("customer_signup_date").alias("week_start"))
            .agg(F.count_distinct("customer_id").alias("new_customers")))


def repeat_customers_by(clean: DataFrame, rfm: DataFrame, key: str,
                        out: str = "repeat_customers") -> DataFrame:
    """Distinct completed buyers per ``key`` whose lifetime flag is repeat.

    Distinct (key, customer) pairs are formed first (partial aggregation),
    then semi-joined to the repeat customers, so order lines never travel to
    the customer side."""
    repeaters = rfm.filter(F.col("is_repeat_customer")).select("customer_id")
    pairs = (completed(clean).filter(F.col(key).isNotNull())
             .select(key, "customer_id").distinct())
    return (pairs.join(repeaters, "customer_id", "left_semi")
            .groupBy(key).agg(F.count(F.lit(1)).alias(out)))


def _sums_with_customers(comp: DataFrame, key: str, rfm: DataFrame) -> DataFrame:
    """The ``_weekly_sums`` aggregates plus distinct repeat customers, in one
    pass over the fact: level 1 aggregates per (key, customer) - combined
    map-side - and level 2 merges per key, where distinct customers are a
    count of level-1 rows and repeat customers a count of flagged ones.
    The flag comes from joining the (key, customer) rows, not order lines,
    to the repeat customers."""
    lvl1 = (comp.filter(F.col(key).isNotNull())
            .groupBy(key, "customer_id")
            .agg(F.sum("revenue").alias("_rev"),
                 F.count("revenue").alias("_rev_n"),
                 F.count("order_id").alias("_orders"),
                 F.sum("quantity").alias("_units"),
                 F.sum("margin").alias("_margin"),
                 F.sum("discount").alias("_disc"),
                 F.count("discount").alias("_disc_n"),
                 F.sum("visits").alias("_visits"),
                 F.sum("cart_additions").alias("_carts"),
                 F.sum("completed_orders").alias("_completed")))
    repeaters = (rfm.filter(F.col("is_repeat_customer")).select("customer_id")
                 .withColumn("_rep", F.lit(True)))
    flagged = lvl1.join(repeaters, "customer_id", "left")
    return (flagged.groupBy(key)
            .agg(F.sum("_rev").alias("_rev"),
                 F.sum("_rev_n").alias("_rev_n"),
                 F.sum("_orders").alias("total_orders"),
                 F.sum("_units").alias("total_units"),
                 F.sum("_margin").alias("_margin"),
                 F.count("customer_id").alias("unique_customers"),
                 F.sum("_disc").alias("_disc"),
                 F.sum("_disc_n").alias("_disc_n"),
                 F.sum("_visits").alias("visits"),
                 F.sum("_carts").alias("cart_additions"),
                 F.sum("_completed").alias("completed_orders"),
                 F.count_if(F.col("_rep") & F.col("customer_id").isNotNull()).alias("repeat_customers")))


def _weekly_sums(comp: DataFrame, key: str) -> DataFrame:
    return (comp.filter(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.sum("revenue").alias("_rev"),
                 F.count("revenue").alias("_rev_n"),
                 F.count("order_id").alias("total_orders"),
                 F.sum("quantity").alias("total_units"),
                 F.sum("margin").alias("_margin"),
                 F.count_distinct("customer_id").alias("unique_customers"),
                 F.sum("discount").alias("_disc"),
                 F.count("discount").alias("_disc_n"),
                 F.sum("visits").alias("visits"),
                 F.sum("cart_additions").alias("cart_additions"),
                 F.sum("completed_orders").alias("completed_orders")))


WEEKLY_COLUMNS = (
    "week_start", "total_revenue", "total_orders", "total_units", "total_margin",
    "avg_order_value", "unique_customers", "avg_discount", "visits", "cart_additions",
    "completed_orders", "gross_margin_pct", "conversion_rate", "cart_abandonment_rate",
    "revenue_wow_growth", "orders_wow_growth", "new_customers", "repeat_customers",
)


def weekly_kpis(clean: DataFrame, rfm: DataFrame, sums: DataFrame | None = None,
                groups: DataFrame | None = None) -> DataFrame:
    """MT8: one row per week with at least one completed order.

    Week-over-week growth is the change against the previous *row* (not the
    calendar week), computed on the unrounded sums and rounded to 4 dp.  ``sums``
    are the weeks' sums where they are at hand (``cells.roll_up``), ``groups`` the
    lines' ``customer_groups``."""
    wk = _sums_with_customers(completed(clean), "week_start", rfm) if sums is None else sums
    rev = F.col("_rev").cast("double")
    by_week = Window.orderBy("week_start")
    wk = wk.select(
        "week_start",
        E.rnd(rev, 2).alias("total_revenue"),
        "total_orders", "total_units",
        E.rnd(F.col("_margin").cast("double"), 2).alias("total_margin"),
        E.rnd(rev / F.col("_rev_n"), 2).alias("avg_order_value"),
        "unique_customers",
        (F.col("_disc").cast("double") / F.col("_disc_n")).alias("avg_discount"),
        "visits", "cart_additions", "completed_orders",
        E.rnd(E.ratio("_margin", "_rev"), 4).alias("gross_margin_pct"),
        E.rnd(E.clip01(E.ratio("completed_orders", "visits")), 4).alias("conversion_rate"),
        E.rnd(E.clip01(F.lit(1.0) - E.ratio("completed_orders", "cart_additions")), 4)
        .alias("cart_abandonment_rate"),
        E.pct_change(rev, F.lag(rev, 1).over(by_week)).alias("revenue_wow_growth"),
        E.pct_change(F.col("total_orders"), F.lag("total_orders", 1).over(by_week))
        .alias("orders_wow_growth"),
        "repeat_customers",
    )
    wk = (wk.join(new_customers_by_week(clean if groups is None else groups), "week_start", "left")
          .na.fill({"new_customers": 0}))
    return wk.select(*WEEKLY_COLUMNS)


def performance_by(clean: DataFrame | None, dim: str, sums: DataFrame | None = None) -> DataFrame:
    """MT9 / MT10: revenue, orders, customers, AOV, margin, discount, margin %
    and share of total revenue per value of ``dim`` (completed orders)."""
    if sums is None:
        comp = completed(clean)
        grand = comp.filter(F.col(dim).isNotNull()).agg(F.sum("revenue").cast("double")).scalar()
        g = _weekly_sums(comp, dim)
    else:
        g = sums
        grand = g.agg(F.sum("_rev").cast("double")).scalar()
    rev = F.col("_rev").cast("double")
    return (g.select(
        dim,
        rev.alias("total_revenue"),
        "total_orders", "unique_customers",
        E.rnd(rev / F.col("_rev_n"), 2).alias("avg_order_value"),
        F.col("_margin").cast("double").alias("total_margin"),
        (F.col("_disc").cast("double") / F.col("_disc_n")).alias("avg_discount"),
        E.rnd(E.ratio("_margin", "_rev"), 4).alias("gross_margin_pct"),
        E.rnd(E.ratio(rev, grand), 4).alias("revenue_share"),
    ).orderBy(F.desc("total_revenue"), F.asc(dim)))


def segment_performance(clean: DataFrame | None, rfm: DataFrame | None, sums: DataFrame | None = None) -> DataFrame:
    """MT11: per customer segment, with distinct repeat customers and the
    repeat rate (no discount / share columns)."""
    g = _sums_with_customers(completed(clean), "customer_segment", rfm) if sums is None else sums
    rev = F.col("_rev").cast("double")
    return (g.select(
        "customer_segment",
        rev.alias("total_revenue"),
        "total_orders", "unique_customers",
        E.rnd(rev / F.col("_rev_n"), 2).alias("avg_order_value"),
        F.col("_margin").cast("double").alias("total_margin"),
        "repeat_customers",
        E.rnd(E.ratio("_margin", "_rev"), 4).alias("gross_margin_pct"),
        E.rnd(E.ratio("repeat_customers", "unique_customers"), 4).alias("repeat_rate"),
    ).orderBy(F.desc("total_revenue"), F.asc("customer_segment")))
