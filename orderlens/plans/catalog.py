"""Query catalog: every registered query is ``fn(spark, sf_dir) -> DataFrame``
over the driver tables, paired (where the result is deterministic) with an
equivalent DuckDB SQL oracle.

Queries that consume model predictions in the source are fed deterministic
stand-ins here so they keep an exact oracle: forecast / demand prediction =
the previous row's actual, churn probability =
``rnd4(least(days_since_last_purchase / 180, 1))``.  The learned versions
are the rows-only entries registered by ``plans.models``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import cells as CE
from orderlens.operators import clean as C
from orderlens.operators import features as FT
from orderlens.operators import marts as M
from orderlens.plans import oracle as O
from orderlens.plans import stages as S
from orderlens.sources import tables as TB

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _money_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in M.MONEY_COLUMNS if c in df.columns})


# ---------------------------------------------------------------------------
# Cleaning
# ---------------------------------------------------------------------------

DEDUP_COLUMNS = ("order_id", "product_id", "l_suppkey", "quantity", "discount", "revenue",
                 "l_tax", "payment_method", "completed_orders", "customer_id", "order_date")


@register("dedup_keep_first", O.with_base(f"""
SELECT order_id, product_id, l_suppkey, quantity, CAST(discount AS DOUBLE) AS discount,
       CAST(revenue AS DOUBLE) AS revenue, l_tax, payment_method, completed_orders,
       customer_id, order_date
FROM raw"""))
def q_dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CL1 replayed on the wide joined frame (duplicates included)."""
    raw = TB.raw_orders(spark, sf_dir, dedup=False)
    # only the reported columns ride through the aggregate (the struct is
    # opaque to column pruning, so project first)
    cols = list(dict.fromkeys([*DEDUP_COLUMNS, *TB.LINE_KEEP_FIRST_ORDER]))
    out = C.dedup_keep_first(raw.select(*cols), "order_id", TB.LINE_KEEP_FIRST_ORDER)
    return _money_as_double(out.select(*DEDUP_COLUMNS))


CLEAN_COLUMNS = (
    "order_id", "order_date", "customer_id", "customer_segment", "customer_signup_date",
    "product_id", "product_category", "product_name", "quantity", "unit_price", "discount",
    "revenue", "margin", "city", "sales_channel", "campaign_name", "payment_method",
    "visits", "cart_additions", "completed_orders", "order_status",
    "year", "month", "week_number", "quarter", "week_start", "is_completed",
)


@register("clean_orders", O.with_base(f"""
SELECT {', '.join(c if c not in M.MONEY_COLUMNS else f'CAST({c} AS DOUBLE) AS {c}' for c in CLEAN_COLUMNS)}
FROM cl"""))
def q_clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CL2-CL8 (with CL1 pushed below the joins) on the driver tables."""
    return _money_as_double(S.orders_clean(spark, sf_dir).select(*CLEAN_COLUMNS))


@register("clean_audit", O.with_base("""
SELECT (SELECT count(*) FROM raw_all) AS rows_before,
       (SELECT count(*) FROM raw) AS rows_after_dedup,
       (SELECT count(*) FROM cl) AS rows_after,
       (SELECT count(*) FROM raw_all) - (SELECT count(*) FROM cl) AS rows_removed"""))
def q_clean_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = TB.raw_orders(spark, sf_dir, dedup=False)
    deduped = TB.raw_orders(spark, sf_dir, dedup=True)
    return C.clean_audit(raw, deduped, S.orders_clean(spark, sf_dir))


# ---------------------------------------------------------------------------
# Features
# ---------------------------------------------------------------------------

@register("customer_rfm", O.with_base("""
SELECT customer_id, last_purchase_date, days_since_last_purchase, purchase_frequency,
       total_revenue, avg_order_value, total_units, is_repeat_customer, is_churned
FROM rfm"""))
def q_customer_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT1 from the fact (consumers read the stored table)."""
    return FT.customer_rfm(S.orders_clean(spark, sf_dir))


PRODUCT_WEEKLY_SQL = """
pw AS (
  SELECT product_id, week_start, CAST(sum(quantity) AS BIGINT) AS weekly_units
  FROM comp GROUP BY product_id, week_start
),
pwr AS (
  SELECT product_id, week_start, weekly_units,
         avg(weekly_units) OVER (PARTITION BY product_id ORDER BY week_start
                                 ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS rolling_4w_units
  FROM pw
)"""


@register("product_rolling_units", O.with_base(
    "SELECT product_id, week_start, weekly_units, rolling_4w_units FROM pwr", PRODUCT_WEEKLY_SQL))
def q_product_rolling_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FT.product_weekly_units(S.orders_clean(spark, sf_dir))


@register("order_funnel", O.with_base("""
SELECT order_id, visits, cart_additions, completed_orders, conversion_rate, cart_abandonment_rate
FROM cl"""))
def q_order_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    cl = S.orders_clean(spark, sf_dir).select("order_id", "visits", "cart_additions", "completed_orders")
    return FT.add_funnel_features(cl)


FEATURE_COLUMNS = (
    "order_id", "customer_id", "product_id", "week_start", "is_completed",
    "days_since_last_purchase", "purchase_frequency", "total_revenue", "avg_order_value",
    "is_repeat_customer", "is_churned", "weekly_units", "rolling_4w_units",
    "conversion_rate", "cart_abandonment_rate",
)


@register("orders_features", O.with_base(f"""
SELECT cl.order_id, cl.customer_id, cl.product_id, cl.week_start, cl.is_completed,
       r.days_since_last_purchase, r.purchase_frequency, r.total_revenue, r.avg_order_value,
       r.is_repeat_customer, r.is_churned, p.weekly_units, p.rolling_4w_units,
       cl.conversion_rate, cl.cart_abandonment_rate
FROM cl
LEFT JOIN rfm r ON r.customer_id = cl.customer_id
LEFT JOIN pwr p ON p.product_id = cl.product_id AND p.week_start = cl.week_start""", PRODUCT_WEEKLY_SQL))
def q_orders_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT1-MT3 joined back to the order lines (JN1, JN2)."""
    cl = S.orders_clean(spark, sf_dir)
    df = FT.add_customer_features(cl, S.customers(spark, sf_dir))
    df = FT.add_product_features(df, FT.product_weekly_units(cl))
    return df.select(*FEATURE_COLUMNS)


# ---------------------------------------------------------------------------
# Star schema and marts
# ---------------------------------------------------------------------------

@register("fact_orders", O.with_base(f"""
SELECT {', '.join(c if c not in M.MONEY_COLUMNS else f'CAST({c} AS DOUBLE) AS {c}' for c in M.FACT_COLUMNS)}
FROM cl"""))
def q_fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.fact_orders(S.orders_clean(spark, sf_dir))


@register("dim_customers", O.with_base(f"""
SELECT b.customer_id, b.customer_segment, b.city, b.customer_signup_date,
       COALESCE(r.days_since_last_purchase, 0) AS days_since_last_purchase,
       COALESCE(r.purchase_frequency, 0) AS purchase_frequency,
       COALESCE(r.total_revenue, 0.0) AS total_revenue,
       COALESCE(r.avg_order_value, 0.0) AS avg_order_value,
       COALESCE(r.is_repeat_customer, false) AS is_repeat_customer,
       COALESCE(r.is_churned, false) AS is_churned
FROM (SELECT customer_id,
             {O.first_by('customer_segment')} AS customer_segment,
             {O.first_by('city')} AS city,
             {O.first_by('customer_signup_date')} AS customer_signup_date
      FROM cl GROUP BY customer_id) b
LEFT JOIN rfm r ON r.customer_id = b.customer_id"""))
def q_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.dim_customers(S.orders_clean(spark, sf_dir), S.customers(spark, sf_dir))


@register("dim_products", O.with_base(f"""
SELECT product_id, {O.first_by('product_name')} AS product_name,
       {O.first_by('product_category')} AS product_category,
       {O.rnd('CAST(sum(unit_price) AS DOUBLE) / count(unit_price)', 2)} AS unit_price
FROM cl GROUP BY product_id"""))
def q_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.dim_products(S.orders_clean(spark, sf_dir))


@register("dim_date", O.with_base(f"""
SELECT CAST(d AS DATE) AS date, {O.week_start('d')} AS week_start,
       CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS quarter,
       CAST(month(d) AS BIGINT) AS month, monthname(d) AS month_name,
       CAST(week(d) AS BIGINT) AS week_number, strftime(d, '%G-W%V') AS year_week
FROM (SELECT unnest(generate_series(min(order_date), max(order_date) + INTERVAL 42 DAY, INTERVAL 1 DAY)) AS d
      FROM cl)"""))
def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.dim_date(S.orders_clean(spark, sf_dir))


@register("weekly_kpis", O.with_base("SELECT * FROM weekly", O.WEEKLY_CTE))
def q_weekly_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: MT8 weekly KPI mart."""
    return M.weekly_kpis(S.orders_clean(spark, sf_dir), S.customers(spark, sf_dir))


@register("new_customers_by_week", O.with_base("SELECT * FROM new_c", O.WEEKLY_CTE))
def q_new_customers_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.new_customers_by_week(S.orders_clean(spark, sf_dir))


@register("repeat_customers_by_week", O.with_base("SELECT * FROM rep_c", O.WEEKLY_CTE))
def q_repeat_customers_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.repeat_customers_by(S.orders_clean(spark, sf_dir), S.customers(spark, sf_dir), "week_start")


@register("campaign_performance", O.performance_sql("campaign_name"))
def q_campaign_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.performance_by(S.orders_clean(spark, sf_dir), "campaign_name")


@register("weekly_kpis_cells", O.with_base("SELECT * FROM weekly", O.WEEKLY_CTE))
def q_weekly_kpis_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT8 from the stored cells: sums added, buyers' bitmaps OR-ed."""
    return M.weekly_kpis(S.orders_clean(spark, sf_dir), S.customers(spark, sf_dir),
                         _cell_sums(spark, sf_dir, "week_start"))


@register("campaign_performance_cells", O.performance_sql("campaign_name"))
def q_campaign_performance_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT9 from the stored cells."""
    return M.performance_by(None, "campaign_name", _cell_sums(spark, sf_dir, "campaign_name"))


@register("channel_performance_cells", O.performance_sql("sales_channel"))
def q_channel_performance_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT10 from the stored cells."""
    return M.performance_by(None, "sales_channel", _cell_sums(spark, sf_dir, "sales_channel"))


def _cell_sums(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return CE.mart_sums(S.cells(spark, sf_dir), key)


ACTIVE_SUBSETS = ((), ("customer_segment",), ("sales_channel",), ("customer_segment", "sales_channel"))


@register("active_customers_cells", O.with_base("""
SELECT CAST(year(week_start) AS BIGINT) AS year, customer_segment, sales_channel,
       count(DISTINCT customer_id) AS active_customers, count(*) AS total_orders
FROM comp GROUP BY GROUPING SETS ((year(week_start)), (year(week_start), customer_segment),
  (year(week_start), sales_channel), (year(week_start), customer_segment, sales_channel))"""))
def q_active_customers_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ME7 by the year of the week and any subset of segment and channel, from
    the cells alone: exact distinct buyers without a scan of the fact."""
    cells = S.cells(spark, sf_dir).withColumn("year", F.year("week_start").cast("bigint"))
    sets = [("year", *CE.KEY_SETS[0])]
    out = None
    for subset in ACTIVE_SUBSETS:
        part = CE.roll_up(cells, ["year", *subset], key_sets=sets)
        part = part.select("year", *[F.col(c) if c in subset else F.lit(None).cast("string").alias(c)
                                     for c in ("customer_segment", "sales_channel")],
                           F.col("unique_customers").alias("active_customers"), "total_orders")
        out = part if out is None else out.unionByName(part)
    return out


@register("sales_channel_performance", O.performance_sql("sales_channel"))
def q_sales_channel_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.performance_by(S.orders_clean(spark, sf_dir), "sales_channel")


@register("segment_performance", O.with_base(f"""
SELECT g.customer_segment, CAST(_rev AS DOUBLE) AS total_revenue, total_orders, unique_customers,
       {O.rnd('CAST(_rev AS DOUBLE) / _rev_n', 2)} AS avg_order_value,
       CAST(_margin AS DOUBLE) AS total_margin,
       COALESCE(r.repeat_customers, 0) AS repeat_customers,
       {O.rnd(O.ratio('_margin', '_rev'), 4)} AS gross_margin_pct,
       {O.rnd(O.ratio('COALESCE(r.repeat_customers, 0)', 'unique_customers'), 4)} AS repeat_rate
FROM g LEFT JOIN rep r ON r.customer_segment = g.customer_segment
ORDER BY total_revenue DESC, g.customer_segment""",
    f"g AS ({O.group_sums('customer_segment')}),\nrep AS ({O.repeat_by('customer_segment')})"))
def q_segment_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.segment_performance(S.orders_clean(spark, sf_dir), S.customers(spark, sf_dir))


ORACLES["segment_performance_cells"] = ORACLES["segment_performance"]


@register("segment_performance_cells")
def q_segment_performance_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT11 from the stored cells, repeat customers from their own bitmaps."""
    return M.segment_performance(None, None, _cell_sums(spark, sf_dir, "customer_segment"))


# ---------------------------------------------------------------------------
# CSV landing zone end to end (IO1, IO2, IO5, CL2 on text)
# ---------------------------------------------------------------------------

LANDING_COLUMNS = ("order_id", "customer_id", "order_date", "customer_signup_date", "week_start",
                   "quantity", "unit_price", "discount", "revenue", "margin", "visits",
                   "cart_additions", "completed_orders", "is_completed")


@register("csv_landing_clean", O.with_base(f"""
SELECT order_id, customer_id, order_date, customer_signup_date, week_start,
       CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount AS DOUBLE) AS discount, CAST(revenue AS DOUBLE) AS revenue,
       CAST(margin AS DOUBLE) AS margin, visits, cart_additions, completed_orders, is_completed
FROM cl"""))
def q_csv_landing_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw order lines (duplicates included) are written to a CSV landing
    folder in keep-first order, read back as text and cleaned: file-order
    de-duplication, coercing numeric casts, date parsing, rules."""
    # copies of a key lie in one file in keep-first order: the file order is what
    # the landing read de-duplicates by
    ordered = TB.raw_orders_in_keep_first_order(spark, sf_dir).select(*TB.RAW_COLUMNS)
    with S.hashed_joins(spark):
        landed = _landed(ordered, sf_dir, "clean", LANDING_COLUMNS)
    return landed.withColumns(
        {c: F.col(c).cast("double") for c in C.NUMERIC_COLUMNS})


def _landing(rows: DataFrame, sf_dir: str, name: str) -> str:
    """Write rows to a compressed CSV landing folder."""
    import hashlib
    import os

    from orderlens.session import ensure_checkpoint_dir
    from orderlens.sources import files as IO

    spark = rows.sparkSession
    digest = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:10]
    landing = os.path.join(ensure_checkpoint_dir(spark), f"orderlens-landing-{name}", digest)
    IO.write_csv(rows, landing, compressed=True)
    return landing


def _landed(rows: DataFrame, sf_dir: str, name: str, columns) -> DataFrame:
    """The landing read over rows written to a CSV landing folder."""
    from orderlens.sources import files as IO

    return IO.clean_raw_csv(rows.sparkSession, _landing(rows, sf_dir, name), TB.COMPLETED_STATUS_DRIVER,
                            columns=columns).select(*columns)


DIRTY_NAME = '24" Monitor, black'
DIRTY_COLUMNS = ("order_id", "customer_id", "customer_segment", "product_id", "product_name", "order_date",
                 *C.NUMERIC_COLUMNS, "visits", "cart_additions", "is_completed")


@register("csv_landing_dirty", O.with_base(f"""
SELECT order_id, customer_id, CASE WHEN k <> 12 THEN customer_segment END AS customer_segment, product_id,
       CASE WHEN k = 9 THEN '{DIRTY_NAME}' ELSE product_name END AS product_name, order_date,
       CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CASE WHEN k = 3 THEN 0.0 ELSE CAST(discount AS DOUBLE) END AS discount,
       CAST(revenue AS DOUBLE) AS revenue, CAST(margin AS DOUBLE) AS margin,
       CASE WHEN k = 10 THEN 3 ELSE visits END AS visits, CASE WHEN k = 10 THEN 2 ELSE cart_additions END AS cart_additions,
       order_status = 'F' AND k <> 13 AS is_completed
FROM (SELECT *, (CAST(split_part(order_id, '-', 1) AS BIGINT) * 7 + CAST(split_part(order_id, '-', 2) AS BIGINT)) % 23 AS k
      FROM raw) r
WHERE k NOT IN (0, 1, 2, 4, 5, 6, 7, 8, 11, 15) AND revenue > 0 AND quantity > 0 AND unit_price > 0
  AND discount BETWEEN 0 AND 1"""))
def q_csv_landing_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO1, CL1-CL6 on a dirty landing zone: a rule on the key spoils rows (bad
    and missing numbers, missing words as keys, discounts missing or out of
    range, doubled quotes beside a comma, counts as ``3.0``, later copies that
    must lose, first copies that fail and take the id with them)."""
    return _landed(_dirty_rows(spark, sf_dir), sf_dir, "dirty", DIRTY_COLUMNS).withColumns(
        {c: F.col(c).cast("double") for c in C.NUMERIC_COLUMNS})


def _dirty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = TB.raw_orders(spark, sf_dir, dedup=True).select(*TB.RAW_COLUMNS)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    key = F.split("order_id", "-")
    text = text.withColumn("k", (key[0].cast("bigint") * 7 + key[1].cast("bigint")) % 23)
    spoil = {"quantity": {0: "abc"}, "revenue": {1: "NaN", 11: "-5", 15: "-5"}, "unit_price": {2: "1.0d"},
             "discount": {3: None, 4: "1.5", 5: "-0.1"}, "customer_id": {6: "NA"}, "product_id": {7: "null"},
             "order_date": {8: "not a date"}, "product_name": {9: DIRTY_NAME}, "visits": {10: "3.0"},
             "cart_additions": {10: "2.0"}, "customer_segment": {12: "N/A"}, "order_status": {13: "Refunded"}}
    # a row and its later copy leave one task side by side, so the file has them
    # in keep-first order without a sort, and the lines are made once for both
    copies = F.when(F.col("k").isin(14, 15), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    both = text.withColumn("copy", F.explode(copies))
    spoiled = both.withColumns({c: F.when(F.col("copy") == 0, _spoiled(c, how)).otherwise(F.col(c))
                                for c, how in spoil.items()})
    return spoiled.withColumn("quantity", F.when(F.col("copy") == 1, F.lit("999")).otherwise(F.col("quantity"))).select(
        *TB.RAW_COLUMNS)


@register("clean_audit_rules", O.with_base("""
SELECT count(*) + count_if(k IN (14, 15)) AS rows_before, count_if(k IN (14, 15)) AS removed_duplicate,
       count_if(f4) AS removed_not_positive, count_if(NOT f4 AND f5) AS removed_discount_out_of_range,
       count_if(NOT f4 AND NOT f5 AND k IN (6, 7, 8)) AS removed_missing_key, count_if(k = 3) AS discount_filled,
       count_if(NOT f4 AND NOT f5 AND k NOT IN (6, 7, 8)) AS rows_after
FROM (SELECT *, k IN (0, 1, 2, 11, 15) OR NOT (revenue > 0 AND quantity > 0 AND unit_price > 0) AS f4,
             k IN (4, 5) OR (k <> 3 AND NOT discount BETWEEN 0 AND 1) AS f5
      FROM (SELECT *, (CAST(split_part(order_id, '-', 1) AS BIGINT) * 7 + CAST(split_part(order_id, '-', 2) AS BIGINT)) % 23 AS k
            FROM raw) r) f"""))
def q_clean_audit_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO10 by rule on the dirty landing zone: counts observed while the clean
    stage is written, in one read of the files."""
    from orderlens.sources import files as IO

    clean, counts = IO.clean_raw_csv_audited(spark, _landing(_dirty_rows(spark, sf_dir), sf_dir, "dirty-audit"),
                                             TB.COMPLETED_STATUS_DRIVER)
    S.materialize_frame(clean, "clean-audited")
    found = counts()
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{c} long" for c in found))


def _spoiled(column: str, how: dict) -> Column:
    out = F.col(column)
    for k, text in how.items():
        out = F.when(F.col("k") == k, F.lit(text)).otherwise(out)
    return out
