"""The model's tables, relations and measures, and the queries that slice
measures of several tables at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import exprs as E
from orderlens.operators import semantic as SM
from orderlens.plans import measures_q as Q
from orderlens.plans import ml_queries as MQ
from orderlens.plans import oracle as O
from orderlens.plans import stages as S
from orderlens.plans.catalog import register

RELATIONS = (
    SM.Relation("fact_orders", "customer_id", "dim_customers", "customer_id"),
    SM.Relation("fact_orders", "product_id", "dim_products", "product_id"),
    SM.Relation("fact_orders", "order_date", "dim_date", "date", prune=("year", lambda c: F.year(c).cast("bigint"))),
    SM.Relation("churn", "customer_id", "dim_customers", "customer_id"),
)


def _done():
    return F.col("is_completed")


def _sum_done(column: str, cast: str | None = None) -> SM.Leaf:
    def final(n):
        return F.sum(n).cast(cast) if cast else F.sum(n)
    return SM.Leaf("fact_orders", lambda: F.sum(F.when(_done(), F.col(column))), final)


def _sum_all(column: str) -> SM.Leaf:
    return SM.Leaf("fact_orders", lambda: F.sum(column), F.sum)


def _count(table: str, holds) -> SM.Leaf:
    return SM.Leaf(table, lambda: F.count_if(holds()), F.sum, zero=True)


def _buyers(related: str | None = None) -> SM.Leaf:
    def final(n):
        flag = F.col(n)
        return F.count_if(flag & F.coalesce(F.col(SM.column_of(related)), F.lit(False)) if related else flag)
    return SM.Leaf("fact_orders", lambda: F.max(F.when(_done() & F.col("customer_id").isNotNull(), F.lit(True))), final,
                   again=F.max, distinct="customer_id", related=related, zero=True)


LEAVES = {
    "total_revenue": _sum_done("revenue", "double"),
    "total_orders": _count("fact_orders", _done),
    "units_sold": _sum_done("quantity"),
    "gross_margin": _sum_done("margin", "double"),
    "active_customers": _buyers(),
    "repeat_customers_model": _buyers("dim_customers.is_repeat_customer"),
    "_completed_orders": _sum_all("completed_orders"),
    "_visits": _sum_all("visits"),
    "_cart_additions": _sum_all("cart_additions"),
    "new_customers": SM.Leaf("weekly", lambda: F.sum("new_customers"), F.sum),
    "repeat_customers": _count("dim_customers", lambda: F.col("purchase_frequency") >= 2),
    "high_risk_customers": _count("churn", lambda: F.col("risk_level") == "High"),
    "churn_customers": _count("churn", lambda: F.lit(True)),
    "increasing_demand_categories": SM.Leaf(
        "demand", lambda: F.max(F.when((F.col("demand_trend") == "Increasing") & F.col("product_category").isNotNull(),
                                       F.lit(True))),
        F.count_if, again=F.max, distinct="product_category", zero=True),
}

MEASURES = {
    "average_order_value": SM.Ratio("total_revenue", "total_orders"),
    "gross_margin_pct": SM.Ratio("gross_margin", "total_revenue"),
    "repeat_customer_rate_model": SM.Ratio("repeat_customers_model", "active_customers"),
    "repeat_customer_rate": SM.Ratio("repeat_customers", "active_customers"),
    "conversion_rate": SM.Ratio("_completed_orders", "_visits"),
    "cart_abandonment_rate": SM.Minus(1.0, SM.Ratio("_completed_orders", "_cart_additions")),
    "churn_risk_rate_model": SM.Ratio("high_risk_customers", "churn_customers"),
    # the plan's form: the risk-level slicer is removed below the line
    "churn_risk_rate": SM.Ratio("high_risk_customers", SM.Calc("churn_customers", remove=("churn.risk_level",))),
    # share of the category's revenue in the revenue of all categories
    "revenue_share_of_all_products": SM.Ratio("total_revenue", SM.Calc("total_revenue", remove=("dim_products",))),
}

FACT_MEASURES = ("total_revenue", "total_orders", "average_order_value", "units_sold", "gross_margin", "gross_margin_pct",
                 "active_customers", "repeat_customers_model", "repeat_customer_rate_model", "conversion_rate",
                 "cart_abandonment_rate")


MODEL_TABLES = ("weekly_kpis", "dim_customers", "dim_products", "dim_date", "churn_features", "demand_features")


def model(spark: SparkSession, sf_dir: str) -> SM.Model:
    """The model over the serving tables (stand-in scorers for predictions),
    which are written side by side."""
    S.build_serving(spark, sf_dir, MODEL_TABLES)
    return SM.Model({
        "fact_orders": S.orders_clean(spark, sf_dir), "dim_customers": Q.dim_customers_frame(spark, sf_dir),
        "dim_products": S.serving(spark, sf_dir, "dim_products"), "dim_date": S.serving(spark, sf_dir, "dim_date"),
        "churn": MQ.naive_churn_risk(spark, sf_dir), "weekly": Q.weekly_frame(spark, sf_dir),
        "demand": MQ.naive_demand_predictions(spark, sf_dir)}, RELATIONS, LEAVES, MEASURES, S.store_cells)


STAR2 = f"""
prod AS (SELECT product_id, {O.first_by('product_category')} AS product_category FROM cl GROUP BY product_id),
star2 AS (SELECT cl.* EXCLUDE (customer_segment, city, product_category), d.is_repeat_customer, d.customer_segment, d.city,
    p.product_category, CAST(year(order_date) AS BIGINT) AS date_year
  FROM cl LEFT JOIN dimc d ON d.customer_id = cl.customer_id LEFT JOIN prod p ON p.product_id = cl.product_id)"""


def _fact_sql(keys: str, where: str = "true") -> str:
    return f"{Q._star_select(keys)}\nFROM (SELECT {keys}, {Q._star_aggs()} FROM star2 WHERE {where} GROUP BY {keys}) s"


def _sql(select: str) -> str:
    return Q.msql(select, STAR2)


@register("measures_by_product", _sql(_fact_sql("product_category")))
def q_measures_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact measures by the category of dim_products (JN7: fact to product)."""
    return SM.evaluate(model(spark, sf_dir), FACT_MEASURES, ["dim_products.product_category"])


@register("measures_by_month", _sql(_fact_sql("year, month")))
def q_measures_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact measures by year and month of dim_date (JN7: order date to date)."""
    return SM.evaluate(model(spark, sf_dir), FACT_MEASURES, ["dim_date.year", "dim_date.month"])


SLICED_YEARS, SLICED_QUARTERS = (1994, 1995), (1, 2)


@register("measures_by_city_sliced", _sql(_fact_sql(
    "city, sales_channel", f"date_year IN {SLICED_YEARS} AND quarter IN {SLICED_QUARTERS}")))
def q_measures_by_city_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact measures by the customer's city and the order's channel under year
    and quarter slicers of dim_date, which prune the fact's partitions."""
    return SM.evaluate(model(spark, sf_dir), FACT_MEASURES, ["dim_customers.city", "fact_orders.sales_channel"],
                       [SM.one_of("dim_date.year", *SLICED_YEARS), SM.one_of("dim_date.quarter", *SLICED_QUARTERS)])


@register("churn_by_city", _sql(f"""
SELECT city, CAST(count_if(risk_level = 'High') AS BIGINT) AS high_risk_customers,
       {Q._safe("count_if(risk_level = 'High')", 'count(*)')} AS churn_risk_rate_model
FROM cr LEFT JOIN dimc USING (customer_id) GROUP BY city"""))
def q_churn_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Churn measures by the customer's city (JN7: churn to customer)."""
    return SM.evaluate(model(spark, sf_dir), ["high_risk_customers", "churn_risk_rate_model"], ["dim_customers.city"])


@register("churn_rate_by_segment_risk", _sql(f"""
SELECT c.customer_segment, c.risk_level, c.n AS high_risk_customers, {Q._safe('c.n', 'c.rows')} AS churn_risk_rate_model,
       {Q._safe('c.n', 'sum(c.rows) OVER (PARTITION BY c.customer_segment)')} AS churn_risk_rate
FROM (SELECT d.customer_segment, risk_level, CAST(count_if(risk_level = 'High') AS BIGINT) AS n, count(*) AS rows
      FROM cr LEFT JOIN dimc d USING (customer_id) GROUP BY d.customer_segment, risk_level) c"""))
def q_churn_rate_by_segment_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ME18 in both forms by segment and risk level: the plan's denominator
    keeps the segment and removes the risk level (AG17)."""
    return SM.evaluate(model(spark, sf_dir), ["high_risk_customers", "churn_risk_rate_model", "churn_risk_rate"],
                       ["dim_customers.customer_segment", "churn.risk_level"])


_OTHERS = """(SELECT CAST(sum(new_customers) AS BIGINT) FROM weekly) AS new_customers,
  (SELECT count(DISTINCT CASE WHEN demand_trend = 'Increasing' THEN product_category END) FROM dp) AS increasing_demand_categories"""
SYNCED = ("total_revenue", "active_customers", "new_customers", "repeat_customers", "repeat_customer_rate",
          "high_risk_customers", "churn_risk_rate_model", "increasing_demand_categories")


@register("measures_synced_by_segment", _sql(f"""
SELECT s.customer_segment, f.total_revenue, COALESCE(f.active_customers, 0) AS active_customers, {_OTHERS},
  COALESCE(d.n, 0) AS repeat_customers, {Q._safe('COALESCE(d.n, 0)', 'f.active_customers')} AS repeat_customer_rate,
  COALESCE(c.n, 0) AS high_risk_customers, {Q._safe('COALESCE(c.n, 0)', 'c.rows')} AS churn_risk_rate_model
FROM (SELECT DISTINCT customer_segment FROM dimc) s
LEFT JOIN (SELECT customer_segment, {Q._star_aggs()} FROM star2 GROUP BY 1) f
  ON f.customer_segment IS NOT DISTINCT FROM s.customer_segment
LEFT JOIN (SELECT customer_segment, CAST(count_if(purchase_frequency >= 2) AS BIGINT) AS n FROM dimc GROUP BY 1) d
  ON d.customer_segment IS NOT DISTINCT FROM s.customer_segment
LEFT JOIN (SELECT d.customer_segment, CAST(count_if(risk_level = 'High') AS BIGINT) AS n, count(*) AS rows
           FROM cr LEFT JOIN dimc d USING (customer_id) GROUP BY 1) c
  ON c.customer_segment IS NOT DISTINCT FROM s.customer_segment"""))
def q_measures_synced_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of five tables under one segment slicer: it divides the fact,
    the customers and the churn table, and leaves the others whole."""
    return SM.evaluate(model(spark, sf_dir), SYNCED, ["dim_customers.customer_segment"])


@register("measures_synced_by_category", _sql(f"""
SELECT f.product_category, f.total_revenue, f.active_customers, {_OTHERS},
  d.n AS repeat_customers, {Q._safe('d.n', 'f.active_customers')} AS repeat_customer_rate,
  c.n AS high_risk_customers, {Q._safe('c.n', 'c.rows')} AS churn_risk_rate_model,
  {Q._safe('f.total_revenue', '(SELECT CAST(sum(CASE WHEN is_completed THEN revenue END) AS DOUBLE) FROM cl)')}
    AS revenue_share_of_all_products
FROM (SELECT product_category, {Q._star_aggs()} FROM star2 GROUP BY 1) f,
  (SELECT CAST(count_if(purchase_frequency >= 2) AS BIGINT) AS n FROM dimc) d,
  (SELECT CAST(count_if(risk_level = 'High') AS BIGINT) AS n, count(*) AS rows FROM cr) c"""))
def q_measures_synced_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under a product slicer, which reaches the fact alone, and the
    share of all products (ALL)."""
    return SM.evaluate(model(spark, sf_dir), [*SYNCED, "revenue_share_of_all_products"], ["dim_products.product_category"])


def wow_by(m: SM.Model, by: list[str], where: tuple[SM.Filter, ...] = ()) -> DataFrame:
    """ME13 / ME14 (calendar form) in any slicer context: the last week with
    completed orders against the week 7 days before it."""
    out = SM.shifted(m, ["total_revenue", "total_orders"], "fact_orders.week_start", -7, by, where, last_by="total_orders")
    names = [r.split(".")[1] for r in by]
    growth = lambda n: E.safe_div(F.col(n) - F.col(f"prev_{n}"), f"prev_{n}")
    return out.select(*names, F.col("week_start").alias("current_week"), F.col("total_revenue").alias("this_revenue"),
                      F.col("prev_total_revenue").alias("prev_revenue"), growth("total_revenue").alias("wow_revenue_growth"),
                      F.col("total_orders").alias("this_orders"), F.col("prev_total_orders").alias("prev_orders"),
                      growth("total_orders").alias("wow_orders_growth"))


def _wow_sql(key: str) -> str:
    return Q.msql(f"""
SELECT c.{key}, c.week_start AS current_week, c.r AS this_revenue, p.r AS prev_revenue,
       COALESCE((c.r - p.r) / NULLIF(p.r, 0), 0.0) AS wow_revenue_growth, c.n AS this_orders, p.n AS prev_orders,
       COALESCE(CAST(c.n - p.n AS DOUBLE) / CAST(NULLIF(p.n, 0) AS DOUBLE), 0.0) AS wow_orders_growth
FROM (SELECT *, max(CASE WHEN n > 0 THEN week_start END) OVER (PARTITION BY {key}) AS latest FROM wk) c
LEFT JOIN wk p ON p.{key} IS NOT DISTINCT FROM c.{key} AND p.week_start = CAST(c.week_start - 7 AS DATE)
WHERE c.week_start = c.latest""", STAR2 + f""",
wk AS (SELECT {key}, week_start, CAST(sum(CASE WHEN is_completed THEN revenue END) AS DOUBLE) AS r,
         CAST(count_if(is_completed) AS BIGINT) AS n FROM star2 GROUP BY {key}, week_start)""")


@register("wow_by_channel", _wow_sql("sales_channel"))
def q_wow_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ME13 / ME14 by sales channel (WN9 under a slicer)."""
    return wow_by(model(spark, sf_dir), ["fact_orders.sales_channel"])


@register("wow_by_segment", _wow_sql("customer_segment"))
def q_wow_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ME13 / ME14 by the customer's segment."""
    return wow_by(model(spark, sf_dir), ["dim_customers.customer_segment"])


@register("wow_last_nonblank_by_channel", _sql(f"""
SELECT sales_channel, max(CASE WHEN g IS NOT NULL THEN week_start END) AS revenue_week,
       arg_max(g, CASE WHEN g IS NOT NULL THEN week_start END) AS wow_revenue_growth,
       arg_max(h, CASE WHEN h IS NOT NULL THEN week_start END) AS wow_orders_growth
FROM (SELECT c.sales_channel, c.week_start, {O.rnd(O.ratio('c.r', 'p.r') + ' - 1.0', 4)} AS g,
        {O.rnd(O.ratio('c.n', 'p.n') + ' - 1.0', 4)} AS h
      FROM (SELECT sales_channel, week_start, CAST(sum(CASE WHEN is_completed THEN revenue END) AS DOUBLE) AS r,
              count_if(is_completed) AS n FROM star2 GROUP BY 1, 2) c
      LEFT JOIN (SELECT sales_channel, week_start, CAST(sum(CASE WHEN is_completed THEN revenue END) AS DOUBLE) AS r,
              count_if(is_completed) AS n FROM star2 GROUP BY 1, 2) p
        ON p.sales_channel IS NOT DISTINCT FROM c.sales_channel AND p.week_start = CAST(c.week_start - 7 AS DATE))
GROUP BY sales_channel"""))
def q_wow_last_nonblank_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG18 under a slicer: growth over the week before, at the last week where
    it is not blank, by channel."""
    weeks = SM.shifted(model(spark, sf_dir), ["total_revenue", "total_orders"], "fact_orders.week_start", -7,
                       ["fact_orders.sales_channel"])
    weeks = weeks.select("sales_channel", "week_start", E.pct_change("total_revenue", "prev_total_revenue").alias("g"),
                         E.pct_change("total_orders", "prev_total_orders").alias("h"))
    return weeks.groupBy("sales_channel").agg(
        F.max(F.when(F.col("g").isNotNull(), F.col("week_start"))).alias("revenue_week"),
        F.max_by("g", F.when(F.col("g").isNotNull(), F.col("week_start"))).alias("wow_revenue_growth"),
        F.max_by("h", F.when(F.col("h").isNotNull(), F.col("week_start"))).alias("wow_orders_growth"))
