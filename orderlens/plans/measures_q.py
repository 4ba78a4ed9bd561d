"""Registered measure queries (section 2.11): grand totals, slicer groupings,
filter removal, week-over-week (both definitions), forecast measures and
default column summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import exprs as E
from orderlens.operators import marts as M
from orderlens.operators import measures as ME
from orderlens.plans import ml_queries as MQ
from orderlens.plans import oracle as O
from orderlens.plans import stages as S
from orderlens.plans.catalog import register


def star_frame(spark: SparkSession, sf_dir: str) -> ME.Star:
    return ME.star(S.orders_clean(spark, sf_dir), dim_customers_frame(spark, sf_dir))


def weekly_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.serving(spark, sf_dir, "weekly_kpis")


def dim_customers_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.serving(spark, sf_dir, "dim_customers")


# --- SQL pieces ----------------------------------------------------------------

DIMC_CTE = f"""
dimc AS (
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
  LEFT JOIN rfm r ON r.customer_id = b.customer_id
),
star AS (SELECT cl.*, d.is_repeat_customer FROM cl LEFT JOIN dimc d ON d.customer_id = cl.customer_id)"""


def _star_aggs() -> str:
    return """
         CAST(sum(CASE WHEN is_completed THEN revenue END) AS DOUBLE) AS total_revenue,
         CAST(count_if(is_completed) AS BIGINT) AS total_orders,
         CAST(sum(CASE WHEN is_completed THEN quantity END) AS BIGINT) AS units_sold,
         CAST(sum(CASE WHEN is_completed THEN margin END) AS DOUBLE) AS gross_margin,
         count(DISTINCT CASE WHEN is_completed THEN customer_id END) AS active_customers,
         count(DISTINCT CASE WHEN is_completed AND COALESCE(is_repeat_customer, false) THEN customer_id END)
             AS repeat_customers_model,
         sum(completed_orders) AS _co, sum(visits) AS _v, sum(cart_additions) AS _ca"""


def _safe(num: str, den: str) -> str:
    return f"COALESCE({O.ratio(num, den)}, 0.0)"


def _star_select(keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    return f"""
SELECT {k}total_revenue, total_orders, {_safe('total_revenue', 'total_orders')} AS average_order_value,
       units_sold, gross_margin, {_safe('gross_margin', 'total_revenue')} AS gross_margin_pct,
       active_customers, repeat_customers_model,
       {_safe('repeat_customers_model', 'active_customers')} AS repeat_customer_rate_model,
       {_safe('_co', '_v')} AS conversion_rate, 1.0 - {_safe('_co', '_ca')} AS cart_abandonment_rate"""


def star_sql(keys: str = "", where: str = "") -> str:
    group = f" GROUP BY {keys}" if keys else ""
    w = f" WHERE {where}" if where else ""
    inner = f"SELECT {keys + ', ' if keys else ''}{_star_aggs()} FROM star{w}{group}"
    return _star_select(keys) + f"\nFROM ({inner}) s"


def msql(select: str, extra: str = "") -> str:
    return MQ.ml_sql(select, DIMC_CTE + ("," + extra if extra.strip() else "") + ",\n" + O.WEEKLY_CTE.strip())


# --- queries -------------------------------------------------------------------

@register("measures_total", msql(f"""
SELECT s.*,
       (SELECT CAST(sum(new_customers) AS BIGINT) FROM weekly) AS new_customers,
       (SELECT CAST(count_if(purchase_frequency >= 2) AS BIGINT) FROM dimc) AS repeat_customers,
       {_safe('(SELECT count_if(purchase_frequency >= 2) FROM dimc)', 's.active_customers')} AS repeat_customer_rate,
       (SELECT CAST(count_if(risk_level = 'High') AS BIGINT) FROM cr) AS high_risk_customers,
       (SELECT {_safe("count_if(risk_level = 'High')", 'count(*)')} FROM cr) AS churn_risk_rate_model,
       (SELECT count(DISTINCT CASE WHEN demand_trend = 'Increasing' THEN product_category END) FROM dp)
           AS increasing_demand_categories
FROM ({star_sql()}) s"""))
def q_measures_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ME1-ME12, ME17-ME19 over the whole model (no slicer)."""
    out = ME.evaluate(star_frame(spark, sf_dir), ME.STAR_MEASURES)
    # both churn measures in one aggregate over the churn table (one subquery)
    churn = (ME.evaluate(MQ.naive_churn_risk(spark, sf_dir), ["high_risk_customers", "churn_risk_rate_model"])
             .select(F.struct("*")).scalar())
    return ME.with_plan_repeat(out, dim_customers_frame(spark, sf_dir)).select(
        "*",
        ME.evaluate_scalar(weekly_frame(spark, sf_dir), "new_customers").alias("new_customers"),
        churn.getField("high_risk_customers").alias("high_risk_customers"),
        churn.getField("churn_risk_rate_model").alias("churn_risk_rate_model"),
        ME.evaluate_scalar(MQ.naive_demand_predictions(spark, sf_dir), "increasing_demand_categories")
        .alias("increasing_demand_categories"),
    )


BY_SEGMENT_SQL = f"""
SELECT s.*, COALESCE(d.n, 0) AS repeat_customers, {_safe('COALESCE(d.n, 0)', 's.active_customers')} AS repeat_customer_rate
FROM ({star_sql("customer_segment", "customer_segment IS NOT NULL")}) s
LEFT JOIN (SELECT customer_segment, CAST(count_if(purchase_frequency >= 2) AS BIGINT) AS n FROM dimc GROUP BY 1) d
  ON d.customer_segment = s.customer_segment"""


@register("measures_by_segment", msql(BY_SEGMENT_SQL))
def q_measures_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star measures under a customer-segment slicer, repeat customers in both
    definitions."""
    out = ME.evaluate(star_frame(spark, sf_dir), ME.STAR_MEASURES, by=["customer_segment"],
                      where=F.col("customer_segment").isNotNull())
    return ME.with_plan_repeat(out, dim_customers_frame(spark, sf_dir), ["customer_segment"])


@register("measures_by_year_quarter", msql(star_sql("year, quarter")))
def q_measures_by_year_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star measures under year x quarter slicers."""
    return ME.evaluate(star_frame(spark, sf_dir), ME.STAR_MEASURES, by=["year", "quarter"])


@register("measures_by_risk_level", msql(f"""
SELECT risk_level, CAST(count_if(risk_level = 'High') AS BIGINT) AS high_risk_customers,
       {_safe("count_if(risk_level = 'High')", 'count(*)')} AS churn_risk_rate_model,
       {_safe("count_if(risk_level = 'High')", '(SELECT count(*) FROM cr)')} AS churn_risk_rate
FROM cr WHERE risk_level IS NOT NULL GROUP BY risk_level"""))
def q_measures_by_risk_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ME17 / ME18 under a risk-level slicer.  The plan's churn rate removes
    the risk-level filter from its denominator (AG17); the model's does not."""
    churn = MQ.naive_churn_risk(spark, sf_dir)
    all_rows = churn.agg(F.count(F.lit(1))).scalar()
    out = ME.evaluate(churn, ["high_risk_customers", "churn_risk_rate_model"], by=["risk_level"],
                      where=F.col("risk_level").isNotNull())
    return out.withColumn("churn_risk_rate", E.safe_div("high_risk_customers", all_rows))


@register("wow_calendar", msql("""
SELECT y.year, y.current_week, c.total_revenue AS this_revenue, p.total_revenue AS prev_revenue,
       COALESCE((c.total_revenue - p.total_revenue) / NULLIF(p.total_revenue, 0), 0.0) AS wow_revenue_growth,
       c.total_orders AS this_orders, p.total_orders AS prev_orders,
       COALESCE(CAST(c.total_orders - p.total_orders AS DOUBLE) / CAST(NULLIF(p.total_orders, 0) AS DOUBLE), 0.0)
           AS wow_orders_growth
FROM (SELECT CAST(year(week_start) AS BIGINT) AS year, max(week_start) AS current_week FROM weekly GROUP BY 1) y
JOIN weekly c ON c.week_start = y.current_week
LEFT JOIN weekly p ON p.week_start = CAST(y.current_week - 7 AS DATE)"""))
def q_wow_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN9 (model definition of ME13 / ME14) per year of week_start: the
    latest week against the calendar week 7 days earlier (self lookup);
    a missing or zero previous week gives 0."""
    wk = weekly_frame(spark, sf_dir).select("week_start", "total_revenue", "total_orders")
    cur = (wk.groupBy(F.year("week_start").cast("bigint").alias("year"))
           .agg(F.max("week_start").alias("current_week")))
    this = wk.select(F.col("week_start").alias("current_week"),
                     F.col("total_revenue").alias("this_revenue"),
                     F.col("total_orders").alias("this_orders"))
    prev = wk.select(F.date_add("week_start", 7).alias("current_week"),
                     F.col("total_revenue").alias("prev_revenue"),
                     F.col("total_orders").alias("prev_orders"))
    out = cur.join(this, "current_week", "inner").join(prev, "current_week", "left")
    return out.select(
        "year", "current_week", "this_revenue", "prev_revenue",
        E.safe_div(F.col("this_revenue") - F.col("prev_revenue"), "prev_revenue").alias("wow_revenue_growth"),
        "this_orders", "prev_orders",
        E.safe_div(F.col("this_orders") - F.col("prev_orders"), "prev_orders").alias("wow_orders_growth"),
    )


@register("wow_last_nonblank", msql("""
SELECT arg_max(week_start, CASE WHEN revenue_wow_growth IS NOT NULL THEN week_start END) AS revenue_week,
       arg_max(revenue_wow_growth, CASE WHEN revenue_wow_growth IS NOT NULL THEN week_start END)
           AS wow_revenue_growth,
       arg_max(orders_wow_growth, CASE WHEN orders_wow_growth IS NOT NULL THEN week_start END)
           AS wow_orders_growth
FROM weekly"""))
def q_wow_last_nonblank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG18 (plan definition of ME13 / ME14): value at the last week where it
    is not blank."""
    wk = weekly_frame(spark, sf_dir)
    return wk.agg(
        E.last_by(F.when(F.col("revenue_wow_growth").isNotNull(), F.col("week_start")), "week_start")
        .alias("revenue_week"),
        E.last_by("revenue_wow_growth", "week_start").alias("wow_revenue_growth"),
        E.last_by("orders_wow_growth", "week_start").alias("wow_orders_growth"),
    )


def _xavg(col: str) -> str:
    return O.rnd(f"(fsum(CAST({col} AS DOUBLE)) / count({col}))", 10)


FORECAST_MEASURES = ("predicted_revenue", "predicted_revenue_model", "forecast_error_pct", "forecast_error_pct_model")


def _forecast_sql(source: str) -> str:
    """The forecast measures of a table, from uncut values."""
    parts = {
        "predicted_revenue": O.binary_sum("CASE WHEN is_future THEN predicted_revenue END"),
        "predicted_revenue_model": O.binary_sum("predicted_revenue"),
        "forecast_error_pct":
            f"COALESCE({O.binary_sum('CASE WHEN NOT is_future THEN abs(prediction_error) END')} "
            f"/ NULLIF({O.binary_sum('CASE WHEN NOT is_future THEN actual_revenue END')}, 0), 0.0)",
        "forecast_error_pct_model":
            f"COALESCE(abs({O.binary_sum('prediction_error')}) / NULLIF({O.binary_sum('actual_revenue')}, 0), 0.0)",
    }
    return "SELECT " + ", ".join(f"{O.rnd(sql, 6)} AS {name}" for name, sql in parts.items()) + f" FROM {source}"


def _forecast_measures(forecast: DataFrame) -> DataFrame:
    out = ME.evaluate(forecast, FORECAST_MEASURES)
    return out.select(*[E.rnd(c, 6).alias(c) for c in FORECAST_MEASURES])


@register("forecast_measures", msql(_forecast_sql("sf")))
def q_forecast_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ME15 / ME16 in both definitions (AG16 iterator sum of |error|), 6 dp."""
    return _forecast_measures(MQ.naive_sales_forecast(spark, sf_dir))


@register("forecast_measures_fractional", msql(_forecast_sql(
    "(SELECT is_future, actual_revenue, predicted_revenue / 7.0 AS predicted_revenue, "
    "actual_revenue - predicted_revenue / 7.0 AS prediction_error FROM sf)")))
def q_forecast_measures_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a scorer whose predictions are no whole cents."""
    forecast = MQ.naive_sales_forecast(spark, sf_dir).withColumn(
        "predicted_revenue", F.col("predicted_revenue") / F.lit(7.0))
    return _forecast_measures(forecast.withColumn(
        "prediction_error", F.col("actual_revenue") - F.col("predicted_revenue")))


# AG22: default summarization per fact column (fixed values of the model)
DEFAULT_SUMMARIZATION = {
    "quantity": "sum", "discount": "average", "revenue": "sum", "margin": "sum",
    "visits": "sum", "cart_additions": "sum", "completed_orders": "sum",
    "conversion_rate": "average", "cart_abandonment_rate": "average",
}


@register("default_summaries", msql(f"""
SELECT CAST(sum(quantity) AS BIGINT) AS sum_quantity,
       {_xavg('discount')} AS avg_discount,
       CAST(sum(revenue) AS DOUBLE) AS sum_revenue,
       CAST(sum(margin) AS DOUBLE) AS sum_margin,
       CAST(sum(visits) AS BIGINT) AS sum_visits,
       CAST(sum(cart_additions) AS BIGINT) AS sum_cart_additions,
       CAST(sum(completed_orders) AS BIGINT) AS sum_completed_orders,
       {_xavg('conversion_rate')} AS avg_conversion_rate,
       {_xavg('cart_abandonment_rate')} AS avg_cart_abandonment_rate
FROM cl"""))
def q_default_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG22: each numeric fact column under its default summarization (an
    average of per-row ratios, which is not the ratio of sums), averages at 10 dp."""
    fact = S.orders_clean(spark, sf_dir)
    aggs = []
    for col, how in DEFAULT_SUMMARIZATION.items():
        if how == "sum":
            c = F.sum(col)
            if col in M.MONEY_COLUMNS:
                c = c.cast("double")
            aggs.append(c.alias(f"sum_{col}"))
        else:
            aggs.append(E.rnd(E.exact_avg(col), 10).alias(f"avg_{col}"))
    return fact.agg(*aggs)


def _fmt_sql(x: str, pattern: str) -> str:
    """SQL twin of ``exprs.fmt_measure``."""
    if pattern == "#,0":
        return f"format('{{:,.0f}}', {O.rnd(x, 0)})"
    if pattern.endswith("#,0.00"):
        prefix = pattern[: -len("#,0.00")]
        r = O.rnd(x, 2)
        return (f"(CASE WHEN {x} IS NOT NULL THEN (CASE WHEN {r} < 0 THEN '-' ELSE '' END) || '{prefix}' || "
                f"format('{{:,.2f}}', abs({r})) END)")
    if pattern == "0.00%":
        return f"(CASE WHEN {x} IS NOT NULL THEN printf('%.2f%%', {O.rnd(f'{x} * 100.0', 2)}) END)"
    if pattern == "+0.00%;-0.00%;0.00%":
        r = O.rnd(f"{x} * 100.0", 2)
        return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {r} = 0 THEN '0.00%' "
                f"ELSE printf('%+.2f%%', {r}) END)")
    raise ValueError(pattern)


DISPLAYED = ("total_revenue", "total_orders", "average_order_value", "units_sold", "gross_margin",
             "gross_margin_pct", "active_customers", "repeat_customers", "repeat_customer_rate",
             "conversion_rate", "cart_abandonment_rate")
WOW = ("wow_revenue_growth", "wow_orders_growth")

_WOW_SQL = """
SELECT COALESCE((c.total_revenue - p.total_revenue) / NULLIF(p.total_revenue, 0), 0.0) AS wow_revenue_growth,
       COALESCE(CAST(c.total_orders - p.total_orders AS DOUBLE) / CAST(NULLIF(p.total_orders, 0) AS DOUBLE), 0.0)
           AS wow_orders_growth
FROM weekly c LEFT JOIN weekly p ON p.week_start = CAST(c.week_start - 7 AS DATE)
WHERE c.week_start = (SELECT max(week_start) FROM weekly)"""


@register("measures_display", msql(f"""
SELECT context, measure, display FROM (
  SELECT customer_segment AS context,
         {', '.join(f'{_fmt_sql(n, ME.MEASURE_FORMATS[n])} AS {n}' for n in DISPLAYED)}
  FROM ({BY_SEGMENT_SQL}) m
) UNPIVOT INCLUDE NULLS (display FOR measure IN ({', '.join(DISPLAYED)}))
UNION ALL
SELECT context, measure, display FROM (
  SELECT 'latest_week' AS context, {', '.join(f"{_fmt_sql(n, ME.MEASURE_FORMATS[n])} AS {n}" for n in WOW)}
  FROM ({_WOW_SQL}) w
) UNPIVOT INCLUDE NULLS (display FOR measure IN ({', '.join(WOW)}))"""))
def q_measures_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC9: measures in the model's display formats, long form (context,
    measure, display): star measures per segment, and the calendar
    week-over-week measures of the latest week (signed format)."""
    by_seg = q_measures_by_segment(spark, sf_dir)
    seg = ME.display(by_seg, DISPLAYED).select(
        F.col("customer_segment").alias("context"), *[F.col(f"{n}_display").alias(n) for n in DISPLAYED])
    latest = (q_wow_calendar(spark, sf_dir)
              .agg(F.max_by(F.struct(*WOW), "current_week").alias("w")).select("w.*"))
    wow = ME.display(latest, WOW).select(
        F.lit("latest_week").alias("context"), *[F.col(f"{n}_display").alias(n) for n in WOW])
    return (seg.unpivot(["context"], list(DISPLAYED), "measure", "display")
            .unionByName(wow.unpivot(["context"], list(WOW), "measure", "display")))
