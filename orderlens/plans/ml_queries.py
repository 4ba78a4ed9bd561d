"""Registered ML feature-frame queries and the prediction tables fed by the
deterministic stand-in scorers (all SQL-checked)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.plans import ml_features as MF
from orderlens.plans import oracle as O
from orderlens.plans import stages as S
from orderlens.plans.catalog import register

NAIVE_FORECAST_NAME = "NaiveLag1"


def _lag(col: str, k: int, part: str = "") -> str:
    over = f"OVER ({'PARTITION BY ' + part + ' ' if part else ''}ORDER BY week_start)"
    return f"lag({col}, {k}) {over}"


def _prev_mean_sql(col: str, part: str = "") -> str:
    terms = " + ".join(f"CAST({_lag(col, k, part)} AS DOUBLE)" for k in (4, 3, 2, 1))
    return f"(({terms}) / 4.0)"


ML_CTES = f"""
wf0 AS (
  SELECT week_start, CAST(sum(revenue) AS DOUBLE) AS revenue, count(order_id) AS orders,
         CAST(sum(quantity) AS BIGINT) AS units,
         CAST(sum(discount) AS DOUBLE) / count(discount) AS avg_disc,
         count(DISTINCT customer_id) AS n_customers
  FROM comp GROUP BY week_start
),
wf1 AS (
  SELECT *, CAST(week(week_start) AS BIGINT) AS week_num, CAST(month(week_start) AS BIGINT) AS month,
         CAST(quarter(week_start) AS BIGINT) AS quarter,
         CAST(row_number() OVER (ORDER BY week_start) - 1 AS BIGINT) AS t,
         {_lag('revenue', 1)} AS revenue_lag1, {_lag('orders', 1)} AS orders_lag1,
         {_lag('revenue', 2)} AS revenue_lag2, {_lag('orders', 2)} AS orders_lag2,
         {_lag('revenue', 4)} AS revenue_lag4, {_lag('orders', 4)} AS orders_lag4,
         {_prev_mean_sql('revenue')} AS revenue_roll4
  FROM wf0
),
wf AS (
  SELECT *, row_number() OVER (ORDER BY week_start DESC) <= 8 AS is_test
  FROM wf1
  WHERE revenue_lag1 IS NOT NULL AND revenue_lag2 IS NOT NULL AND revenue_lag4 IS NOT NULL
    AND orders_lag1 IS NOT NULL AND orders_lag2 IS NOT NULL AND orders_lag4 IS NOT NULL
    AND revenue_roll4 IS NOT NULL AND avg_disc IS NOT NULL
),
wtail AS (SELECT *, row_number() OVER (ORDER BY t DESC) AS rn FROM wf),
wlast AS (SELECT * FROM wtail WHERE rn = 1),
wagg AS (
  SELECT max(CASE WHEN rn = 1 THEN revenue END) AS r1, max(CASE WHEN rn = 2 THEN revenue END) AS r2,
         max(CASE WHEN rn = 3 THEN revenue END) AS r3, max(CASE WHEN rn = 4 THEN revenue END) AS r4,
         count(*) FILTER (WHERE rn <= 4) AS n
  FROM wtail
),
fut AS (
  SELECT CAST(l.week_start + CAST(7 * h.h AS INTEGER) AS DATE) AS week_start,
         CAST(week(CAST(l.week_start + CAST(7 * h.h AS INTEGER) AS DATE)) AS BIGINT) AS week_num,
         CAST(month(CAST(l.week_start + CAST(7 * h.h AS INTEGER) AS DATE)) AS BIGINT) AS month,
         CAST(quarter(CAST(l.week_start + CAST(7 * h.h AS INTEGER) AS DATE)) AS BIGINT) AS quarter,
         CAST(l.t + h.h AS BIGINT) AS t,
         l.revenue AS revenue_lag1, COALESCE(a.r2, l.revenue) AS revenue_lag2,
         COALESCE(a.r4, l.revenue) AS revenue_lag4,
         l.orders_lag1, l.orders_lag2, l.orders_lag4,
         (COALESCE(a.r4, 0.0) + COALESCE(a.r3, 0.0) + COALESCE(a.r2, 0.0) + a.r1) / CAST(a.n AS DOUBLE)
             AS revenue_roll4,
         l.avg_disc, l.n_customers, CAST(h.h AS BIGINT) AS horizon
  FROM wlast l, wagg a, (SELECT unnest(generate_series(1, {MF.FORECAST_HORIZON})) AS h) h
),
cf0 AS (
  SELECT s.customer_id, s.customer_segment, r.days_since_last_purchase, r.purchase_frequency,
         r.total_revenue, r.avg_order_value, r.is_churned
  FROM (SELECT customer_id, {O.first_by('customer_segment')} AS customer_segment
        FROM comp GROUP BY customer_id) s
  JOIN rfm r ON r.customer_id = s.customer_id
  WHERE r.is_churned IS NOT NULL
),
cf AS (SELECT *, CAST(dense_rank() OVER (ORDER BY customer_segment) - 1 AS BIGINT) AS segment_enc FROM cf0),
dw0 AS (
  SELECT product_category, week_start, CAST(sum(quantity) AS BIGINT) AS units,
         CAST(sum(revenue) AS DOUBLE) AS revenue
  FROM comp WHERE product_category IS NOT NULL GROUP BY product_category, week_start
),
dw1 AS (
  SELECT *, CAST(week(week_start) AS BIGINT) AS week_num, CAST(month(week_start) AS BIGINT) AS month,
         CAST(row_number() OVER (PARTITION BY product_category ORDER BY week_start) - 1 AS BIGINT) AS t,
         {_lag('units', 1, 'product_category')} AS units_lag1,
         {_lag('units', 2, 'product_category')} AS units_lag2,
         {_lag('units', 4, 'product_category')} AS units_lag4,
         {_prev_mean_sql('units', 'product_category')} AS units_roll4,
         CAST(dense_rank() OVER (ORDER BY product_category) - 1 AS BIGINT) AS cat_enc
  FROM dw0
),
dw AS (SELECT * FROM dw1 WHERE units_lag1 IS NOT NULL AND units_lag2 IS NOT NULL
                          AND units_lag4 IS NOT NULL AND units_roll4 IS NOT NULL),
dt0 AS (
  SELECT product_category,
         avg(units) FILTER (WHERE rn <= 4) AS recent,
         CASE WHEN count(*) >= 8 THEN avg(units) FILTER (WHERE rn BETWEEN 5 AND 8) ELSE avg(units) END AS prior
  FROM (SELECT product_category, units,
               row_number() OVER (PARTITION BY product_category ORDER BY week_start DESC) AS rn FROM dw) x
  GROUP BY product_category
),
dt AS (
  SELECT product_category, recent, prior, {O.ratio('recent', 'prior')} AS ratio,
         CASE WHEN {O.ratio('recent', 'prior')} > 1.05 THEN 'Increasing'
              WHEN {O.ratio('recent', 'prior')} < 0.95 THEN 'Decreasing' ELSE 'Stable' END AS demand_trend
  FROM dt0
),
sf AS (
  SELECT week_start, revenue AS actual_revenue, greatest(revenue_lag1, 0.0) AS predicted_revenue,
         {O.rnd('revenue - greatest(revenue_lag1, 0.0)', 2)} AS prediction_error,
         '{NAIVE_FORECAST_NAME}' AS model_name, false AS is_future
  FROM wf
  UNION ALL
  SELECT week_start, CAST(NULL AS DOUBLE), {O.rnd('greatest(revenue_lag1, 0.0)', 2)}, CAST(NULL AS DOUBLE),
         '{NAIVE_FORECAST_NAME}', true
  FROM fut
),
cr AS (
  SELECT customer_id, customer_segment, days_since_last_purchase,
         {O.rnd('total_revenue', 2)} AS total_revenue, purchase_frequency,
         {O.rnd('avg_order_value', 2)} AS avg_order_value,
         p AS churn_risk_probability,
         CASE WHEN p > -0.01 AND p <= 0.33 THEN 'Low' WHEN p > 0.33 AND p <= 0.66 THEN 'Medium'
              WHEN p > 0.66 AND p <= 1.01 THEN 'High' END AS risk_level
  FROM (SELECT *, {O.rnd('least(CAST(days_since_last_purchase AS DOUBLE) / 180.0, 1.0)', 4)} AS p FROM cf) x
),
dp AS (
  SELECT d.product_category, d.week_start AS week, d.units AS actual_units_sold, t.demand_trend,
         CAST({O.rnd('greatest(CAST(d.units_lag1 AS DOUBLE), 0.0)', 0)} AS BIGINT) AS predicted_units_sold
  FROM dw d LEFT JOIN dt t ON t.product_category = d.product_category
)"""


def ml_sql(select: str, extra: str = "") -> str:
    ctes = ML_CTES.strip()
    if extra.strip():
        ctes += ",\n" + extra.strip()
    return O.with_base(select, ctes)


# ---------------------------------------------------------------------------
# Frames shared with the dashboard / measures / model modules
# ---------------------------------------------------------------------------

def weekly_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.serving(spark, sf_dir, "forecast_features")


def churn_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.serving(spark, sf_dir, "churn_features")


def demand_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.serving(spark, sf_dir, "demand_features")


def naive_sales_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MF.sales_forecast(weekly_frame(spark, sf_dir), MF.naive_forecast, NAIVE_FORECAST_NAME)


def naive_churn_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MF.churn_risk(churn_frame(spark, sf_dir), MF.naive_churn)


def naive_demand_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MF.demand_predictions(demand_frame(spark, sf_dir), MF.naive_demand)


# ---------------------------------------------------------------------------
# Registered queries
# ---------------------------------------------------------------------------

WEEKLY_FEATURE_COLUMNS = ("week_start", "revenue", "orders", "units", "avg_disc", "n_customers",
                          *[c for c in MF.FORECAST_FEATURES if c not in ("avg_disc", "n_customers")],
                          "is_test")


@register("forecast_features", ml_sql(f"SELECT {', '.join(WEEKLY_FEATURE_COLUMNS)} FROM wf"))
def q_forecast_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML1 + ML4: weekly forecast features with the temporal hold-out flag."""
    return MF.weekly_features(S.orders_clean(spark, sf_dir)).select(*WEEKLY_FEATURE_COLUMNS)


FUTURE_COLUMNS = ("week_start", *MF.FORECAST_FEATURES, "horizon")


@register("forecast_future_features", ml_sql(f"SELECT {', '.join(FUTURE_COLUMNS)} FROM fut"))
def q_forecast_future_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML15: the 4 future feature rows."""
    return MF.future_weekly_features(weekly_frame(spark, sf_dir)).select(*FUTURE_COLUMNS)


CHURN_COLUMNS = ("customer_id", "customer_segment", "days_since_last_purchase", "purchase_frequency",
                 "total_revenue", "avg_order_value", "is_churned", "segment_enc")


@register("churn_features", ml_sql(f"SELECT {', '.join(CHURN_COLUMNS)} FROM cf"))
def q_churn_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML2."""
    return MF.churn_features(S.orders_clean(spark, sf_dir), S.customers(spark, sf_dir)).select(*CHURN_COLUMNS)


DEMAND_COLUMNS = ("product_category", "week_start", "units", "revenue", *MF.DEMAND_FEATURES)


@register("demand_features", ml_sql(f"SELECT {', '.join(DEMAND_COLUMNS)} FROM dw"))
def q_demand_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML3."""
    return MF.demand_features(S.orders_clean(spark, sf_dir)).select(*DEMAND_COLUMNS)


@register("demand_trend", ml_sql("SELECT product_category, recent, prior, ratio, demand_trend FROM dt"))
def q_demand_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN10 / WN11 / SC4: trend label per category."""
    return MF.demand_trend(demand_frame(spark, sf_dir))


@register("sales_forecast_naive", ml_sql("SELECT * FROM sf"))
def q_sales_forecast_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML14 / ML15 / SO1 with the previous-week scorer."""
    return naive_sales_forecast(spark, sf_dir)


@register("customer_churn_risk_naive", ml_sql("SELECT * FROM cr"))
def q_customer_churn_risk_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML16 / SC3 with the inactivity scorer."""
    return naive_churn_risk(spark, sf_dir)


@register("demand_predictions_naive", ml_sql("SELECT * FROM dp"))
def q_demand_predictions_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML17 / JN6 / SC2 / MA3 with the previous-week scorer."""
    return naive_demand_predictions(spark, sf_dir)
