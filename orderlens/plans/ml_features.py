"""Model feature frames (ML1-ML4, ML15) and the prediction tables built on
top of any scorer (ML14, ML16, ML17).

The feature frames are aggregates of the clean fact (one row per week,
customer, or category-week), so the windows below - including the
un-partitioned ones over the weekly frame - run on data whose size is
bounded by the calendar / dimension cardinality, never by order lines.

A *scorer* is a function ``DataFrame -> DataFrame`` that appends a DOUBLE
column ``prediction`` (and, for classifiers, ``probability_1``).  The
learned scorers come from ``plans.models``; ``naive_*`` scorers are the
deterministic stand-ins used by the SQL-checked queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.constants import (CHURN_FEATURES, CLASS_THRESHOLD, DEMAND_FEATURES, FORECAST_FEATURES,
                                 FORECAST_HORIZON, LAGS, RISK_BIN_EDGES,
                                 RISK_LEVELS, TEST_WEEKS, TREND_DOWN, TREND_LABELS, TREND_UP)
from orderlens.functions import exprs as E
from orderlens.operators import features as FT
from orderlens.plans.stages import materialize_frame

Scorer = Callable[[DataFrame], DataFrame]


def _prev_mean(col: str, w: Window, n: int = 4):
    """Mean of the previous ``n`` rows, NULL unless all ``n`` exist.  Summed
    oldest-first in a fixed order so the double result is reproducible."""
    total = F.lag(col, n).over(w).cast("double")
    for k in range(n - 1, 0, -1):
        total = total + F.lag(col, k).over(w).cast("double")
    return total / F.lit(float(n))


def weekly_features(clean: DataFrame) -> DataFrame:
    """ML1 (+ ML4 flag): weekly revenue / orders / units / mean discount /
    distinct customers, calendar parts, time index, lags 1/2/4 of revenue and
    orders, mean of the previous 4 weeks' revenue; rows with any missing
    feature dropped; the last ``TEST_WEEKS`` rows flagged ``is_test``."""
    wk = (clean.filter(F.col("is_completed"))
          .groupBy("week_start")
          .agg(F.sum("revenue").cast("double").alias("revenue"),
               F.count("order_id").alias("orders"),
               F.sum("quantity").alias("units"),
               (F.sum("discount").cast("double") / F.count("discount")).alias("avg_disc"),
               F.count_distinct("customer_id").alias("n_customers")))
    w = Window.orderBy("week_start")
    cols = {
        "week_num": F.weekofyear("week_start").cast("bigint"),
        "month": F.month("week_start").cast("bigint"),
        "quarter": F.quarter("week_start").cast("bigint"),
        "t": (F.row_number().over(w) - 1).cast("bigint"),
    }
    for k in LAGS:
        cols[f"revenue_lag{k}"] = F.lag("revenue", k).over(w)
        cols[f"orders_lag{k}"] = F.lag("orders", k).over(w)
    cols["revenue_roll4"] = _prev_mean("revenue", w)
    wk = wk.withColumns(cols).na.drop("any")
    test = F.row_number().over(Window.orderBy(F.desc("week_start"))) <= TEST_WEEKS
    return wk.withColumn("is_test", test)


def future_weekly_features(weekly: DataFrame, horizon: int = FORECAST_HORIZON) -> DataFrame:
    """ML15: ``horizon`` rows after the last week.  Calendar parts and ``t``
    move with the week; revenue lags are frozen at the last actuals
    (lag2 / lag4 fall back to the last row when the history is shorter); the
    other features are copied from the last row."""
    by_t_desc = Window.orderBy(F.desc("t"))
    last_k = {k: F.max(F.when(F.col("_rn") == k, F.col("revenue"))) for k in range(1, 5)}
    tail = (weekly.withColumn("_rn", F.row_number().over(by_t_desc))
            .filter(F.col("_rn") <= 4)
            .agg(F.max_by(F.struct(*[F.col(c) for c in weekly.columns]), F.col("t")).alias("last"),
                 *[v.alias(f"_rev{k}") for k, v in last_k.items()],
                 F.count(F.lit(1)).alias("_n")))
    # mean of the last (up to) 4 revenues, summed oldest-first
    roll = (F.coalesce(F.col("_rev4"), F.lit(0.0)) + F.coalesce(F.col("_rev3"), F.lit(0.0))
            + F.coalesce(F.col("_rev2"), F.lit(0.0)) + F.col("_rev1")) / F.col("_n").cast("double")
    tail = tail.withColumn("_roll", roll)
    rows = tail.select("last", "_rev2", "_rev4", "_roll",
                       F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    ws = F.date_add(F.col("last.week_start"), F.col("h") * 7)
    return rows.select(
        ws.alias("week_start"),
        F.weekofyear(ws).cast("bigint").alias("week_num"),
        F.month(ws).cast("bigint").alias("month"),
        F.quarter(ws).cast("bigint").alias("quarter"),
        (F.col("last.t") + F.col("h")).cast("bigint").alias("t"),
        F.col("last.revenue").alias("revenue_lag1"),
        F.coalesce("_rev2", "last.revenue").alias("revenue_lag2"),
        F.coalesce("_rev4", "last.revenue").alias("revenue_lag4"),
        F.col("last.orders_lag1").alias("orders_lag1"),
        F.col("last.orders_lag2").alias("orders_lag2"),
        F.col("last.orders_lag4").alias("orders_lag4"),
        F.col("_roll").alias("revenue_roll4"),
        F.col("last.avg_disc").alias("avg_disc"),
        F.col("last.n_customers").alias("n_customers"),
        F.col("h").cast("bigint").alias("horizon"),
    )


def label_encode(df: DataFrame, col: str, out: str) -> DataFrame:
    """SC5: 0-based alphabetical code of ``col`` over its distinct values.

    The frame is written once: the dictionary (a row per label, small enough for
    the planner to broadcast by its measured size) and the coded rows both read
    it back instead of building it twice."""
    df = materialize_frame(df, f"coded-{col}")
    codes = (df.select(col).distinct()
             .withColumn(out, (F.dense_rank().over(Window.orderBy(col)) - 1).cast("bigint")))
    return df.join(codes, col, "left")


def encode_with(df: DataFrame, col: str, out: str, labels) -> DataFrame:
    """SC5 by fitted labels: the code is a label's place among ``labels``,
    whatever other rows the frame has.  A label that was not there when the
    encoder was fitted gets the next code, ``len(labels)``; NULL stays NULL."""
    codes = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(labels)], "_label string, _code long")
    known = df.drop(out).join(F.broadcast(codes), F.col(col) == F.col("_label"), "left")  # a row a fitted label
    return known.withColumn(out, F.when(F.col(col).isNotNull(), F.coalesce("_code", F.lit(len(labels)).cast("long")))).drop(
        "_label", "_code")


def churn_features(clean: DataFrame, rfm: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """ML2: one row per customer with a completed order: segment (first in
    row order), RFM values, churn label, encoded segment.  ``groups`` are
    the lines' ``customer_groups`` where they are at hand."""
    comp = clean.filter(F.col("is_completed"))
    if groups is None:
        o = F.struct("order_date", "order_id")
        seg = comp.groupBy("customer_id").agg(E.first_by("customer_segment", o).alias("customer_segment"))
    else:
        seg = FT.first_values(groups.filter(F.col("is_completed")), comp, "customer_id", ["customer_segment"])
    cust = (seg.join(rfm.select("customer_id", "days_since_last_purchase", "purchase_frequency",
                                "total_revenue", "avg_order_value", "is_churned"),
                     "customer_id", "inner")
            .na.drop(subset=["is_churned"]))
    return label_encode(cust, "customer_segment", "segment_enc")


def demand_features(clean: DataFrame) -> DataFrame:
    """ML3: units / revenue per (category, week) with per-category time index,
    lags 1/2/4 and previous-4 mean, encoded category; incomplete rows dropped."""
    cw = (clean.filter(F.col("is_completed") & F.col("product_category").isNotNull())
          .groupBy("product_category", "week_start")
          .agg(F.sum("quantity").alias("units"),
               F.sum("revenue").cast("double").alias("revenue")))
    w = Window.partitionBy("product_category").orderBy("week_start")
    cols = {
        "week_num": F.weekofyear("week_start").cast("bigint"),
        "month": F.month("week_start").cast("bigint"),
        "t": (F.row_number().over(w) - 1).cast("bigint"),
    }
    for k in LAGS:
        cols[f"units_lag{k}"] = F.lag("units", k).over(w)
    cols["units_roll4"] = _prev_mean("units", w)
    cw = cw.withColumns(cols)
    cw = label_encode(cw, "product_category", "cat_enc")
    return cw.na.drop("any")


# ---------------------------------------------------------------------------
# Deterministic stand-in scorers
# ---------------------------------------------------------------------------

def naive_forecast(df: DataFrame) -> DataFrame:
    """Previous week's revenue."""
    return df.withColumn("prediction", F.col("revenue_lag1").cast("double"))


def naive_demand(df: DataFrame) -> DataFrame:
    """Previous week's units for the same category."""
    return df.withColumn("prediction", F.col("units_lag1").cast("double"))


def naive_churn(df: DataFrame) -> DataFrame:
    """Inactivity share of 180 days, capped at 1."""
    p = F.least(F.col("days_since_last_purchase").cast("double") / F.lit(180.0), F.lit(1.0))
    return df.withColumns({"probability_1": p,
                           "prediction": F.when(p >= CLASS_THRESHOLD, 1.0).otherwise(0.0)})


# ---------------------------------------------------------------------------
# Prediction tables
# ---------------------------------------------------------------------------

def sales_forecast(weekly: DataFrame, scorer: Scorer, model_name: str,
                   horizon: int = FORECAST_HORIZON) -> DataFrame:
    """ML14 + ML15 + SO1: in-sample predictions (clipped at 0, error rounded
    to 2 dp) followed by ``horizon`` future rows (prediction rounded to 2 dp)."""
    scored = scorer(weekly)
    pred = E.clip_lower("prediction", 0.0)
    in_sample = scored.select(
        "week_start",
        F.col("revenue").alias("actual_revenue"),
        pred.alias("predicted_revenue"),
        E.rnd(F.col("revenue") - pred, 2).alias("prediction_error"),
        F.lit(model_name).alias("model_name"),
        F.lit(False).alias("is_future"),
    )
    future = scorer(future_weekly_features(weekly, horizon)).select(
        "week_start",
        F.lit(None).cast("double").alias("actual_revenue"),
        E.rnd(E.clip_lower("prediction", 0.0), 2).alias("predicted_revenue"),
        F.lit(None).cast("double").alias("prediction_error"),
        F.lit(model_name).alias("model_name"),
        F.lit(True).alias("is_future"),
    )
    return in_sample.unionByName(future)


def risk_level(p):
    """SC3: right-closed bins (-0.01, 0.33] Low, (0.33, 0.66] Medium, (0.66, 1.01] High."""
    e, lv = RISK_BIN_EDGES, RISK_LEVELS
    return (F.when((p > e[0]) & (p <= e[1]), lv[0])
            .when((p > e[1]) & (p <= e[2]), lv[1])
            .when((p > e[2]) & (p <= e[3]), lv[2]))


def churn_risk(cust: DataFrame, scorer: Scorer) -> DataFrame:
    """ML16: churn probability (4 dp), risk level, money rounded to 2 dp,
    highest risk first."""
    scored = scorer(cust).withColumn("churn_risk_probability", E.rnd("probability_1", 4))
    return (scored.select(
        "customer_id", "customer_segment", "days_since_last_purchase",
        E.rnd("total_revenue", 2).alias("total_revenue"),
        "purchase_frequency",
        E.rnd("avg_order_value", 2).alias("avg_order_value"),
        "churn_risk_probability",
        risk_level(F.col("churn_risk_probability")).alias("risk_level"),
    ).orderBy(F.desc("churn_risk_probability"), "customer_id"))


def demand_trend(cat_wk: DataFrame) -> DataFrame:
    """WN10 / WN11 / SC4: mean of the last 4 weeks vs the 4 weeks before
    (whole-history mean when a category has fewer than 8 weeks);
    ratio > 1.05 Increasing, < 0.95 Decreasing, else Stable."""
    w = Window.partitionBy("product_category").orderBy(F.desc("week_start"))
    ranked = cat_wk.select("product_category", "units", F.row_number().over(w).alias("_rn"))
    agg = (ranked.groupBy("product_category")
           .agg(F.avg(F.when(F.col("_rn") <= 4, F.col("units"))).alias("recent"),
                F.avg(F.when(F.col("_rn").between(5, 8), F.col("units"))).alias("_prior8"),
                F.avg("units").alias("_all"),
                F.count(F.lit(1)).alias("_n")))
    prior = F.when(F.col("_n") >= 8, F.col("_prior8")).otherwise(F.col("_all"))
    ratio = E.ratio(F.col("recent"), prior)
    up, down, flat = TREND_LABELS
    label = F.when(ratio > TREND_UP, up).when(ratio < TREND_DOWN, down).otherwise(flat)
    return agg.select("product_category", "recent", prior.alias("prior"),
                      ratio.alias("ratio"), label.alias("demand_trend"))


def demand_predictions(cat_wk: DataFrame, scorer: Scorer) -> DataFrame:
    """ML17: per category-week actual and predicted units (clipped at 0,
    rounded half-even, integer) with the category's demand trend (JN6)."""
    scored = scorer(cat_wk)
    trend = demand_trend(cat_wk).select("product_category", "demand_trend")
    return (scored.join(trend, "product_category", "left")
            .select("product_category",
                    F.col("week_start").alias("week"),
                    F.col("units").alias("actual_units_sold"),
                    "demand_trend",
                    E.rnd(E.clip_lower("prediction", 0.0), 0).cast("bigint").alias("predicted_units_sold"))
            .orderBy("product_category", "week"))
