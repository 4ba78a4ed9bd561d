"""Registered metric queries (ML11, ML12, ML18, DB17) on the stand-in scorers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import exprs as E
from orderlens.plans import metrics as MT
from orderlens.plans import ml_features as MF
from orderlens.plans import ml_queries as MQ
from orderlens.plans import oracle as O
from orderlens.plans.catalog import register


def _xavg(expr: str) -> str:
    return f"(fsum({expr}) / count({expr}))"


def _reg_sql(y: str, p: str, src: str, mape: bool = True) -> str:
    e = f"(CAST({y} AS DOUBLE) - CAST({p} AS DOUBLE))"
    cols = [f"{_xavg(f'abs({e})')} AS mae", f"sqrt({_xavg(f'{e} * {e}')}) AS rmse"]
    if mape:
        cols.append(f"{_xavg(f'abs({e}) / greatest(CAST({y} AS DOUBLE), 1.0)')} * 100.0 AS mape_pct")
    return f"SELECT {', '.join(cols)} FROM {src}"


CHURN_SCORED = "(SELECT CAST(is_churned AS BIGINT) AS y, least(CAST(days_since_last_purchase AS DOUBLE) / 180.0, 1.0) AS s FROM cf)"

METRIC_CTES = f"""
reg_f AS ({_reg_sql('revenue', 'revenue_lag1', 'wf')}),
reg_d AS ({_reg_sql('units', 'units_lag1', 'dw', mape=False)}),
cls_c AS (
  SELECT count(*) AS n, count_if(y = 1 AND s >= 0.5) AS tp, count_if(y = 0 AND s >= 0.5) AS fp,
         count_if(y = 1 AND s < 0.5) AS fn, count_if(y = CAST(s >= 0.5 AS BIGINT)) AS correct
  FROM {CHURN_SCORED} x
),
ps AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM {CHURN_SCORED} x WHERE s IS NOT NULL GROUP BY s),
pr AS (SELECT *, COALESCE(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                     AS below FROM ps),
auc AS (
  SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
           CAST(sum(CAST(pos AS DECIMAL(38,0)) * below * 2 + CAST(pos AS DECIMAL(38,0)) * neg) AS DOUBLE)
           / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS roc_auc
  FROM pr
),
cls AS (
  SELECT {O.ratio('correct', 'n')} AS accuracy,
         COALESCE({O.ratio('tp', 'tp + fp')}, 0.0) AS precision,
         COALESCE({O.ratio('tp', 'tp + fn')}, 0.0) AS recall,
         COALESCE({O.ratio('tp * 2', 'tp * 2 + fp + fn')}, 0.0) AS f1,
         (SELECT roc_auc FROM auc) AS roc_auc
  FROM cls_c
),
perf AS (
  SELECT 'Sales Forecast' AS model, '{MQ.NAIVE_FORECAST_NAME}' AS algorithm, 'weekly_revenue' AS target,
         'Regression' AS metric_type, m.metric_name, {O.rnd('m.metric_value', 4)} AS metric_value
  FROM (UNPIVOT (SELECT mae AS "MAE", rmse AS "RMSE", mape_pct AS "MAPE_pct" FROM reg_f)
        ON "MAE", "RMSE", "MAPE_pct" INTO NAME metric_name VALUE metric_value) m
  UNION ALL
  SELECT 'Customer Churn Risk', 'InactivityShare', 'is_churned', 'Classification', m.metric_name,
         {O.rnd('m.metric_value', 4)}
  FROM (UNPIVOT (SELECT accuracy AS "Accuracy", f1 AS "F1", roc_auc AS "ROC_AUC" FROM cls)
        ON "Accuracy", "F1", "ROC_AUC" INTO NAME metric_name VALUE metric_value) m
  UNION ALL
  SELECT 'Product Demand', '{MQ.NAIVE_FORECAST_NAME}', 'weekly_units_by_category', 'Regression', m.metric_name,
         {O.rnd('m.metric_value', 4)}
  FROM (UNPIVOT (SELECT mae AS "MAE", rmse AS "RMSE" FROM reg_d)
        ON "MAE", "RMSE" INTO NAME metric_name VALUE metric_value) m
)"""


def msql(select: str) -> str:
    return MQ.ml_sql(select, METRIC_CTES)


def naive_model_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MT.model_performance(
        MF.naive_forecast(MQ.weekly_frame(spark, sf_dir)), MQ.NAIVE_FORECAST_NAME,
        MF.naive_churn(MQ.churn_frame(spark, sf_dir)), "InactivityShare",
        MF.naive_demand(MQ.demand_frame(spark, sf_dir)), MQ.NAIVE_FORECAST_NAME)


@register("regression_metrics", msql(f"""
SELECT 'forecast' AS frame, {O.rnd('mae', 4)} AS mae, {O.rnd('rmse', 4)} AS rmse, {O.rnd('mape_pct', 4)} AS mape_pct FROM reg_f
UNION ALL
SELECT 'demand', {O.rnd('mae', 4)}, {O.rnd('rmse', 4)}, CAST(NULL AS DOUBLE) FROM reg_d"""))
def q_regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML11 / MA6 on the previous-week scorers, 4 dp."""
    f = MT.regression_metrics(MF.naive_forecast(MQ.weekly_frame(spark, sf_dir)), "revenue", "prediction")
    d = MT.regression_metrics(MF.naive_demand(MQ.demand_frame(spark, sf_dir)), "units", "prediction",
                              mape=False)
    r = lambda df, name: df.select(F.lit(name).alias("frame"),
                                   *[E.rnd(c, 4).alias(c) for c in df.columns])
    return r(f, "forecast").unionByName(r(d, "demand"), allowMissingColumns=True)


@register("classification_metrics", msql(f"""
SELECT {', '.join(O.rnd(c, 4) + ' AS ' + c for c in ('accuracy', 'precision', 'recall', 'f1', 'roc_auc'))}
FROM cls"""))
def q_classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML12 on the inactivity scorer, threshold 0.5, 4 dp."""
    scored = MF.naive_churn(MQ.churn_frame(spark, sf_dir)).withColumn("_y", F.col("is_churned").cast("bigint"))
    m = MT.classification_metrics(scored, "_y", "probability_1")
    return m.select(*[E.rnd(c, 4).alias(c) for c in m.columns])


@register("model_performance_naive", msql("SELECT * FROM perf"))
def q_model_performance_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML18 long table (SO3) on the stand-in scorers."""
    return naive_model_performance(spark, sf_dir)


@register("performance_pivot", msql(f"""
SELECT p.model, p.metric_type,
       max(CASE WHEN metric_name = 'MAE' THEN metric_value END) AS "MAE",
       max(CASE WHEN metric_name = 'RMSE' THEN metric_value END) AS "RMSE",
       max(CASE WHEN metric_name = 'MAPE_pct' THEN metric_value END) AS "MAPE_pct",
       max(CASE WHEN metric_name = 'Accuracy' THEN metric_value END) AS "Accuracy",
       max(CASE WHEN metric_name = 'F1' THEN metric_value END) AS "F1",
       max(CASE WHEN metric_name = 'ROC_AUC' THEN metric_value END) AS "ROC_AUC",
       (SELECT min(metric_value) FROM perf WHERE metric_name = 'MAE') AS best_mae,
       (SELECT max(metric_value) FROM perf WHERE metric_name = 'F1') AS best_f1,
       (SELECT max(metric_value) FROM perf WHERE metric_name = 'ROC_AUC') AS best_roc_auc
FROM perf p GROUP BY p.model, p.metric_type"""))
def q_performance_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DB17 / AG19 / AG20."""
    return MT.performance_pivot(naive_model_performance(spark, sf_dir))
