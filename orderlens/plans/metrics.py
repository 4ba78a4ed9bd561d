"""Model metrics (ML11, ML12) and the long model-performance table (ML18).

Every metric is a distributed aggregate over a (label, prediction) frame:

* regression: MAE, RMSE, MAPE % (denominator clipped at 1);
* classification at a probability threshold: accuracy, precision, recall,
  F1 (0 on zero division) and ROC-AUC with ties counted one half.

ROC-AUC needs, for every positive, the number of negatives with a lower
score.  Scores are first aggregated per distinct value, then range-partitioned
by score: Spark samples the distinct scores, so the ranges hold about equally
many of them wherever the scores lie (near 0 and 1, or in one narrow band).  A
window inside each range counts the negatives below, and the totals of the
ranges before it (one row per partition) are added.  No step gathers all scores
into one task.  The result is exact (integer counts; only the final ratio is a
DOUBLE) and does not depend on where the ranges are cut.

Sums of DOUBLE errors go through ``exact_sum`` so results do not depend on
the order partitions are merged in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.constants import CLASS_THRESHOLD
from orderlens.functions import exprs as E
from orderlens.plans.stages import materialize_frame

def regression_metrics(df: DataFrame, label: str, pred: str, mape: bool = True) -> DataFrame:
    """One row: mae, rmse (and mape_pct)."""
    err = F.col(label).cast("double") - F.col(pred).cast("double")
    aggs = [E.exact_avg(F.abs(err)).alias("mae"),
            F.sqrt(E.exact_avg(err * err)).alias("rmse")]
    if mape:
        den = F.greatest(F.col(label).cast("double"), F.lit(1.0))
        aggs.append((E.exact_avg(F.abs(err) / den) * F.lit(100.0)).alias("mape_pct"))
    return df.agg(*aggs)


def ranged(per: DataFrame) -> DataFrame:
    """Distinct scores with the number ``r`` of their score range."""
    return per.repartitionByRange("s").withColumn("r", F.spark_partition_id())


def _roc_auc_parts(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: ``auc_num`` (2 x sum over positives of lower negatives +
    half ties, as an integer), positives, negatives."""
    y = F.col(label).cast("bigint")
    per = (df.filter(F.col(score).isNotNull())
           .groupBy(F.col(score).cast("double").alias("s"))
           .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))
    # one write of the ranged scores: the totals and the ranks must see the same cut
    per = materialize_frame(ranged(per), "auc-scores")
    before = F.sum("neg_r").over(Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1))
    # one row per range, at most ``spark.sql.shuffle.partitions`` of them
    offsets = (per.groupBy("r").agg(F.sum("neg").alias("neg_r"))
               .select("r", F.coalesce(before, F.lit(0)).alias("neg_before")))
    within = F.coalesce(F.sum("neg").over(
        Window.partitionBy("r").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = (per.withColumn("neg_within", within).join(F.broadcast(offsets), "r", "inner")
              .withColumn("neg_below", F.col("neg_before") + F.col("neg_within")))
    return ranked.agg(
        F.sum(F.col("pos").cast("decimal(38,0)") * F.col("neg_below") * 2
              + F.col("pos").cast("decimal(38,0)") * F.col("neg")).alias("auc_num"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))


def classification_metrics(df: DataFrame, label: str, prob: str,
                           threshold: float = CLASS_THRESHOLD) -> DataFrame:
    """One row: accuracy, precision, recall, f1, roc_auc (NULL with one class)."""
    y = F.col(label).cast("bigint")
    p = (F.col(prob) >= F.lit(threshold)).cast("bigint")
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if(y == p).alias("correct"))
    auc = _roc_auc_parts(df, label, prob)
    auc_val = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                     F.col("auc_num").cast("double")
                     / (F.lit(2.0) * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")))
    auc_col = auc.select(auc_val.alias("roc_auc")).scalar()
    return counts.select(
        E.ratio("correct", "n").alias("accuracy"),
        E.safe_div("tp", F.col("tp") + F.col("fp")).alias("precision"),
        E.safe_div("tp", F.col("tp") + F.col("fn")).alias("recall"),
        E.safe_div(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn")).alias("f1"),
        auc_col.alias("roc_auc"),
    )


def _long(metrics: DataFrame, model: str, algorithm: str, target: str, metric_type: str,
          names: dict[str, str]) -> DataFrame:
    """SO3: one row per metric, value rounded to 4 dp."""
    wide = metrics.select(*[F.col(c).cast("double").alias(n) for c, n in names.items()])
    long = wide.unpivot([], list(names.values()), "metric_name", "metric_value")
    return long.select(
        F.lit(model).alias("model"), F.lit(algorithm).alias("algorithm"), F.lit(target).alias("target"),
        F.lit(metric_type).alias("metric_type"), "metric_name",
        E.rnd("metric_value", 4).alias("metric_value"))


def model_performance(forecast_scored: DataFrame, forecast_algo: str,
                      churn_scored: DataFrame, churn_algo: str,
                      demand_scored: DataFrame, demand_algo: str) -> DataFrame:
    """ML18: 3 + 3 + 2 metric rows, evaluated on all rows of each frame
    (``prediction`` unclipped, as the source re-predicts), threshold 0.5."""
    f = _long(regression_metrics(forecast_scored, "revenue", "prediction"),
              "Sales Forecast", forecast_algo, "weekly_revenue", "Regression",
              {"mae": "MAE", "rmse": "RMSE", "mape_pct": "MAPE_pct"})
    c = _long(classification_metrics(churn_scored.withColumn("_y", F.col("is_churned").cast("bigint")),
                                      "_y", "probability_1"),
              "Customer Churn Risk", churn_algo, "is_churned", "Classification",
              {"accuracy": "Accuracy", "f1": "F1", "roc_auc": "ROC_AUC"})
    d = _long(regression_metrics(demand_scored, "units", "prediction", mape=False),
              "Product Demand", demand_algo, "weekly_units_by_category", "Regression",
              {"mae": "MAE", "rmse": "RMSE"})
    return f.unionByName(c).unionByName(d)


PIVOT_METRICS = ("MAE", "RMSE", "MAPE_pct", "Accuracy", "F1", "ROC_AUC")


def performance_pivot(perf: DataFrame) -> DataFrame:
    """AG19 / AG20: model x metric matrix plus best-metric cards (min MAE,
    max F1, max ROC-AUC) on every row."""
    piv = (perf.groupBy("model", "metric_type")
           .pivot("metric_name", list(PIVOT_METRICS))
           .agg(F.first("metric_value")))
    # a window over the pivoted rows (one per model), so that the metric table
    # is evaluated once
    every = Window.partitionBy()
    return piv.select("*", F.min("MAE").over(every).alias("best_mae"), F.max("F1").over(every).alias("best_f1"),
                      F.max("ROC_AUC").over(every).alias("best_roc_auc"))
