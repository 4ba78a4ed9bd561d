"""Learned models (ML5-ML10, ML13, ML14, ML16-ML19) on ``pyspark.ml``.

* sales forecast: random forest vs gradient-boosted trees on the weekly
  frame, temporal hold-out of the last 8 weeks, best = lowest hold-out MAE;
* churn: logistic regression vs random-forest classifier, stratified 25 %
  hold-out, best = highest hold-out ROC-AUC;
* demand: random forest on the category-week frame, random 20 % hold-out.

Splits are exact and deterministic (``exact_split``): every class gets
exactly ``ceil(share * n)`` test rows - those with the smallest
``xxhash64(key, seed)`` - selected through a per-(class, bucket) histogram,
so no window ever holds a whole class in one task.

Tree-ensemble sizes are the source model's values (``FOREST_TREES`` etc.),
also in the registered queries (``QUERY_SIZES``); boosting costs one Spark
job per iteration, so the fitted pipelines are trained once and shared by
every query of a session.
The learned results cannot equal the source's scikit-learn numbers (Spark
bins features and uses its own RNG); they are checked for rows, schema and
ranges only.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.constants import (CHURN_FOREST_DEPTH, CHURN_FOREST_TREES, CHURN_TEST_SHARE,
                                 DEMAND_TEST_SHARE, FOREST_DEPTH, FOREST_TREES, GBT_DEPTH, GBT_ITERS,
                                 GBT_STEP, LOGREG_ITERS)
from orderlens.constants import RANDOM_SEED as SEED
from orderlens.functions import exprs as E
from orderlens.plans import metrics as MT
from orderlens.plans import ml_features as MF
from orderlens.plans import ml_queries as MQ
from orderlens.plans import stages as S
from orderlens.plans.catalog import register
from orderlens.session import ensure_checkpoint_dir, input_version


# the registered queries train at the source model's sizes
#: Rows that a task of a fit has at least, where there are so many.
FIT_ROWS = 25_000

QUERY_SIZES = {"forest_trees": FOREST_TREES, "gbt_iters": GBT_ITERS, "churn_forest_trees": CHURN_FOREST_TREES}


def exact_split(df: DataFrame, key: str, share: float, seed: int = SEED,
                strata: str | None = None, bucket_bits: int = 15) -> DataFrame:
    """Adds ``is_test``: exactly ``ceil(share * n)`` rows of every stratum
    (class) go to the test side - the rows with the smallest
    ``xxhash64(key, seed)`` - chosen without ever putting a class in one task.

    1. every row gets a 31-bit hash and its top ``bucket_bits`` bits as a bucket;
    2. rows are counted per (stratum, bucket) - at most strata x 2^bits rows;
    3. a running count over those buckets finds, per stratum, the bucket where
       the k-th row lies and how many rows of it are needed (one row per
       stratum, broadcast: bounded by the number of classes);
    4. only the rows of that bucket are ranked by (hash, key), which gives the
       last test row of each stratum; every row compares itself with it.
    ``key`` must identify a row; ``strata`` must be a label, a column of few
    values, as one row per value is broadcast."""
    shift = 31 - bucket_bits
    h = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 31))
    d = (df.withColumn("_h", h)
         .withColumn("_b", F.shiftright(F.col("_h"), shift))
         .withColumn("_s", F.col(strata) if strata else F.lit(0)))
    counts = d.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    counts = (counts.withColumn("_cum", F.sum("_n").over(run))
              .withColumn("_tot", F.sum("_n").over(Window.partitionBy("_s")))
              .withColumn("_k", F.ceil(F.col("_tot") * F.lit(float(share)))))
    cut = (counts.filter(F.col("_cum") >= F.col("_k"))
           .groupBy("_s").agg(F.min_by(F.struct("_b", "_cum", "_n", "_k"), "_b").alias("c"))
           .select("_s", F.col("c._b").alias("_cut_b"),
                   (F.col("c._k") - (F.col("c._cum") - F.col("c._n"))).alias("_need")))
    # the last test row of a stratum: only rows of its cut bucket are ranked
    rank = F.row_number().over(Window.partitionBy("_s", "_b").orderBy("_h", key))
    inside = d.join(F.broadcast(cut), "_s").filter(F.col("_b") == F.col("_cut_b"))
    last = (inside.select("_s", "_h", F.col(key).alias("_key"), "_need", rank.alias("_rank"))
            .filter(F.col("_rank") == F.col("_need"))
            .select("_s", F.struct(F.col("_h").alias("h"), F.col("_key").alias("k")).alias("_last")))
    # one row per stratum, and strata is a label: a proven bound
    d = d.join(F.broadcast(last), "_s", "left")
    test = F.struct(F.col("_h").alias("h"), F.col(key).alias("k")) <= F.col("_last")
    return d.withColumn("is_test", F.coalesce(test, F.lit(False))).drop("_h", "_b", "_s", "_last")


def _pipeline(features, estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features",
                                            handleInvalid="keep"), estimator])


def with_probability(df: DataFrame) -> DataFrame:
    return df.withColumn("probability_1", vector_to_array("probability")[1])


@dataclass
class Fitted:
    name: str
    model: PipelineModel
    features: tuple[str, ...]
    holdout: dict = field(default_factory=dict)  # metrics by candidate
    labels: tuple[str, ...] = ()
    encoder: tuple[str, str] | None = None  # column, and column of its code

    def score(self, df: DataFrame) -> DataFrame:
        """Scored frame.  Codes come from the labels the model was fitted with,
        not from the labels that the frame happens to hold."""
        if self.encoder and self.labels:
            df = MF.encode_with(df, *self.encoder, self.labels)
        out = self.model.transform(df)
        if "probability" in out.columns:
            out = with_probability(out)
        return out.drop("features", "rawPrediction", "probability")


REGRESSION_METRICS = {"mae": "MAE", "rmse": "RMSE", "mape_pct": "MAPE_pct"}
CLASS_METRICS = {"accuracy": "Accuracy", "precision": "Precision", "recall": "Recall", "f1": "F1", "roc_auc": "ROC_AUC"}


def _holdout(scored: DataFrame, label: str, classes: bool) -> dict[str, float | None]:
    """Every hold-out metric of a scored frame."""
    if classes:
        row = MT.classification_metrics(scored.withColumn("_y", F.col(label).cast("bigint")), "_y", "probability_1").first()
        return {name: row[c] for c, name in CLASS_METRICS.items()}
    row = MT.regression_metrics(scored, label, "prediction").first()
    return {name: row[c] for c, name in REGRESSION_METRICS.items()}


def _for_scoring(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The fitted pipeline without the training summary of a classifier, by way
    of the shared folder.  A summary refers to its session, which cannot go to
    the tasks once an observed plan has run in it, and so neither could the model."""
    if not getattr(model.stages[-1], "hasSummary", False):
        return model
    path = os.path.join(ensure_checkpoint_dir(spark), "orderlens-fitted", uuid.uuid4().hex)
    model.write().save(path)
    return PipelineModel.load(path)


def _select(data: DataFrame, label: str, features: Sequence[str], candidates: dict[str, Callable], metric: str,
            larger: bool) -> Fitted:
    """Fit every candidate on the train rows, measure all on the hold-out, pick
    by ``metric`` (ties and missing values: the first of the list).  The winner
    carries the metrics of all."""
    data = data.cache()
    try:
        train, test = data.filter(~F.col("is_test")), data.filter(F.col("is_test"))
        n_train = max(train.count(), 1)
        # candidates side by side: their jobs share the cluster
        with ThreadPoolExecutor(max_workers=len(candidates)) as pool:
            models = pool.map(lambda make: _pipeline(features, make(n_train)).fit(train), candidates.values())
            fitted = {name: Fitted(name, _for_scoring(model, data.sparkSession), tuple(features))
                      for name, model in zip(candidates, models)}
        table = {name: _holdout(f.score(test), label, larger) for name, f in fitted.items()}
    finally:
        data.unpersist()
    worst = float("-inf") if larger else float("inf")
    value = {name: worst if m[metric] is None else m[metric] for name, m in table.items()}
    best = (max if larger else min)(value, key=value.get)
    fitted[best].holdout = table
    return fitted[best]


def train_forecast(weekly: DataFrame, forest_trees=FOREST_TREES, gbt_iters=GBT_ITERS) -> Fitted:
    """ML7 / ML8 / ML13: the lower hold-out MAE of forest and boosting wins."""
    # a row a week: one partition saves a task for each other in every tree
    return _select(weekly.coalesce(1), "revenue", MF.FORECAST_FEATURES, {
        "RandomForest": lambda n: RandomForestRegressor(
            labelCol="revenue", numTrees=forest_trees, maxDepth=FOREST_DEPTH, featureSubsetStrategy="all", seed=SEED),
        "GradientBoosting": lambda n: GBTRegressor(
            labelCol="revenue", maxIter=gbt_iters, stepSize=GBT_STEP, maxDepth=GBT_DEPTH, seed=SEED),
    }, "MAE", larger=False)


def spread(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows over enough tasks for every core: a fit goes over its rows again
    and again, in as many tasks as the files they were read from.  Rows lie by
    ``key``, so that a fit sees them in the same order each time."""
    tasks = min(2 * df.sparkSession.sparkContext.defaultParallelism, n // FIT_ROWS)
    return df.repartition(tasks, key).sortWithinPartitions(key) if tasks > 1 else df


def train_churn(cust: DataFrame, forest_trees=CHURN_FOREST_TREES) -> Fitted:
    """ML5 / ML9 / ML10 / ML13: the higher hold-out ROC-AUC wins."""
    data = exact_split(cust.withColumn("label", F.col("is_churned").cast("double")),
                       "customer_id", CHURN_TEST_SHARE, strata="label")
    data = spread(data, "customer_id", cust.count())  # the frame that grows with the customers
    return _select(data, "label", MF.CHURN_FEATURES, {
        "LogisticRegression": lambda n: LogisticRegression(
            maxIter=LOGREG_ITERS, regParam=1.0 / n, elasticNetParam=0.0, standardization=False),
        "RandomForest": lambda n: RandomForestClassifier(
            numTrees=forest_trees, maxDepth=CHURN_FOREST_DEPTH, featureSubsetStrategy="sqrt", seed=SEED),
    }, "ROC_AUC", larger=True)


def train_demand(cat_wk: DataFrame, forest_trees=FOREST_TREES) -> Fitted:
    """ML6 / ML7 on the category-week frame."""
    keyed = cat_wk.withColumn("_key", F.concat_ws("|", "product_category", F.col("week_start").cast("string")))
    data = exact_split(keyed, "_key", DEMAND_TEST_SHARE).drop("_key")
    return _select(data, "units", MF.DEMAND_FEATURES, {
        "RandomForest": lambda n: RandomForestRegressor(
            labelCol="units", numTrees=forest_trees, maxDepth=FOREST_DEPTH, featureSubsetStrategy="all", seed=SEED),
    }, "MAE", larger=False)


# ---------------------------------------------------------------------------
# IO9: persist / reload fitted pipelines
# ---------------------------------------------------------------------------

#: Encoded column of each model and the column of its code.
ENCODERS = {"churn": ("customer_segment", "segment_enc"), "demand": ("product_category", "cat_enc")}


def with_encoder(name: str, fitted: Fitted, frame: DataFrame) -> Fitted:
    """Keep the labels of the frame a model was fitted on, in the order of their
    codes (a row a label)."""
    if name in ENCODERS:
        column, code = fitted.encoder = ENCODERS[name]
        fitted.labels = tuple(r[0] for r in frame.select(column, code).where(F.col(column).isNotNull()).distinct()
                              .orderBy(code).collect())
    return fitted


_CARD = "name string, features array<string>, labels array<string>"


def save_model(fitted: Fitted, path: str, labels: Sequence[str] = ()) -> None:
    """A bundle: the pipeline, and a card with the winner's name, its features
    in order and the labels of the encoder (their place is their code)."""
    fitted.model.write().overwrite().save(f"{path}/pipeline")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(fitted.name, list(fitted.features), list(labels))], _CARD).coalesce(1).write.mode(
        "overwrite").json(f"{path}/card")


def load_model(path: str) -> Fitted:
    """A bundle back, ready to score."""
    card = SparkSession.getActiveSession().read.schema(_CARD).json(f"{path}/card").first()
    return Fitted(card["name"], PipelineModel.load(f"{path}/pipeline"), tuple(card["features"]),
                  labels=tuple(card["labels"] or ()))


def save_models(models: dict[str, Fitted], folder: str, frames: dict[str, DataFrame]) -> None:
    """Bundles of all models: pipeline, card with the fitted labels, and the
    scoring frame."""
    for name, m in models.items():
        with_encoder(name, m, frames[name])
        save_model(m, f"{folder}/{name}", m.labels)
        frames[name].write.mode("overwrite").parquet(f"{folder}/{name}/frame")


def load_models(folder: str) -> dict[str, Fitted]:
    found = {name: load_model(f"{folder}/{name}") for name in ("forecast", "churn", "demand")}
    for name, m in found.items():
        m.encoder = ENCODERS.get(name)
    return found


def load_frames(folder: str) -> dict[str, DataFrame]:
    """Scoring frames of saved bundles."""
    spark = SparkSession.getActiveSession()
    return {name: spark.read.parquet(f"{folder}/{name}/frame") for name in ("forecast", "churn", "demand")}


# ---------------------------------------------------------------------------
# Session-shared fitted models for the registered queries
# ---------------------------------------------------------------------------

_LOCK = threading.RLock()
_FITTED: dict[tuple, dict[str, Fitted]] = {}


MODEL_NAMES = ("forecast", "churn", "demand")


def fitted_models(spark: SparkSession, sf_dir: str, names: Sequence[str] = MODEL_NAMES) -> dict[str, Fitted]:
    """The named models, each fitted and saved once per application and input;
    a query that reads one model neither builds nor fits the others."""
    version = input_version(spark, sf_dir, S.ORDER_TABLES)
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), version)
    frame = {"forecast": MQ.weekly_frame, "churn": MQ.churn_frame, "demand": MQ.demand_frame}
    train = {
        "forecast": lambda df: train_forecast(df, QUERY_SIZES["forest_trees"], QUERY_SIZES["gbt_iters"]),
        "churn": lambda df: train_churn(df, QUERY_SIZES["churn_forest_trees"]),
        "demand": lambda df: train_demand(df, QUERY_SIZES["forest_trees"]),
    }
    with _LOCK:
        fitted = _FITTED.setdefault(key, {})
        missing = [n for n in names if n not in fitted]
        if missing:
            frames = {n: frame[n](spark, sf_dir) for n in missing}
            with ThreadPoolExecutor(max_workers=len(missing)) as pool:
                models = dict(zip(missing, pool.map(lambda n: train[n](frames[n]), missing)))
            digest = hashlib.sha1(f"{os.path.abspath(sf_dir)} {version}".encode()).hexdigest()[:10]
            save_models(models, os.path.join(ensure_checkpoint_dir(spark), "orderlens-models", digest), frames)
            fitted.update(models)
        return {n: fitted[n] for n in names}


@register("sales_forecast")
def q_sales_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML14 / ML15 with the selected forecast model (rows-only)."""
    m = fitted_models(spark, sf_dir, ["forecast"])["forecast"]
    return MF.sales_forecast(MQ.weekly_frame(spark, sf_dir), m.score, m.name)


@register("customer_churn_risk")
def q_customer_churn_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML16 with the selected churn model (rows-only)."""
    m = fitted_models(spark, sf_dir, ["churn"])["churn"]
    return MF.churn_risk(MQ.churn_frame(spark, sf_dir), m.score)


@register("product_demand_predictions")
def q_product_demand_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML17 with the demand model (rows-only)."""
    m = fitted_models(spark, sf_dir, ["demand"])["demand"]
    return MF.demand_predictions(MQ.demand_frame(spark, sf_dir), m.score)


@register("model_performance")
def q_model_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML18 with the learned models, all rows, threshold 0.5 (rows-only)."""
    ms = fitted_models(spark, sf_dir)
    return MT.model_performance(
        ms["forecast"].score(MQ.weekly_frame(spark, sf_dir)), ms["forecast"].name,
        ms["churn"].score(MQ.churn_frame(spark, sf_dir)), ms["churn"].name,
        ms["demand"].score(MQ.demand_frame(spark, sf_dir)), ms["demand"].name)


@register("holdout_metrics")
def q_holdout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML11-ML13: every hold-out metric of every candidate, and which candidate
    was picked (rows-only)."""
    rows = [(model, name, metric, None if value is None else float(value), name == m.name)
            for model, m in fitted_models(spark, sf_dir).items()
            for name, metrics in m.holdout.items() for metric, value in metrics.items()]
    return spark.createDataFrame(rows, "model string, candidate string, metric_name string, metric_value double, "
                                       "picked boolean").withColumn("metric_value", E.rnd("metric_value", 4))


@register("feature_importances")
def q_feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML19: tree importances or linear coefficients per feature (rows-only)."""
    rows = []
    for key, m in fitted_models(spark, sf_dir).items():
        last = m.model.stages[-1]
        if hasattr(last, "featureImportances"):
            values, kind = last.featureImportances.toArray(), "importance"
        else:
            values, kind = last.coefficients.toArray(), "coefficient"
        rows += [(key, m.name, f, kind, float(v)) for f, v in zip(m.features, values)]
    return spark.createDataFrame(rows, "model string, algorithm string, feature string, kind string, value double")
