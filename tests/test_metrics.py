"""Metrics against brute force on small fixtures."""

import numpy as np
import pytest

from orderlens.plans import metrics as MT


def _auc_brute(y, s):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_roc_auc_exact_with_ties_and_out_of_range(spark, seed):
    rng = np.random.default_rng(seed)
    n = 700
    y = rng.integers(0, 2, n)
    s = np.round(rng.normal(0.5 + 0.2 * y, 0.4, n), 2)   # ties, and values outside [0, 1]
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y long, s double")
    got = MT.classification_metrics(df, "y", "s").first()
    assert got.roc_auc == pytest.approx(_auc_brute(y, s), abs=1e-12)
    p = (s >= 0.5).astype(int)
    tp, fp, fn = ((y == 1) & (p == 1)).sum(), ((y == 0) & (p == 1)).sum(), ((y == 1) & (p == 0)).sum()
    assert got.accuracy == pytest.approx((y == p).mean())
    assert got.f1 == pytest.approx(2 * tp / (2 * tp + fp + fn))


def test_single_class_auc_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y long, s double")
    assert MT.classification_metrics(df, "y", "s").first().roc_auc is None


def test_regression_metrics(spark):
    y = np.array([10.0, 0.5, 3.0, 7.25])
    p = np.array([8.0, 1.0, 3.0, 9.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    got = MT.regression_metrics(df, "y", "p").first()
    assert got.mae == pytest.approx(np.abs(y - p).mean())
    assert got.rmse == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert got.mape_pct == pytest.approx((np.abs(y - p) / np.clip(y, 1, None)).mean() * 100)


def test_scores_near_0_and_1_spread_over_the_ranges(spark):
    """A leaking label puts all scores within 1e-6 of 0 and 1; the ranges that
    are sorted still hold about equally many."""
    rng = np.random.default_rng(4)
    n = 4000
    y = rng.integers(0, 2, n)
    s = np.where(y == 1, 1 - 1e-6 * rng.random(n), 1e-6 * rng.random(n))
    s[:40] = 1 - s[:40]
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y long, s double")
    assert MT.classification_metrics(df, "y", "s").first().roc_auc == pytest.approx(_auc_brute(y, s), abs=1e-12)
    per = df.groupBy("s").count().repartition(16)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in MT.ranged(per).groupBy("r").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(sizes) == 8 and max(sizes) < 3 * n / 8


def test_huge_errors_do_not_overflow(spark):
    df = spark.createDataFrame([(1e14 + i, float(i)) for i in range(400)], "y double, p double")
    got = MT.regression_metrics(df, "y", "p").first()
    assert got.mae == 1e14 and got.rmse == 1e14


def test_sums_keep_fractions_of_a_cent(spark):
    from orderlens.functions import exprs as E
    df = spark.createDataFrame([(0.004,)] * 300 + [(None,)], "v double").repartition(7)
    assert df.agg(E.exact_sum("v").alias("s")).first().s == pytest.approx(1.2, rel=1e-15)
    import math
    import random
    random.seed(1)
    values = [random.uniform(-1, 1) * 10 ** random.randint(-9, 12) for _ in range(2000)]
    got = spark.createDataFrame([(v,) for v in values], "v double").agg(E.exact_sum("v").alias("s")).first().s
    assert got == pytest.approx(math.fsum(values), rel=1e-14)
