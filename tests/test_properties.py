"""Brute-force equivalence with a float frame on random inputs."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from orderlens.functions import exprs as E
from orderlens.operators import clean as C


def test_rnd_equals_numpy_round(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(0, 1000, 2000), np.round(rng.normal(0, 10, 2000), 5),
                        np.arange(-50, 50) / 8.0])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    for n in (0, 2, 4):
        got = np.array([r[0] for r in df.select(E.rnd("x", n)).collect()])
        assert np.array_equal(got, np.round(x, n))


def test_week_start_equals_period_start(spark):
    days = [dt.date(1994, 12, 25) + dt.timedelta(days=i) for i in range(0, 4000, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(E.week_start("d")).collect()]
    want = [p.start_time.date() for p in pd.to_datetime(pd.Series(days)).dt.to_period("W")]
    assert got == want
    iso = [r[0] for r in df.select(E.iso_year_week("d")).collect()]
    assert iso == [d.strftime("%G-W%V") for d in days]


def test_clip_and_ratio_follow_nan_semantics(spark):
    rng = np.random.default_rng(3)
    num = rng.integers(0, 4, 500).astype(float)
    den = rng.integers(0, 4, 500).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(num, den)], "a double, b double")
    got = np.array([np.nan if r[0] is None else r[0]
                    for r in df.select(E.clip01(E.ratio("a", "b"))).collect()])
    with np.errstate(divide="ignore", invalid="ignore"):
        want = pd.Series(num / np.where(den == 0, np.nan, den)).clip(0, 1).to_numpy()
    assert np.array_equal(np.isnan(got), np.isnan(want))
    assert np.allclose(got[~np.isnan(got)], want[~np.isnan(want)], rtol=0, atol=0)


def test_dedup_keep_first_equals_sorted_drop_duplicates(spark):
    rng = np.random.default_rng(11)
    n = 3000
    pdf = pd.DataFrame({"order_id": rng.integers(0, 700, n).astype(str),
                        "pos": rng.permutation(n), "v": rng.normal(size=n)})
    df = spark.createDataFrame(pdf).repartition(6)
    got = C.dedup_keep_first(df, "order_id", ["pos"]).toPandas().sort_values("order_id")
    want = pdf.sort_values("pos").drop_duplicates("order_id").sort_values("order_id")
    assert got.order_id.tolist() == want.order_id.tolist()
    assert np.array_equal(got.v.to_numpy(), want.v.to_numpy())


def test_coerce_matches_to_numeric(spark):
    vals = ["1", "2.5", " 3 ", "-4e2", ".5", "5.", "abc", "", "1.0d", "0x10", "1,000", "NaN", "nan",
            "inf", "-inf", "1e-3", "+7"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(E.coerce_double("s")).collect()]
    want = pd.to_numeric(pd.Series(vals), errors="coerce")
    for g, w, v in zip(got, want, vals):
        if pd.isna(w):
            assert g is None, v
        else:
            assert g == w, v


def test_measure_formats_match_python_formatting(spark):
    rng = np.random.default_rng(19)
    x = np.concatenate([rng.normal(0, 1e6, 300), rng.normal(0, 1, 300), [0.0, -0.0, 0.005, -0.004]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    rows = df.select(E.fmt_measure("x", "#,0").alias("n"), E.fmt_measure("x", "£#,0.00").alias("c"),
                     E.fmt_measure("x", "0.00%").alias("p"),
                     E.fmt_measure("x", "+0.00%;-0.00%;0.00%").alias("s")).collect()
    for v, r in zip(x, rows):
        v0, v2, p2 = np.round(v, 0), np.round(v, 2), np.round(v * 100.0, 2)
        assert r.n == f"{v0:,.0f}".replace("-0", "0") or r.n == f"{v0:,.0f}"
        assert r.c == ("-" if v2 < 0 else "") + "£" + f"{abs(v2):,.2f}"
        assert r.p == f"{p2:.2f}%"
        assert r.s == ("0.00%" if p2 == 0 else f"{p2:+.2f}%")
