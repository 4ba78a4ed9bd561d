"""Relations that hold between the marts (the source's golden-table checks)."""

import datetime as dt

from pyspark.sql import functions as F

from orderlens.operators import marts as M
from orderlens.plans import ml_queries as MQ
from orderlens.plans import stages as S


def test_totals_agree_across_marts(spark, sf_dir):
    cl, rfm = S.orders_clean(spark, sf_dir), S.customers(spark, sf_dir)
    wk = M.weekly_kpis(cl, rfm).agg(F.sum("total_orders")).first()[0]
    rev = {n: round(df.agg(F.sum("total_revenue")).first()[0], 2) for n, df in {
        "campaign": M.performance_by(cl, "campaign_name"),
        "channel": M.performance_by(cl, "sales_channel"),
        "segment": M.segment_performance(cl, rfm)}.items()}
    assert len(set(rev.values())) == 1
    orders = M.segment_performance(cl, rfm).agg(F.sum("total_orders")).first()[0]
    assert wk == orders
    churn = MQ.naive_churn_risk(spark, sf_dir)
    assert churn.agg(F.sum("purchase_frequency")).first()[0] == orders
    assert round(churn.agg(F.sum("total_revenue")).first()[0], 0) == round(rev["segment"], 0)


def test_weeks_are_mondays(spark, sf_dir):
    wk = M.weekly_kpis(S.orders_clean(spark, sf_dir), S.customers(spark, sf_dir)).toPandas()
    assert all(d.weekday() == 0 for d in wk.week_start)
    weeks = sorted(wk.week_start)
    assert len(set(weeks)) == len(weeks)
    assert all((b - a).days % 7 == 0 for a, b in zip(weeks, weeks[1:]))


def test_risk_levels_follow_bins(spark, sf_dir):
    rows = MQ.naive_churn_risk(spark, sf_dir).select("churn_risk_probability", "risk_level").collect()
    for p, lvl in rows:
        assert lvl == ("Low" if p <= 0.33 else "Medium" if p <= 0.66 else "High")


def test_dim_date_covers_history_plus_six_weeks(spark, sf_dir):
    cl = S.orders_clean(spark, sf_dir)
    lo, hi = cl.agg(F.min("order_date"), F.max("order_date")).first()
    d = M.dim_date(cl)
    assert d.count() == (hi - lo).days + 43
    assert d.agg(F.max("date")).first()[0] == hi + dt.timedelta(days=42)


def test_forecast_has_four_future_weeks(spark, sf_dir):
    f = MQ.naive_sales_forecast(spark, sf_dir).toPandas()
    fut = f[f.is_future]
    assert len(fut) == 4 and fut.actual_revenue.isna().all()
    last = f[~f.is_future].week_start.max()
    assert sorted(fut.week_start) == [last + dt.timedelta(days=7 * h) for h in range(1, 5)]
