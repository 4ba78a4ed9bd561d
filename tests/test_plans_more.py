import datetime as dt

from orderlens.operators import marts as M
from orderlens.plans import dashboard as D
from orderlens.plans import stages as S


def test_date_range_slicer(spark, sf_dir):
    wk = M.weekly_kpis(S.orders_clean(spark, sf_dir), S.customers(spark, sf_dir))
    weeks = sorted(r[0] for r in wk.select("week_start").collect())
    lo, hi = weeks[2], weeks[6]
    got = D.weekly_series(wk, start=str(lo), end=str(hi)).toPandas()
    assert list(got.week_start) == weeks[2:7]
    assert isinstance(got.week_start.iloc[0], dt.date)
