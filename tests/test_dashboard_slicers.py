"""Dashboard cards under a year selection vs a pandas brute force over the fact."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from orderlens.plans import dashboard as D
from orderlens.plans import stages as S


@pytest.fixture(scope="module")
def frames(spark, sf_dir):
    fact = S.orders_clean(spark, sf_dir)
    weekly = S.serving(spark, sf_dir, "weekly_kpis")
    years = sorted(r[0] for r in fact.select("year").distinct().collect())
    return fact, weekly, years[-3:-1]


def test_exec_cards_year_slice(frames):
    fact, weekly, years = frames
    got = D.exec_cards(fact, weekly, years=years).first()
    pdf = fact.select("year", "is_completed", F.col("revenue").cast("double").alias("revenue"),
                      F.col("margin").cast("double").alias("margin"), "customer_id").toPandas()
    comp = pdf[pdf.year.isin(years) & pdf.is_completed]
    assert got.total_orders == len(comp)
    assert got.total_revenue == pytest.approx(comp.revenue.sum())
    assert got.avg_order_value == pytest.approx(comp.revenue.sum() / len(comp))
    assert got.active_customers == comp.customer_id.nunique()
    wk = weekly.toPandas()
    wk = wk[wk.week_start.map(lambda d: d.year).isin(years)].sort_values("week_start")
    last = wk.iloc[-1].revenue_wow_growth
    assert got.revenue_delta == f"{last * 100:+.1f}% WoW"


def test_funnel_cards_year_slice(frames):
    fact, weekly, years = frames
    got = D.weekly_funnel_cards(fact, weekly, years=years).first()
    wk = weekly.toPandas()
    wk = wk[wk.week_start.map(lambda d: d.year).isin(years)]
    assert got.conversion_rate == pytest.approx(wk.completed_orders.sum() / wk.visits.sum())
    assert got.cart_abandonment_rate == pytest.approx(1 - wk.completed_orders.sum() / wk.cart_additions.sum())


def test_segment_share_sums_to_one(frames):
    fact, _, years = frames
    rows = D.segment_share(fact, years=years).collect()
    assert sum(r.revenue_share for r in rows) == pytest.approx(1.0)


def test_every_page_builds(spark, sf_dir):
    for name in D.PAGES:
        frames = D.page(spark, sf_dir, name, years=None, predictions="naive")
        assert frames and all(df.columns for df in frames.values())
    exec_page = D.page(spark, sf_dir, "executive_overview", years=[1997], predictions="naive")
    assert exec_page["cards"].count() == 1
    with pytest.raises(ValueError):
        D.page(spark, sf_dir, "executive_overview", years=[], predictions="naive")
    with pytest.raises(ValueError):
        D.page(spark, sf_dir, "nope", predictions="naive")


def test_slicers_reach_every_frame_of_a_page(spark, sf_dir):
    segment = S.serving(spark, sf_dir, "dim_customers").select("customer_segment").first()[0]
    sl = D.Slicers(segments=[segment], risk_levels=["Low"])
    frames = D.page(spark, sf_dir, "customer_segment", predictions="naive", slicers=sl)
    assert [r.customer_segment for r in frames["segment_share"].collect()] == [segment]
    assert [r.segment for r in frames["segment_table"].collect()] == [segment]
    assert {(r.customer_segment, r.risk_level) for r in frames["churn_scatter"].collect()} <= {(segment, "Low")}
    assert frames["cards"].first().high_risk_customers == 0
    assert set(D.page(spark, sf_dir, "model_performance", predictions="naive")) == {"matrix"}
    assert D.page(spark, sf_dir, "model_performance", predictions="naive")["matrix"].count() == 3
    for bad in ({"years": []}, {"segments": []}, {"risk_levels": []}):
        with pytest.raises(ValueError):
            D.Slicers(**bad)


def test_pages_without_predictions_train_nothing(spark, sf_dir, monkeypatch):
    from orderlens.plans import models as MD

    def no_training(*args):
        raise AssertionError("trained")
    monkeypatch.setattr(MD, "fitted_models", no_training)
    for name in ("executive_overview", "weekly_kpi_tracking"):
        D.page(spark, sf_dir, name)


def test_stage_follows_its_input(spark, sf_dir, tmp_path):
    """New files under the same folder make a new stage."""
    copy = tmp_path / "sf"
    copy.mkdir()
    for name in ("lineitem", "orders", "customer", "nation", "part"):
        (copy / f"{name}.parquet").write_bytes(open(f"{sf_dir}/{name}.parquet", "rb").read())
    first = S.orders_clean(spark, str(copy)).count()
    lines = pq.read_table(f"{sf_dir}/lineitem.parquet")
    pq.write_table(lines.slice(0, 7), copy / "lineitem.parquet")
    assert S.orders_clean(spark, str(copy)).count() <= 7 < first
