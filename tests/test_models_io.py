"""Learned models (rows / ranges only), model and table persistence, slicers."""


import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from orderlens.plans import dashboard as D
from orderlens.plans import exports as X
from orderlens.plans import models as MD
from orderlens.plans import stages as S
from orderlens.sources import files as IO


def test_learned_tables_have_sane_ranges(spark, sf_dir):
    qs = entry.queries()
    sf = qs["sales_forecast"](spark, sf_dir).toPandas()
    assert sf.is_future.sum() == 4 and (sf.predicted_revenue >= 0).all()
    churn = qs["customer_churn_risk"](spark, sf_dir).toPandas()
    assert churn.churn_risk_probability.between(0, 1).all()
    assert set(churn.risk_level) <= {"Low", "Medium", "High"}
    dem = qs["product_demand_predictions"](spark, sf_dir).toPandas()
    assert (dem.predicted_units_sold >= 0).all()
    perf = qs["model_performance"](spark, sf_dir).toPandas()
    assert len(perf) == 8 and perf.metric_value.notna().all()
    hold = qs["holdout_metrics"](spark, sf_dir).toPandas()
    assert len(hold) == 2 * 3 + 2 * 5 + 3 and set(hold.model) == {"forecast", "churn", "demand"}
    assert all(g[g.picked].candidate.nunique() == 1 for _, g in hold.groupby("model"))
    mae = hold[(hold.model == "forecast") & (hold.metric_name == "MAE")]
    assert mae[mae.picked].metric_value.item() == mae.metric_value.min()
    imp = qs["feature_importances"](spark, sf_dir).toPandas()
    assert set(imp.model) == {"forecast", "churn", "demand"}


def test_model_save_load_roundtrip(spark, sf_dir, tmp_path):
    m = MD.fitted_models(spark, sf_dir)["demand"]
    path = str(tmp_path / "demand")
    MD.save_model(m, path, ["x", "y"])
    again = MD.load_model(path)
    assert (again.name, again.features, again.labels) == (m.name, tuple(m.features), ("x", "y"))
    from orderlens.plans import ml_queries as MQ
    frame = MQ.demand_frame(spark, sf_dir)
    a = m.score(frame).agg(F.sum("prediction")).first()[0]
    b = again.score(frame).agg(F.sum("prediction")).first()[0]
    assert a == pytest.approx(b)


def test_export_and_typed_reload(spark, sf_dir):
    man = entry.queries()["export_manifest"](spark, sf_dir).toPandas()
    assert (man.status == "OK").all() and len(man) == 12
    folder = X.export_folder(spark, sf_dir)
    bundle = IO.load_bundle(spark, folder)
    wk = bundle["weekly_kpis"]
    assert dict(wk.dtypes)["week_start"] == "date"
    assert wk.count() == man.set_index("table").loc["weekly_kpis", "rows"]
    assert spark.sql("select count(*) from fact_orders").first()[0] > 0


def test_year_slicer(spark, sf_dir):
    cl = S.orders_clean(spark, sf_dir)
    years = sorted(r[0] for r in cl.select(F.year("order_date")).distinct().collect())
    one = D.revenue_by(cl, "customer_segment", years=[years[0]]).agg(F.sum("total_revenue")).first()[0]
    want = (cl.filter(F.col("is_completed") & (F.year("order_date") == years[0]))
            .agg(F.sum("revenue")).first()[0])
    assert one == pytest.approx(float(want))
    with pytest.raises(ValueError):
        D.revenue_by(cl, "customer_segment", years=[])
