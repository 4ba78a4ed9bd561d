from test_clean import HEADER, _line

from orderlens.operators import marts as M
from orderlens.plans import stages as S
from orderlens.plans.batch import run_batch, serving_from_clean


def test_batch_from_driver_tables(spark, sf_dir, tmp_path):
    man = run_batch(spark, str(tmp_path / "out"), sf_dir=sf_dir, learned=True,
                    sizes={"forest_trees": 5, "gbt_iters": 3, "churn_forest_trees": 5}).toPandas()
    assert len(man) == 12 and (man.status == "OK").all()
    rows = man.set_index("table").rows
    assert rows["model_performance"] == 8 and rows["sales_forecast"] > 4


def test_batch_from_csv_landing(spark, tmp_path):
    lines = [HEADER] + [_line(f"O{i}", cust=f"C{i % 7}", date=f"2025-0{1 + i % 9}-0{1 + i % 9}")
                        for i in range(120)]
    land = tmp_path / "landing"
    land.mkdir()
    (land / "orders.csv").write_text("\n".join(lines) + "\n")
    out = tmp_path / "out"
    man = run_batch(spark, str(out), raw_csv=str(land), learned=False, write_processed=True).toPandas()
    assert (man.status == "OK").all()
    assert man.set_index("table").rows["fact_orders"] == 120
    feats = spark.read.parquet(str(out / "processed" / "orders_features"))
    assert feats.count() == 120 and {"rolling_4w_units", "is_churned", "conversion_rate"} <= set(feats.columns)


def test_batch_marts_come_from_cells(spark, sf_dir, tmp_path):
    """The same rows as the marts that scan the fact, read from the cells."""
    clean, rfm = S.orders_clean(spark, sf_dir), S.customers(spark, sf_dir)
    tables = serving_from_clean(clean, str(tmp_path), learned=False)
    want = {"weekly_kpis": M.weekly_kpis(clean, rfm), "campaign_performance": M.performance_by(clean, "campaign_name"),
            "sales_channel_performance": M.performance_by(clean, "sales_channel"),
            "segment_performance": M.segment_performance(clean, rfm)}
    for name, mart in want.items():
        assert tables[name].columns == mart.columns
        assert sorted(map(str, tables[name].collect())) == sorted(map(str, mart.collect()))
        if name != "weekly_kpis":  # new customers by signup week are no cells
            files = tables[name].inputFiles()
            assert files and all("/cells/" in f for f in files)
