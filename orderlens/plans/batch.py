"""Full batch run: clean -> features -> marts -> models -> predictions ->
serving export + manifest (the source's end-to-end run, Entry A).

Works from either input the library knows: the driver tables (``sf_dir``)
or a CSV landing folder of raw orders (``raw_csv``).  Every table is a lazy
DataFrame until the export writes it; the clean fact and the customer table
are written first and every later step reads them back (stage boundary).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from orderlens.operators import cells as CE
from orderlens.operators import features as FT
from orderlens.operators import marts as M
from orderlens.plans import metrics as MT
from orderlens.plans import ml_features as MF
from orderlens.plans import models as MD
from orderlens.plans import stages as S
from orderlens.sources import files as IO


def _stage(df: DataFrame, path: str, partition_by=()) -> DataFrame:
    schema = df.schema
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path).select(*schema.fieldNames())


def serving_from_clean(clean: DataFrame, work_dir: str, learned: bool = True,
                       sizes: dict | None = None, models_from: str | None = None) -> dict[str, DataFrame]:
    """The 12 serving tables from a clean fact (with funnel columns).  Models
    are trained and their bundles saved under ``work_dir/models``, or loaded
    from the bundles in ``models_from``.  The four performance marts come from
    cells, which read the fact once for all of them."""
    rfm = _stage(FT.customer_rfm(clean), os.path.join(work_dir, "customer_rfm"))
    cells = _stage(CE.build(M.completed(clean), rfm), os.path.join(work_dir, "cells"))
    weekly = _stage(MF.weekly_features(clean), os.path.join(work_dir, "forecast_features"))
    cust = _stage(MF.churn_features(clean, rfm), os.path.join(work_dir, "churn_features"))
    cat_wk = _stage(MF.demand_features(clean), os.path.join(work_dir, "demand_features"))
    if learned:
        if models_from is not None:
            ms = MD.load_models(models_from)
        else:
            sizes = sizes or {}
            ms = {"forecast": MD.train_forecast(weekly, sizes.get("forest_trees", MD.FOREST_TREES),
                                                sizes.get("gbt_iters", MD.GBT_ITERS)),
                  "churn": MD.train_churn(cust, sizes.get("churn_forest_trees", MD.CHURN_FOREST_TREES)),
                  "demand": MD.train_demand(cat_wk, sizes.get("forest_trees", MD.FOREST_TREES))}
            MD.save_models(ms, os.path.join(work_dir, "models"), {"forecast": weekly, "churn": cust, "demand": cat_wk})
        f, c, d = ms["forecast"], ms["churn"], ms["demand"]
        scorers = {"forecast": (f.score, f.name), "churn": (c.score, c.name), "demand": (d.score, d.name)}
    else:
        scorers = {"forecast": (MF.naive_forecast, "NaiveLag1"), "churn": (MF.naive_churn, "InactivityShare"),
                   "demand": (MF.naive_demand, "NaiveLag1")}
    (fs, fname), (cs, cname), (ds, dname) = scorers["forecast"], scorers["churn"], scorers["demand"]
    return {
        "fact_orders": M.fact_orders(clean),
        "dim_customers": M.dim_customers(clean, rfm),
        "dim_products": M.dim_products(clean),
        "dim_date": M.dim_date(clean),
        "weekly_kpis": M.weekly_kpis(clean, rfm, CE.mart_sums(cells, "week_start")),
        "campaign_performance": M.performance_by(None, "campaign_name", CE.mart_sums(cells, "campaign_name")),
        "sales_channel_performance": M.performance_by(None, "sales_channel", CE.mart_sums(cells, "sales_channel")),
        "segment_performance": M.segment_performance(None, None, CE.mart_sums(cells, "customer_segment")),
        "sales_forecast": MF.sales_forecast(weekly, fs, fname),
        "customer_churn_risk": MF.churn_risk(cust, cs),
        "product_demand_predictions": MF.demand_predictions(cat_wk, ds),
        "model_performance": MT.model_performance(fs(weekly), fname, cs(cust), cname, ds(cat_wk), dname),
    }


def run_batch(spark: SparkSession, out_dir: str, *, sf_dir: str | None = None, raw_csv: str | None = None,
              completed_status: str | None = None, learned: bool = True,
              sizes: dict | None = None, write_processed: bool = False,
              models_from: str | None = None, publish: bool = False) -> DataFrame:
    """Run everything and return the export manifest.  With ``publish`` the
    serving tables become a new version that readers switch to once it is whole
    (``files.current``).  ``models_from`` names
    the model bundles of an earlier run (its ``_work/models``): they score, and
    nothing is trained.

    ``write_processed`` also writes the processed zone (IO4): the clean
    orders and the order-level feature frame (clean + RFM + product trend +
    funnel).  The marts do not need the feature frame - joining customer and
    product features back onto every line costs two shuffles of the fact -
    so it is only produced on request."""
    if (sf_dir is None) == (raw_csv is None):
        raise ValueError("give exactly one input: sf_dir (driver tables) or raw_csv (landing folder)")
    work = os.path.join(out_dir, "_work")
    if sf_dir is not None:
        clean = S.orders_clean(spark, sf_dir)
    else:
        status = completed_status or "Completed"
        clean = _stage(FT.add_funnel_features(IO.clean_raw_csv(spark, raw_csv, status)),
                       os.path.join(work, "orders_clean"), partition_by=("year",))
    if write_processed:
        IO.write_parquet(clean, os.path.join(out_dir, "processed", "orders_clean"))
        IO.write_parquet(FT.build_features(clean), os.path.join(out_dir, "processed", "orders_features"))
    tables = serving_from_clean(clean, work, learned=learned, sizes=sizes, models_from=models_from)
    serving_dir = os.path.join(out_dir, "serving")
    if publish:
        serving_dir = IO.publish(tables, serving_dir)
    else:
        IO.export_serving(tables, serving_dir)
    return IO.export_manifest(spark, serving_dir)
