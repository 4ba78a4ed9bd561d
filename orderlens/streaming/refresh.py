"""File-arrival triggered re-build of the KPI marts."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from orderlens.operators import features as FT
from orderlens.operators import marts as M
from orderlens.sources import files as IO


def build_marts(clean: DataFrame) -> dict[str, DataFrame]:
    clean = FT.add_funnel_features(clean)
    rfm = FT.customer_rfm(clean)
    return {
        "fact_orders": M.fact_orders(clean),
        "dim_customers": M.dim_customers(clean, rfm),
        "dim_products": M.dim_products(clean),
        "dim_date": M.dim_date(clean),
        "weekly_kpis": M.weekly_kpis(clean, rfm),
        "campaign_performance": M.performance_by(clean, "campaign_name"),
        "sales_channel_performance": M.performance_by(clean, "sales_channel"),
        "segment_performance": M.segment_performance(clean, rfm),
    }


def refresh(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str,
            completed_status: str = "Completed") -> int:
    """Process every file that landed since the last call; returns the number
    of refreshes run (0 when nothing new arrived)."""
    sample = spark.read.option("header", True).csv(landing_dir)
    stream = (spark.readStream.schema(sample.schema).option("header", True)
              .option("pathGlobFilter", "*.csv").csv(landing_dir))
    runs = []

    def rebuild(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        clean = IO.clean_raw_csv(spark, landing_dir, completed_status)
        path = os.path.join(out_dir, "orders_clean")
        IO.write_parquet(clean, path)
        marts = build_marts(spark.read.parquet(path))
        for name, df in marts.items():
            IO.write_parquet(df, os.path.join(out_dir, name))
        runs.append(batch_id)

    q = (stream.writeStream.foreachBatch(rebuild)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return len(runs)
