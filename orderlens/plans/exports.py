"""Serving-table export and typed reload (IO5-IO8) as registered queries."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

from orderlens.operators import marts as M
from orderlens.plans import metrics_q as MTQ
from orderlens.plans import ml_queries as MQ
from orderlens.plans import oracle as O
from orderlens.plans import stages as S
from orderlens.plans.catalog import register
from orderlens.plans.dashboard import dsql
from orderlens.session import ensure_checkpoint_dir
from orderlens.sources import files as IO


def serving_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The 12 serving tables (prediction tables from the stand-in scorers)."""
    cl = S.orders_clean(spark, sf_dir)
    rfm = S.customers(spark, sf_dir)
    return {
        "fact_orders": M.fact_orders(cl),
        "dim_customers": M.dim_customers(cl, rfm),
        "dim_products": M.dim_products(cl),
        "dim_date": M.dim_date(cl),
        "weekly_kpis": M.weekly_kpis(cl, rfm),
        "campaign_performance": M.performance_by(cl, "campaign_name"),
        "sales_channel_performance": M.performance_by(cl, "sales_channel"),
        "segment_performance": M.segment_performance(cl, rfm),
        "sales_forecast": MQ.naive_sales_forecast(spark, sf_dir),
        "customer_churn_risk": MQ.naive_churn_risk(spark, sf_dir),
        "product_demand_predictions": MQ.naive_demand_predictions(spark, sf_dir),
        "model_performance": MTQ.naive_model_performance(spark, sf_dir),
    }


def export_folder(spark: SparkSession, sf_dir: str) -> str:
    digest = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:10]
    return os.path.join(ensure_checkpoint_dir(spark), "orderlens-export", digest)


def _counts_sql() -> str:
    sources = {
        "fact_orders": "cl", "dim_customers": "dimc", "dim_products": "(SELECT DISTINCT product_id FROM cl)",
        "dim_date": "(SELECT unnest(generate_series(min(order_date), max(order_date) + INTERVAL 42 DAY, "
                    "INTERVAL 1 DAY)) FROM cl)",
        "weekly_kpis": "weekly", "campaign_performance": "(SELECT DISTINCT campaign_name FROM comp "
                                                         "WHERE campaign_name IS NOT NULL)",
        "sales_channel_performance": "(SELECT DISTINCT sales_channel FROM comp WHERE sales_channel IS NOT NULL)",
        "segment_performance": "(SELECT DISTINCT customer_segment FROM comp WHERE customer_segment IS NOT NULL)",
        "sales_forecast": "sf", "customer_churn_risk": "cr", "product_demand_predictions": "dp",
        "model_performance": "range(8)"}
    return dsql("\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"table\", 'OK' AS status, count(*) AS rows FROM {src} x" for t, src in sources.items()))


@register("export_manifest", _counts_sql())
def q_export_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO5 + IO8: write the serving tables as CSV, then list expected vs
    present with row counts (the size depends on the writer and is left out)."""
    folder = export_folder(spark, sf_dir)
    IO.export_serving(serving_tables(spark, sf_dir), folder)
    return IO.export_manifest(spark, folder).select("table", "status", "rows")


@register("published_manifest", _counts_sql())
def q_published_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO4 / IO5 / IO8 as one switch: the tables are written as a version, which
    readers see once its manifest is whole."""
    root = export_folder(spark, sf_dir) + "-published"
    IO.publish(serving_tables(spark, sf_dir), root)
    return IO.export_manifest(spark, IO.current(spark, root)).select("table", "status", "rows")


BUNDLE = ("fact_orders", "weekly_kpis")


def _bundle(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    """The named tables as CSV, read back at once by the same session alone, so
    compressed: as plain text the fact is most of what such a query writes."""
    folder = export_folder(spark, sf_dir) + "-bundle"
    made = {"fact_orders": lambda: M.fact_orders(S.orders_clean(spark, sf_dir)),
            "weekly_kpis": lambda: M.weekly_kpis(S.orders_clean(spark, sf_dir), S.customers(spark, sf_dir))}
    IO.export_serving({n: made[n]() for n in names}, folder, compressed=True)
    return IO.load_bundle(spark, folder, names)


@register("bundle_weekly", dsql("SELECT * FROM weekly"))
def q_bundle_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO5 + IO6: the weekly mart written as CSV and read back with its types."""
    return _bundle(spark, sf_dir, ["weekly_kpis"])["weekly_kpis"]


@register("bundle_views", dsql(f"""
SELECT f.sales_channel, f.week_start, f.orders, {O.rnd('f.revenue', 2)} AS revenue, w.total_orders AS week_orders
FROM (SELECT sales_channel, week_start, count(*) AS orders, CAST(sum(revenue) AS DOUBLE) AS revenue
      FROM comp GROUP BY 1, 2) f JOIN weekly w ON w.week_start = f.week_start"""))
def q_bundle_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO7: SQL over the temp views of the loaded bundle."""
    _bundle(spark, sf_dir, BUNDLE)
    return spark.sql("""
SELECT f.sales_channel, f.week_start, f.orders, rint(f.revenue * 100) / 100 AS revenue, w.total_orders AS week_orders
FROM (SELECT sales_channel, week_start, count(*) AS orders, sum(revenue) AS revenue
      FROM fact_orders WHERE is_completed GROUP BY sales_channel, week_start) f
JOIN weekly_kpis w ON w.week_start = f.week_start""")
