"""Stage boundaries: the clean fact and the customer table are written once
per session to the shared checkpoint folder and every mart, measure,
dashboard and model query reads them back.

This is the Spark form of the source model's processed zone: it cuts the
lineage (a lost executor re-reads Parquet instead of replaying the joins and
de-duplication), and the written files carry exact statistics that AQE uses
to pick broadcast vs sort-merge joins downstream.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from orderlens.operators import clean as C
from orderlens.operators import features as FT
from orderlens.session import ensure_checkpoint_dir, input_version
from orderlens.sources import tables as TB

_LOCK = threading.RLock()
_WRITTEN: dict[tuple[str, ...], tuple] = {}
_KEY_LOCKS: dict[tuple[str, ...], threading.RLock] = {}

#: Tables the stages come from; a change in others leaves the stages alone.
ORDER_TABLES = ("lineitem", "orders", "customer", "nation", "part")

#: Files that a task may have open in a partitioned write.
OPEN_FILES = 16

#: Columns of the fact with about a value a row.
ONCE_ONLY = ("order_id", "revenue", "margin")

_ADAPTER_ONLY = ("l_suppkey", "l_extendedprice", "l_tax", "l_shipdate")


def _stage_path(spark: SparkSession, sf_dir: str, name: str, version: str) -> str:
    digest = hashlib.sha1(f"{os.path.abspath(sf_dir)} {version}".encode()).hexdigest()[:10]
    return os.path.join(ensure_checkpoint_dir(spark), "orderlens-stages", f"{name}-{digest}")


def _key_lock(key) -> threading.RLock:
    with _LOCK:
        lock = _KEY_LOCKS.get(key)
        if lock is None:
            lock = _KEY_LOCKS[key] = threading.RLock()
        return lock


def materialize(spark: SparkSession, sf_dir: str, name: str, build,
                partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``build()`` once per (application, input, stage) and read it back
    with the schema it was written with (partition columns keep their type).
    New or rewritten input files make a new stage.  Different stages may be
    built concurrently from several threads."""
    version = input_version(spark, sf_dir, ORDER_TABLES)
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), version, name)
    with _key_lock(key):
        entry = _WRITTEN.get(key)
        if entry is None:
            path = _stage_path(spark, sf_dir, name, version)
            df = build()
            if not partition_by:
                # small serving tables: REBALANCE lets AQE coalesce the output
                # into a few files.  The partitioned fact is written straight
                # from its last shuffle (each task writes one file per year):
                # a rebalance there would be one more full shuffle of the fact.
                df.hint("rebalance").write.mode("overwrite").parquet(path)
            else:
                _write_partitioned(df, path, partition_by)
            entry = (path, df.schema)
            with _LOCK:
                _WRITTEN[key] = entry
    path, schema = entry
    out = spark.read.schema(schema).parquet(path)
    return out.select(*schema.fieldNames())


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    old = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


def _hashed_joins(spark: SparkSession) -> dict[str, str]:
    """A join hashes a side whose partitions, as measured when they are made, all
    lie within AQE's advisory size, instead of sorting the lines for it; larger
    sides are sorted and merged as before."""
    return {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold":
            spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")}


def hashed_joins(spark: SparkSession):
    """``_hashed_joins`` while a query writes; the session's, so not for several
    threads at once."""
    return _settings(spark, _hashed_joins(spark))


def _write_partitioned(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Write with a file open for each partition value (Spark sorts only the
    rows beyond ``OPEN_FILES`` values), so no task sorts its wide rows by them.
    Columns that hardly repeat get no dictionary."""
    spark = df.sparkSession
    writer = df.write.mode("overwrite").option("compression", "zstd")
    for c in ONCE_ONLY:
        writer = writer.option(f"parquet.enable.dictionary#{c}", "false")
    with _settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES), **_hashed_joins(spark)}):
        writer.partitionBy(*partition_by).parquet(path)


def materialize_frame(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate frame once to the shared folder and read it back."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), "orderlens-frames", f"{label}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_cells(df: DataFrame, label: str) -> DataFrame:
    """``materialize_frame`` of cells, whose lines join dimensions.  Sets the
    session's joins meanwhile, so not for several threads at once."""
    with hashed_joins(df.sparkSession):
        return materialize_frame(df, label)


def clean_orders_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lazy plan of the clean fact: adapter (CL1 at line grain) -> CL2-CL8 ->
    MT3 funnel columns (row-local, so they ride along for free)."""
    raw = TB.raw_orders(spark, sf_dir, dedup=True)
    cleaned = C.clean(raw, completed_status=TB.COMPLETED_STATUS_DRIVER, dedup=False,
                      drop_columns=_ADAPTER_ONLY)
    return FT.add_funnel_features(cleaned)


def orders_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean order-line fact, written partitioned by ``year`` so year
    slicers prune whole directories."""
    return materialize(spark, sf_dir, "orders_clean", lambda: clean_orders_plan(spark, sf_dir),
                       partition_by=("year",))


def customer_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one pass over the lines behind the customers' attributes."""
    return materialize(spark, sf_dir, "customer_groups", lambda: FT.customer_groups(orders_clean(spark, sf_dir)))


def product_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(spark, sf_dir, "product_groups", lambda: FT.product_groups(orders_clean(spark, sf_dir)))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT1 customer table (materialized; one row per customer with a
    completed order)."""
    return materialize(spark, sf_dir, "customer_rfm",
                       lambda: FT.customer_rfm(orders_clean(spark, sf_dir)))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and buyer sets of the fact by the marts' slicers, from one scan of it."""
    from orderlens.operators import cells as CE
    from orderlens.operators import marts as M

    return materialize(spark, sf_dir, "cells",
                       lambda: CE.build(M.completed(orders_clean(spark, sf_dir)), customers(spark, sf_dir)))


def serving(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Serving tables read by the dashboard, measure and model queries,
    written once per session (the source model's serving zone).  Builder
    queries (``weekly_kpis`` etc.) still compute from the fact; consumers
    read these small tables instead of re-scanning the fact."""
    from orderlens.operators import marts as M
    from orderlens.plans import ml_features as MF

    builders = {
        "weekly_kpis": lambda: M.weekly_kpis(orders_clean(spark, sf_dir), customers(spark, sf_dir),
                                             groups=customer_groups(spark, sf_dir)),
        "dim_customers": lambda: M.dim_customers(orders_clean(spark, sf_dir), customers(spark, sf_dir),
                                                 customer_groups(spark, sf_dir)),
        "dim_products": lambda: M.dim_products(orders_clean(spark, sf_dir), product_groups(spark, sf_dir)),
        "dim_date": lambda: M.dim_date(orders_clean(spark, sf_dir)),
        "segment_performance": lambda: M.segment_performance(orders_clean(spark, sf_dir),
                                                             customers(spark, sf_dir)),
        "forecast_features": lambda: MF.weekly_features(orders_clean(spark, sf_dir)),
        "churn_features": lambda: MF.churn_features(orders_clean(spark, sf_dir), customers(spark, sf_dir),
                                                    customer_groups(spark, sf_dir)),
        "demand_features": lambda: MF.demand_features(orders_clean(spark, sf_dir)),
    }
    return materialize(spark, sf_dir, f"serving_{name}", builders[name])


SERVING_TABLES = ("weekly_kpis", "dim_customers", "dim_products", "segment_performance",
                  "forecast_features", "churn_features", "demand_features")


def build_serving(spark: SparkSession, sf_dir: str, names=SERVING_TABLES,
                  parallel: int = len(SERVING_TABLES)) -> None:
    """Write the serving tables concurrently: independent Spark jobs submitted
    from a small thread pool share the cluster instead of running one by one."""
    from concurrent.futures import ThreadPoolExecutor

    orders_clean(spark, sf_dir)
    customers(spark, sf_dir)
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(lambda n: serving(spark, sf_dir, n), names))
