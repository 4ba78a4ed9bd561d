"""Physical-plan checks: what the optimizer must produce for scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from orderlens.plans import dashboard as D
from orderlens.plans import stages as S
from orderlens.sources import tables as TB

# queries that write files when called (checked elsewhere)
SIDE_EFFECTS = {"csv_landing_clean", "export_manifest"}
PLANNED = sorted(n for n in entry.oracle_sql() if n not in SIDE_EFFECTS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_udf_no_cross_join(spark, sf_dir, name):
    p = plan(entry.queries()[name](spark, sf_dir))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad}"


def test_year_slicer_prunes_partitions(spark, sf_dir):
    cl = S.orders_clean(spark, sf_dir)
    df = D.revenue_by(cl, "customer_segment", years=[1997])
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in p and "= 1997)" in p


def test_projection_and_filter_reach_the_scan(spark, sf_dir):
    cl = S.orders_clean(spark, sf_dir)
    df = cl.filter(F.col("is_completed")).groupBy("week_start").agg(F.sum("revenue"))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(is_completed), EqualTo(is_completed,true)" in p
    assert "ReadSchema: struct<revenue:" in p and "customer_id" not in p.split("ReadSchema")[1]


def test_dedup_combines_map_side(spark, sf_dir):
    lines = TB._line_level(TB.read_table(spark, sf_dir, "lineitem"))
    p = plan(TB.dedup_lines(lines))
    assert "partial_min" in p
    assert p.index("partial_min") > p.index("Exchange hashpartitioning")


def test_only_fixed_small_sides_are_force_broadcast(spark, sf_dir):
    # nation (25 rows) is the single explicit broadcast of the adapter
    p = TB.raw_orders(spark, sf_dir)._jdf.queryExecution().logical().toString()
    assert p.count("broadcast") <= 1
