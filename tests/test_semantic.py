"""Relationship graph, filter context and time offsets of the measure model."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.operators import semantic as SM
from orderlens.plans import model_q as MQ

D = dt.date


@pytest.fixture(scope="module")
def tiny(spark):
    """Two facts, a snowflaked dimension, blanks, a key without dimension row."""
    sales = spark.createDataFrame(
        [("a", 1, 10, D(2024, 1, 1), "x"), ("a", 2, 5, D(2024, 1, 8), "x"), ("b", 1, 7, D(2024, 1, 8), "y"),
         ("c", 3, 2, D(2024, 1, 8), None), ("zz", 1, 4, D(2024, 1, 15), "y"), (None, 2, 1, D(2024, 1, 15), "x")],
        "cust string, prod int, amount int, day date, channel string")
    cust = spark.createDataFrame([("a", "north", 1), ("b", "south", 2), ("c", None, 1), ("d", "south", 2)],
                                 "cust string, city string, region int")
    region = spark.createDataFrame([(1, "R1"), (2, "R2")], "region int, name string")
    risk = spark.createDataFrame([("a", "High"), ("b", "Low"), ("c", "High"), ("d", "High")], "cust string, level string")
    lone = spark.createDataFrame([(3,), (4,)], "n int")
    relations = (SM.Relation("sales", "cust", "cust", "cust"), SM.Relation("risk", "cust", "cust", "cust"),
                 SM.Relation("cust", "region", "region", "region"))
    leaves = {
        "amount": SM.Leaf("sales", lambda: F.sum("amount"), F.sum),
        "rows": SM.Leaf("sales", lambda: F.count(F.lit(1)), F.sum, zero=True),
        "products": SM.Leaf("sales", lambda: F.max(F.lit(True)), F.count_if, again=F.max, distinct="prod", zero=True),
        "risks": SM.Leaf("risk", lambda: F.count(F.lit(1)), F.sum, zero=True),
        "lone": SM.Leaf("lone", lambda: F.sum("n"), F.sum),
    }
    high = SM.one_of("risk.level", "High")
    measures = {
        "high_share": SM.Ratio(SM.Calc("risks", where=(high,)), SM.Calc("risks", remove=("risk.level",))),
        "high": SM.Calc("risks", where=(high,)), "high_kept": SM.Calc("risks", where=(high,), keep=True),
        "share_of_cities": SM.Ratio("amount", SM.Calc("amount", remove=("cust",))),
    }
    return SM.Model({"sales": sales, "cust": cust, "region": region, "risk": risk, "lone": lone}, relations, leaves, measures)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_filters_flow_to_the_many_side_only(tiny):
    assert rows(SM.evaluate(tiny, ["amount", "products", "risks", "lone"], ["cust.city"])) == rows_of(
        [("north", 15, 2, 1, 7), ("south", 7, 1, 2, 7), (None, 7, 3, 1, 7)])
    # a slicer of the fact leaves its dimensions' other facts whole
    assert rows(SM.evaluate(tiny, ["amount", "risks"], ["sales.channel"])) == rows_of(
        [("x", 16, 4), ("y", 11, 4), (None, 2, 4)])
    assert rows(SM.evaluate(tiny, ["amount"], ["sales.channel"], [SM.one_of("cust.city", "north", "south")])) == rows_of(
        [("x", 15), ("y", 7)])
    assert rows(SM.evaluate(tiny, ["amount", "rows"], (), [SM.one_of("cust.city", None)])) == [(2, 1)]
    assert rows(SM.evaluate(tiny, ["amount", "rows", "lone"], (), [SM.one_of("cust.city", "nowhere")])) == [(None, 0, 7)]


def rows_of(x):
    return sorted(x, key=str)


def test_two_steps_along_relations(tiny):
    assert rows(SM.evaluate(tiny, ["amount", "risks"], ["region.name"])) == rows_of(
        [("R1", 17, 2), ("R2", 7, 2), (None, 5, 0)])
    assert rows(SM.evaluate(tiny, ["amount"], {"ch": "sales.channel", "r": "region.name"},
                            [SM.one_of("region.name", "R1")])) == rows_of([("x", "R1", 15), (None, "R1", 2)])


def test_context_changes(tiny):
    got = rows(SM.evaluate(tiny, ["risks", "high", "high_kept", "high_share"], ["risk.level"]))
    # ``where`` replaces the slicer of its column, ``keep`` narrows it
    assert got == rows_of([("High", 3, 3, 3, 0.75), ("Low", 1, 3, 0, 0.75)])
    got = rows(SM.evaluate(tiny, ["high", "high_share"], ["cust.city"], [SM.one_of("risk.level", "Low")]))
    assert got == rows_of([("north", 1, 1.0), ("south", 1, 0.5), (None, 1, 1.0)])
    got = rows(SM.evaluate(tiny, ["amount", "share_of_cities"], ["cust.city"], [SM.one_of("sales.channel", "x", "y")]))
    assert got == rows_of([("north", 15, 15 / 27), ("south", 7, 7 / 27), (None, 5, 5 / 27)])


def test_no_slicer_and_errors(tiny, spark):
    assert rows(SM.evaluate(tiny, ["amount", "products", "risks", "lone", "high_share"])) == [(29, 3, 4, 7, 0.75)]
    with pytest.raises(KeyError):
        SM.evaluate(tiny, ["nothing"])
    with pytest.raises(ValueError):
        SM.evaluate(tiny, ["lone"], ["cust.city"])
    none = SM.Model({k: v.limit(0) for k, v in tiny.tables.items()}, tiny.relations, tiny.leaves, tiny.measures)
    assert rows(SM.evaluate(none, ["amount", "products"], ["cust.city"])) == []
    assert rows(SM.evaluate(none, ["amount", "products", "risks"])) == [(None, 0, 0)]


def test_time_offset(tiny):
    got = rows(SM.shifted(tiny, ["amount"], "sales.day", -7, ["sales.channel"]))
    assert got == rows_of([("x", D(2024, 1, 1), 10, None), ("x", D(2024, 1, 8), 5, 10), ("x", D(2024, 1, 15), 1, 5),
                           ("y", D(2024, 1, 8), 7, None), ("y", D(2024, 1, 15), 4, 7), (None, D(2024, 1, 8), 2, None)])
    last = rows(SM.shifted(tiny, ["amount"], "sales.day", -7, ["sales.channel"], last_by="amount"))
    assert last == rows_of([("x", D(2024, 1, 15), 1, 5), ("y", D(2024, 1, 15), 4, 7), (None, D(2024, 1, 8), 2, None)])
    assert [tuple(r)[1:] for r in SM.shifted(tiny, ["rows"], "sales.day", -7, last_by="rows").collect()] == [(2, 3)]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_no_line_grain_join(spark, sf_dir):
    """Every join of the fact reads an aggregate of it."""
    m = MQ.model(spark, sf_dir)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    for by in (["dim_customers.city"], ["dim_products.product_category"], ["dim_date.year", "dim_date.month"]):
        plan = _plan(SM.evaluate(m, MQ.FACT_MEASURES, by))
        depth = [len(x) - len(x.lstrip(" :+-")) for x in plan]
        scans = [i for i, x in enumerate(plan) if "is_completed" in x and "Relation" in x]
        assert len(scans) == 1
        above = []
        level = depth[scans[0]]
        for i in range(scans[0], -1, -1):
            if depth[i] < level:
                above.append(plan[i].lstrip(" :+-"))
                level = depth[i]
        first_join = next(i for i, x in enumerate(above) if x.startswith("Join"))
        assert any(x.startswith("Aggregate") for x in above[:first_join])
        assert not any("Expand" in x for x in plan)


def test_cells_of_several_contexts_are_made_once(spark, sf_dir):
    """A measure and its share of all products are two contexts of the fact."""
    m = MQ.model(spark, sf_dir)
    ask = (["total_revenue", "active_customers", "revenue_share_of_all_products"], ["dim_products.product_category"])
    scans = lambda df: sum("is_completed" in x and "Relation" in x for x in _plan(df))
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    bare = SM.Model(m.tables, m.relations, m.leaves, m.measures)
    once, each = SM.evaluate(m, *ask), SM.evaluate(bare, *ask)
    assert scans(each) == 2 and scans(once) == 0  # the stored cells alone
    assert rows(once) == rows(each)


def test_date_filter_prunes_partitions(spark, sf_dir):
    out = SM.evaluate(MQ.model(spark, sf_dir), ["total_orders"], ["dim_date.quarter"], [SM.one_of("dim_date.year", 1995)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert any("PartitionFilters" in x and "year" in x.split("PartitionFilters")[1].split("PushedFilters")[0]
               and "subquery" in x.lower() for x in plan.splitlines())
    want = MQ.S.orders_clean(spark, sf_dir).where("year = 1995").groupBy("quarter").agg(
        F.count_if("is_completed").alias("n"))
    assert rows(out) == rows(want)
