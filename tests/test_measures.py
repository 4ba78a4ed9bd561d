"""Measure registry: filter context, slicers, two-level distinct plan."""

import pytest
from pyspark.sql import functions as F

from orderlens.operators import measures as ME
from orderlens.plans import stages as S


@pytest.fixture(scope="module")
def star(spark, sf_dir):
    return ME.star(S.orders_clean(spark, sf_dir), S.serving(spark, sf_dir, "dim_customers"))


def test_where_equals_prefiltered(star):
    names = ["total_revenue", "active_customers", "repeat_customer_rate_model", "conversion_rate"]
    a = ME.evaluate(star, names, where=F.col("sales_channel") == "1-URGENT").first()
    b = ME.evaluate(star.filter(F.col("sales_channel") == "1-URGENT"), names).first()
    assert a == b


def test_grouped_totals_add_up(star):
    by = ME.evaluate(star, ["total_revenue", "total_orders"], by=["customer_segment"]).collect()
    tot = ME.evaluate(star, ["total_revenue", "total_orders"]).first()
    assert sum(r.total_orders for r in by) == tot.total_orders
    assert sum(r.total_revenue for r in by) == pytest.approx(tot.total_revenue)


def test_distinct_measures_plan_has_no_expand(star):
    df = ME.evaluate(star, ["active_customers", "repeat_customers_model"], by=["year"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    one = ME.evaluate(star, ["active_customers"], by=["year"]).orderBy("year").collect()
    two = df.orderBy("year").collect()
    assert [r.active_customers for r in one] == [r.active_customers for r in two]


def test_empty_context_gives_blank_sums_and_zero_ratios(star):
    r = ME.evaluate(star, ["total_revenue", "total_orders", "average_order_value"],
                    where=F.lit(False)).first()
    assert r.total_revenue is None and r.total_orders == 0 and r.average_order_value == 0.0


def test_unknown_measure(star):
    with pytest.raises(KeyError):
        ME.evaluate(star, ["no_such_measure"])
