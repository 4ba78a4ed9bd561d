"""Attributes of customers and products from groups of the lines, and what the
model's queries read of the fact for them."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from orderlens.operators import features as FT
from orderlens.operators import marts as M
from orderlens.plans import ml_features as MF
from orderlens.plans import model_q as MQ
from orderlens.plans import stages as S


def same(a, b):
    assert a.dtypes == b.dtypes
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def tables(clean, groups, products):
    rfm = FT.customer_rfm(clean)
    same(M.dim_customers(clean, rfm, groups), M.dim_customers(clean, rfm))
    same(M.dim_products(clean, products), M.dim_products(clean))
    same(MF.churn_features(clean, rfm, groups), MF.churn_features(clean, rfm))
    same(M.new_customers_by_week(groups), M.new_customers_by_week(clean))


def test_groups_give_the_rows_of_the_lines(spark, sf_dir):
    cl = S.orders_clean(spark, sf_dir)
    tables(cl, FT.customer_groups(cl), FT.product_groups(cl))


def test_lines_decide_where_attributes_differ(spark):
    day = dt.date(2024, 1, 1)

    def line(order, customer, days, segment, city, name, done):
        d = day + dt.timedelta(days)
        return (order, customer, "P" + customer, d, segment, city, day, name, None if name is None else "c" + name,
                Decimal("2.50"), Decimal("5.00"), 1, done)
    clean = spark.createDataFrame([
        line("o3", "A", 0, None, "Rome", "x", True),      # missing segment: the next line's
        line("o2", "A", 1, "SMB", "Oslo", "y", False),    # first of all, not of the completed
        line("o1", "A", 2, "Gov", "Oslo", "y", True),
        line("o9", "B", 3, "Gov", "Bern", "z", True),     # same day: order id decides
        line("o10", "B", 3, "SMB", "Bern", None, True),
        line("o5", "C", 4, "SMB", "Bern", "q", True),     # one row of values
        line("o6", "C", 5, "SMB", "Bern", "q", False),
        line("o7", "D", 6, None, None, None, False)],     # nothing known, nothing completed
        "order_id string, customer_id string, product_id string, order_date date, customer_segment string, city string, "
        "customer_signup_date date, product_name string, product_category string, unit_price decimal(18,2), "
        "revenue decimal(23,2), quantity long, is_completed boolean")
    tables(clean, FT.customer_groups(clean), FT.product_groups(clean))
    got = {r[0]: r[1:] for r in M.dim_customers(clean, FT.customer_rfm(clean), FT.customer_groups(clean))
           .select("customer_id", "customer_segment", "city").collect()}
    assert got == {"A": ("SMB", "Rome"), "B": ("SMB", "Bern"), "C": ("SMB", "Bern"), "D": (None, None)}


def test_attributes_are_not_sorted_out_of_the_lines(spark, sf_dir):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    cl, rfm = S.orders_clean(spark, sf_dir), S.customers(spark, sf_dir)
    for df in (M.dim_customers(cl, rfm, S.customer_groups(spark, sf_dir)),
               M.dim_products(cl, S.product_groups(spark, sf_dir))):
        assert "SortAggregate" not in plan(df) and "min_by" not in plan(df)


def test_decimals_of_a_line_are_made_once(spark, sf_dir):
    p = S.clean_orders_plan(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    above = p[:p.index("Aggregate [l_orderkey")]
    assert "l_extendedprice" not in above and "cast(l_discount" not in above
    assert "cast(p_retailprice" not in p[:p.index("Join Inner")]


def test_model_tables_are_built_side_by_side(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(S, "build_serving", lambda spark, sf_dir, names: seen.append(tuple(names)))
    MQ.model(spark, sf_dir)
    assert seen == [MQ.MODEL_TABLES]


def test_settings_of_a_write_are_put_back(spark):
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    old = spark.conf.get(name)
    S.store_cells(spark.range(3).select(F.col("id")), "settings").count()
    assert spark.conf.get(name) == old
