"""Hot keys: one customer / one order line holding a large share of rows."""

import datetime as dt

from pyspark.sql import functions as F

from orderlens.operators import clean as C
from orderlens.operators import measures as ME


def _fact(spark, n=6000, hot_share=3):
    rows = []
    for i in range(n):
        cust = "HOT" if i % hot_share == 0 else f"C{i % 200}"
        rows.append((f"O{i}", cust, "SMB", dt.date(2025, 1, 1 + i % 28), 10.0 + i % 7, True, 1, 10, 2, 1))
    return spark.createDataFrame(
        rows, "order_id string, customer_id string, customer_segment string, order_date date, "
              "revenue double, is_completed boolean, quantity int, visits int, cart_additions int, "
              "completed_orders int").withColumn("margin", F.col("revenue") * 0.3)


def test_star_measures_reduce_lines_before_the_customer_join(spark):
    """No order line crosses the customer join: what it reads is at most a row
    per (slicers, customer), however many lines the hot customer has."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = _fact(spark).repartition(8)
        dim = spark.createDataFrame([("HOT", True)] + [(f"C{i}", i % 2 == 0) for i in range(200)],
                                    "customer_id string, is_repeat_customer boolean")
        for by in ([], ["customer_segment"]):
            out = ME.evaluate(ME.star(fact, dim), ["total_revenue", "total_orders", "active_customers",
                                                   "repeat_customers_model"], by=by)
            row = out.first()
            assert (row.total_orders, row.active_customers, row.repeat_customers_model) == (6000, 201, 101)
            plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
            depth = [len(x) - len(x.lstrip(" :+-")) for x in plan]
            join = next(i for i, x in enumerate(plan) if "Join LeftOuter" in x)
            left = next(i for i in range(join + 1, len(plan)) if "Aggregate" in plan[i])
            assert depth[left] > depth[join] and "customer_id" in plan[left]
            assert not any("Expand" in x for x in plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dedup_with_hot_group_of_copies(spark):
    rows = [("K", i % 5, f"v{i % 5}") for i in range(3000)] + [(f"k{i}", 0, "x") for i in range(6000)]
    df = spark.createDataFrame(rows, "order_id string, pos int, v string").repartition(8)
    out = C.dedup_keep_first(df, "order_id", ["pos"])
    got = {r.order_id: r.v for r in out.collect()}
    assert len(got) == 6001 and got["K"] == "v0"
