"""The clean CSV landing: its file order comes from the shuffle by order, without a sort across tasks."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from orderlens.plans import catalog as CT
from orderlens.sources import files as IO
from orderlens.sources import tables as TB


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    old = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
#: Any partition of two blocks counts as skewed.
SPLIT = {**NO_BROADCAST, "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.01",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1kb",
         "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def test_clean_landing_is_built_without_a_sort_across_tasks(spark, sf_dir, monkeypatch):
    landed = []
    monkeypatch.setattr(CT, "_landed", lambda rows, *a: landed.append(rows) or rows)
    with settings(spark, **NO_BROADCAST):
        CT.q_csv_landing_clean(spark, sf_dir)
        p = plan(landed[0])
    assert "rangepartitioning" not in p
    dealt = [x for x in p.splitlines() if "Exchange hashpartitioning(l_orderkey" in x]
    assert len(dealt) == 1, dealt  # the shuffle of the header join is that of the file order
    assert p.index("AS product_id") < p.index("Exchange")  # what follows from a key is made above it
    assert landed[0].columns == list(TB.RAW_COLUMNS)


@pytest.mark.parametrize("how", ["plain", "skewed", "hot"])
def test_files_hold_copies_in_keep_first_order(spark, sf_dir, tmp_path, monkeypatch, how):
    want = TB.raw_orders(spark, sf_dir, dedup=False).select(*TB.RAW_COLUMNS)
    first = TB.raw_orders(spark, sf_dir).select(*TB.RAW_COLUMNS)
    with settings(spark, **(SPLIT if how == "skewed" else {})):
        if how == "hot":
            monkeypatch.setattr(TB, "HOT_ORDER_LINES", 1)
        made = TB.raw_orders_in_keep_first_order(spark, sf_dir).select(*TB.RAW_COLUMNS)
        assert ("rangepartitioning" in plan(made)) == (how == "hot")
        IO.write_csv(made, str(tmp_path / "landing"), compressed=True)
    text = [F.col(c).cast("string").alias(c) for c in TB.RAW_COLUMNS]
    back = IO.read_raw_csv(spark, str(tmp_path / "landing"))
    rows = back.select(*TB.RAW_COLUMNS)
    assert rows.exceptAll(want.select(*text)).isEmpty() and want.select(*text).exceptAll(rows).isEmpty()
    # the first of the file is the first of the keep-first order
    got = (back.groupBy("order_id").agg(F.min_by(F.struct(*TB.RAW_COLUMNS), IO.FILE_POSITION).alias("r"))
           .select("r.*"))
    assert got.exceptAll(first.select(*text)).isEmpty() and first.select(*text).exceptAll(got).isEmpty()
    assert rows.count() > first.count()


def test_numbers_go_through_keep_first_parsed(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame(
        [("a", "c", "p", "2025-01-06", "1", "2.0", None, "3.50", "inf", "3.0", "Completed"),
         ("a", "c", "p", "2025-01-06", "9", "2.0", "0.1", "9", "1", "3", "Completed"),
         ("b", "c", "p", "2025-01-06", "1", "2.0d", "0.1", "3.5", "1", "x", "Completed")],
        "order_id string, customer_id string, product_id string, order_date string, quantity string, unit_price string, "
        "discount string, revenue string, margin string, visits string, order_status string",
    ).coalesce(1).write.option("header", True).csv(folder)
    out = IO.clean_raw_csv(spark, folder, uncut=True)
    p = plan(out)
    assert "RLIKE" in p and "RLIKE" not in p[:p.index("Exchange")], "numbers are sent as text"
    (row,) = out.collect()
    assert (row.order_id, row.quantity, row.discount, row.revenue, row.margin, row.visits) == ("a", 1, 0, 3.5, None, 3)
    assert (row.revenue_uncut, row.margin_uncut, row.discount_uncut) == (3.5, float("inf"), None)


def test_file_position_leaves_out_what_paths_end_with(spark, tmp_path):
    assert IO._alike(["x/a", "x/b1"]) == ("x/", "")  # another length: the end may decide the order
    assert IO._alike(["x/1z", "x/2z"]) == ("x/", "z") and IO._alike(["x/1z"]) == ("x/1z", "")
    for name in ("00", "01", "02", "10"):
        (tmp_path / f"part-{name}-0123456789.csv").write_text("order_id,x\n1,1\n2,2\n")
    got = IO.read_raw_csv(spark, str(tmp_path)).select("*", F.col("_metadata.file_path").alias("path"))
    by_place = [(r.path, r.order_id) for r in got.orderBy(IO.FILE_POSITION).collect()]
    assert by_place == sorted(by_place) and len(by_place) == 8
    assert sorted({r[IO.FILE_POSITION].f for r in got.collect()}) == ["00", "01", "02", "10"]
