"""Stored cells, audit by rule, atomic publishing, fitted encoders, stage versions."""

import os
import shutil

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from orderlens.operators import cells as CE
from orderlens.operators import clean as C
from orderlens.operators import marts as M
from orderlens.plans import ml_features as MF
from orderlens.plans import ml_queries as MQ
from orderlens.plans import models as MD
from orderlens.plans import stages as S
from orderlens.session import input_version
from orderlens.sources import files as IO


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- cells ------------------------------------------------------------------

@pytest.mark.parametrize("by", [[], ["customer_segment"], ["sales_channel", "week_start"], ["campaign_name"]])
def test_distinct_counts_from_cells(spark, sf_dir, by):
    done = M.completed(S.orders_clean(spark, sf_dir))
    want = done.groupBy(*by).agg(F.count_distinct("customer_id").alias("n"), F.count(F.lit(1)).alias("orders"),
                                 F.sum("revenue").alias("rev"))
    got = CE.roll_up(S.cells(spark, sf_dir), by).select(*by, "unique_customers", "total_orders", "_rev")
    assert rows(got) == rows(want)


def test_cells_under_a_filter_read_no_fact(spark, sf_dir):
    cells = S.cells(spark, sf_dir)
    got = CE.roll_up(cells, ["sales_channel"], F.col("customer_segment").isin("BUILDING", "MACHINERY"), ["customer_segment"])
    done = M.completed(S.orders_clean(spark, sf_dir)).where(F.col("customer_segment").isin("BUILDING", "MACHINERY"))
    assert rows(got.select("sales_channel", "unique_customers")) == rows(
        done.groupBy("sales_channel").agg(F.count_distinct("customer_id").alias("n")))
    files = {os.path.basename(os.path.dirname(f)) for f in got.inputFiles()}
    assert files and all(f.startswith("cells-") for f in files)


def test_cells_of_edge_rows(spark):
    schema = ("order_id string, customer_id string, a string, b string, revenue decimal(18,2), quantity int, margin decimal(18,2), "
              "discount decimal(4,2), visits int, cart_additions int, completed_orders int")
    one = lambda i, c, a, b: (f"o{i}", c, a, b, None, 1, None, None, 1, 1, 1)
    many = [one(i, f"c{i % 4000}" if i % 3 else "hot", f"a{i % 2}", None) for i in range(9000)]
    lines = spark.createDataFrame([*many, one(1, None, "a0", "b"), one(2, "c1", None, "b")], schema)
    customers = lines.select("customer_id").distinct().withColumn("is_repeat_customer", F.col("customer_id") == "hot")
    sets = [("a", "b"), ("b",)]
    cells = CE.build(lines, customers, sets)
    for by in (["a"], ["b"], []):
        want = lines.groupBy(*by).agg(F.count_distinct("customer_id").alias("n"),
                                      F.count_distinct(F.when(F.col("customer_id") == "hot", F.lit(1))).alias("r"),
                                      F.count("order_id").alias("o"))
        got = CE.roll_up(cells, by, key_sets=sets).select(*by, "unique_customers", "repeat_customers", "total_orders")
        assert rows(got) == rows(want)
    assert rows(CE.roll_up(CE.build(lines.limit(0), customers.limit(0), sets), ["a"], key_sets=sets)) == []
    numbers = CE.customer_numbers(customers)
    assert numbers.count() == numbers.select("number").distinct().count() == customers.where("customer_id IS NOT NULL").count()


def test_routing():
    assert CE.route(["campaign_name"]) == 1 and CE.route(["sales_channel"]) == 0
    assert CE.route([], [("a", "b"), ("c",)]) == 1
    with pytest.raises(ValueError):
        CE.route(["campaign_name", "sales_channel"])


# --- audit by rule ----------------------------------------------------------

def test_audit_by_rule(spark):
    fields = "order_id string, customer_id string, product_id string, order_date string, quantity string, unit_price string, " \
             "discount string, revenue string, margin string, order_status string, pos int"
    good = ("o1", "c", "p", "2024-01-02", "1", "2", "0.1", "3", "1", "Completed")
    raw = [(*good, 1), (*good, 2), ("o2", *good[1:4], "-1", *good[5:], 3), ("o3", *good[1:6], None, *good[7:], 4),
           ("o4", *good[1:6], "1.5", *good[7:], 5), ("o5", None, *good[2:], 6), ("o6", *good[1:4], "x", "2", "7", *good[7:], 7),
           ("o7", None, *good[2:6], "9", *good[7:], 8), (None, *good[1:], 9)]
    df = spark.createDataFrame(raw, fields)
    out, counts = C.clean_with_audit(df, dedup_order=["pos"], drop_columns=["pos"])
    plain = C.clean(df, dedup_order=["pos"], drop_columns=["pos"])
    assert out.schema == plain.schema and rows(out) == rows(plain)
    got = counts()
    assert got == {"rows_before": 9, "removed_duplicate": 1, "removed_not_positive": 2, "removed_discount_out_of_range": 2,
                   "removed_missing_key": 2, "discount_filled": 1, "rows_after": 2}
    empty, counts = C.clean_with_audit(df.limit(0), dedup_order=["pos"], drop_columns=["pos"])
    assert empty.collect() == [] and set(counts().values()) == {0}


# --- publishing -------------------------------------------------------------

def _bundle(spark, n):
    return {"dim_products": spark.range(n).select(
        F.col("id").cast("string").alias("product_id"), F.lit("x").alias("product_name"), F.lit("y").alias("product_category"),
        F.lit(1.0).alias("unit_price"))}


def _count(spark, root):
    return IO.read_serving_csv(spark, IO.current(spark, root), "dim_products").count()


def test_publish_switches_whole_versions_only(spark, tmp_path):
    root = str(tmp_path / "serving")
    assert IO.current(spark, root) is None
    IO.publish(_bundle(spark, 3), root)
    assert _count(spark, root) == 3

    def broken(tables, folder):
        IO.export_serving(tables, folder)
        raise OSError("disk full")

    with pytest.raises(OSError):
        IO.publish(_bundle(spark, 5), root, write=broken)
    assert _count(spark, root) == 3
    with pytest.raises(IO.PublishError):  # a table is not there
        IO.publish(_bundle(spark, 5), root, write=lambda tables, folder: None)
    assert _count(spark, root) == 3
    first = IO.current(spark, root)
    IO.publish(_bundle(spark, 7), root)
    assert _count(spark, root) == 7 and IO.current(spark, root) != first
    assert IO.read_serving_csv(spark, first, "dim_products").count() == 3  # a reader of the old one is not disturbed
    IO.publish(_bundle(spark, 8), root)
    gone = IO.drop_old_versions(spark, root, keep=2)
    assert os.path.basename(first) in gone and not os.path.exists(first) and _count(spark, root) == 8
    assert len(os.listdir(os.path.join(root, "versions"))) == 2


# --- encoder ----------------------------------------------------------------

def test_scoring_without_a_label_keeps_codes(spark, sf_dir, tmp_path):
    """A frame that lacks the first segment scores as before, though its own
    codes would all shift; an unseen one gets the next code."""
    cust = MQ.churn_frame(spark, sf_dir)
    fitted = MD.with_encoder("churn", MD.train_churn(cust, forest_trees=3), cust)
    MD.save_model(fitted, str(tmp_path / "churn"), fitted.labels)
    again = MD.load_model(str(tmp_path / "churn"))
    again.encoder = MD.ENCODERS["churn"]
    whole = {r.customer_id: r.probability_1 for r in again.score(cust).collect()}
    part = MF.label_encode(cust.drop("segment_enc").where(F.col("customer_segment") > fitted.labels[0]),
                           "customer_segment", "segment_enc")
    shifted = {r.customer_segment: r.segment_enc for r in part.select("customer_segment", "segment_enc").distinct().collect()}
    assert shifted[fitted.labels[1]] == 0
    got = {r.customer_id: r.probability_1 for r in again.score(part).collect()}
    assert got and all(got[c] == whole[c] for c in got)
    odd = spark.createDataFrame([("BUILDING",), ("new",), (None,)], "customer_segment string")
    codes = dict(rows(MF.encode_with(odd, "customer_segment", "code", ["AUTO", "BUILDING"])))
    assert codes == {"BUILDING": 1, "new": 2, None: None}


def test_models_score_after_an_observed_plan(spark, sf_dir):
    """Observing makes the session unfit for tasks; a fitted model must not carry it."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    fitted = MD.train_churn(MQ.churn_frame(spark, sf_dir), forest_trees=3)
    assert fitted.score(MQ.churn_frame(spark, sf_dir)).where("probability_1 BETWEEN 0 AND 1").count() > 0


# --- stage versions ---------------------------------------------------------

def test_other_tables_leave_the_stages_alone(spark, sf_dir, tmp_path):
    for name in S.ORDER_TABLES:
        shutil.copyfile(f"{sf_dir}/{name}.parquet", tmp_path / f"{name}.parquet")
    before = input_version(spark, str(tmp_path), S.ORDER_TABLES)
    shutil.copyfile(f"{sf_dir}/documents.parquet", tmp_path / "documents.parquet")
    assert input_version(spark, str(tmp_path), S.ORDER_TABLES) == before
    assert input_version(spark, str(tmp_path)) != before
