"""What the shared steps move: shuffles by their keys, before and beside the rows."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from orderlens.plans import catalog as CT
from orderlens.plans import models as ML
from orderlens.plans import stages as S
from orderlens.sources import files as IO
from orderlens.sources import tables as TB


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_dealt_by_order_once(spark, sf_dir):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(S.clean_orders_plan(spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    dealt = [x for x in p.splitlines() if "Exchange hashpartitioning(l_orderkey" in x]
    # one shuffle for the copies and the header join
    assert len(dealt) == 1 and "l_linenumber" not in dealt[0], dealt
    # what follows from a key is made above the shuffles, not sent through them
    assert p.index("AS product_id") < p.index("Exchange")


def test_hot_order_is_combined_before_its_shuffle(spark, sf_dir, monkeypatch):
    want = TB.raw_orders(spark, sf_dir)
    monkeypatch.setattr(TB, "HOT_ORDER_LINES", 1)
    got = TB.raw_orders(spark, sf_dir)
    assert "hashpartitioning(l_orderkey" in plan(got) and any(
        "Exchange" in x and "l_linenumber" in x for x in plan(got).splitlines())
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_orders_are_counted_in_full_buckets_only(spark, sf_dir, monkeypatch):
    lineitem = TB.read_table(spark, sf_dir, "lineitem")
    most = lineitem.groupBy("l_orderkey").count().agg(F.max("count")).first()[0]
    for buckets in (1, TB.ORDER_BUCKETS):  # one bucket holds every order and says nothing of them
        monkeypatch.setattr(TB, "ORDER_BUCKETS", buckets)
        for bound, hot in ((most - 1, True), (most, False)):
            monkeypatch.setattr(TB, "HOT_ORDER_LINES", bound)
            assert TB._has_hot_order(lineitem) is hot
    assert TB._has_hot_order(lineitem.limit(0)) is False


def test_customer_text_is_made_above_the_shuffles(spark, sf_dir):
    assert dict(TB.order_header(spark, sf_dir).dtypes)["o_custkey"] == "bigint"
    assert dict(TB.raw_orders(spark, sf_dir).dtypes)["customer_id"] == "string"


def test_fit_rows_are_spread_over_the_cores(spark, monkeypatch):
    df = spark.range(1000).coalesce(1).select(F.col("id").cast("string").alias("k"), "id")
    assert ML.spread(df, "k", 1000) is df  # few rows stay as they are
    monkeypatch.setattr(ML, "FIT_ROWS", 10)
    cores = spark.sparkContext.defaultParallelism
    for n, tasks in ((1000, min(100, 2 * cores)), (30, min(3, 2 * cores)), (19, 1)):
        assert ML.spread(df, "k", n).rdd.getNumPartitions() == tasks
    got, again = (ML.spread(df, "k", 1000).withColumn("p", F.spark_partition_id()).collect() for _ in range(2))
    assert got == again and sorted(r.id for r in got) == list(range(1000))


def test_dirty_landing_is_built_without_a_sort(spark, sf_dir, tmp_path):
    made = CT._dirty_rows(spark, sf_dir)
    assert "rangepartitioning" not in plan(made) and "Union" not in plan(made)
    IO.write_csv(made, str(tmp_path / "landing"), compressed=True)
    back = IO.read_raw_csv(spark, str(tmp_path / "landing"))
    # a later copy lies behind its first in the file order, whatever the first was spoiled to
    both = back.groupBy("order_id").agg(F.count("*").alias("n"), F.max_by("quantity", IO.FILE_POSITION).alias("last"),
                                        F.min_by("quantity", IO.FILE_POSITION).alias("first")).where("n > 1")
    assert both.count() > 0 and both.where("n > 2 OR last <> '999' OR first = '999'").count() == 0


def test_file_position_keeps_the_order_of_paths(spark, tmp_path):
    for name in ("b 1", "a", "b"):
        (tmp_path / f"part-{name}.csv").write_text("order_id,x\n1,1\n2,2\n")
    got = IO.read_raw_csv(spark, str(tmp_path)).select("*", F.col("_metadata.file_path").alias("path"))
    by_place = [(r.path, r.order_id) for r in got.orderBy(IO.FILE_POSITION).collect()]
    assert by_place == sorted(by_place) and len(by_place) == 6
    assert max(len(r[IO.FILE_POSITION].f) for r in got.collect()) < 12  # what all paths begin with is left out


def test_compressed_csv_ends_a_file_after_so_many_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(IO, "GZIP_ROWS", 100)
    df = spark.range(950).coalesce(1).selectExpr("CAST(id AS string) AS product_id", "'x' AS product_name",
                                                 "'y' AS product_category", "1.5D AS unit_price")
    root = str(tmp_path / "serving")
    IO.publish({"dim_products": df}, root)
    files = list((tmp_path / "serving").rglob("*.csv.gz"))
    assert len(files) == 10 and not list((tmp_path / "serving").rglob("part-*.csv"))
    back = IO.read_serving_csv(spark, IO.current(spark, root), "dim_products")
    assert back.exceptAll(df).isEmpty() and back.count() == 950
    IO.export_serving({"dim_products": df}, str(tmp_path / "plain"))  # the export for other readers stays plain text
    assert list((tmp_path / "plain").rglob("part-*.csv")) and not list((tmp_path / "plain").rglob("*.gz"))


def test_partitioned_write_sorts_no_rows(spark, sf_dir, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(name)
    df = spark.range(400).select(F.col("id").alias("v"), (F.col("id") % 40).alias("year"))
    S._write_partitioned(df, str(tmp_path / "t"), ("year",))  # more values than open files
    assert spark.conf.get(name) == old
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 400 and back.where("v % 40 <> year").count() == 0


def test_cells_meet_before_their_bitmaps_are_made(spark, sf_dir):
    from orderlens.operators import cells as CE
    from orderlens.operators import marts as M
    p = plan(CE.build(M.completed(S.orders_clean(spark, sf_dir)), S.customers(spark, sf_dir)))
    sent = p[:p.index("partial_bitmap_construct_agg")]
    assert "Exchange" not in sent, "bitmaps of each task and cell go through a shuffle"


def test_a_query_fits_only_the_models_it_reads(spark, sf_dir, monkeypatch):
    from orderlens.plans import models as ML
    monkeypatch.setattr(ML, "_FITTED", {})
    fit, saved = [], []
    for n in ML.MODEL_NAMES:
        monkeypatch.setattr(ML, f"train_{n}", lambda *a, n=n, **k: fit.append(n) or n)
    monkeypatch.setattr(ML, "save_models", lambda models, folder, frames: saved.append(sorted(frames)))
    assert ML.fitted_models(spark, sf_dir, ["forecast"]) == {"forecast": "forecast"}
    assert fit == ["forecast"] and saved == [["forecast"]]
    ML.fitted_models(spark, sf_dir)
    assert sorted(fit) == ["churn", "demand", "forecast"] and saved[1:] == [["churn", "demand"]]


def test_landing_read_sends_what_is_read_further(spark, tmp_path):
    from orderlens.sources import files as IO
    folder = str(tmp_path / "in")
    spark.createDataFrame(
        [("a", "c", "p", "2025-01-06", "1", "2.0", "0.1", "NaN", "1", "Completed", "n"),
         ("b", "c", "p", "2025-01-06", "1", "2.0", "0.1", "3.5", "1", "Completed", "n")],
        "order_id string, customer_id string, product_id string, order_date string, quantity string, unit_price string, "
        "discount string, revenue string, margin string, order_status string, product_name string",
    ).coalesce(1).write.option("header", True).csv(folder)
    columns = ("order_id", "week_start", "revenue", "is_completed")
    whole, few = IO.clean_raw_csv(spark, folder), IO.clean_raw_csv(spark, folder, columns=columns)
    assert few.select(*columns).collect() == whole.select(*columns).collect() and whole.count() == 1
    p = plan(few.select(*columns))
    assert "product_name" not in p[:p.index("Scan csv")].split("partial_min")[0]
