"""The bundle that a query writes for itself is compressed CSV, whole and typed when read back."""

from pathlib import Path

from pyspark.sql import functions as F

import __spark_entry__ as entry
from orderlens.operators import marts as M
from orderlens.plans import exports as X
from orderlens.plans import stages as S
from orderlens.sources import files as IO


def test_bundle_is_compressed_and_whole(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(IO, "GZIP_ROWS", 1000)
    out = entry.queries()["bundle_views"](spark, sf_dir)
    folder = Path((X.export_folder(spark, sf_dir) + "-bundle").removeprefix("file:"))
    made = M.fact_orders(S.orders_clean(spark, sf_dir))
    for name in X.BUNDLE:
        assert list((folder / name).glob("part-*.csv.gz")) and not list((folder / name).glob("part-*.csv")), name
    back = IO.read_serving_csv(spark, str(folder), "fact_orders")
    # a gzip file is read by one task: bounded, however many rows a writing task holds
    assert max(r["n"] for r in back.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()) <= 1000
    want = IO.conform(made, "fact_orders")
    assert back.dtypes == want.dtypes
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()
    done = want.where("is_completed").groupBy("sales_channel", "week_start").agg(F.count("*").alias("n"))
    assert {(r.sales_channel, r.week_start, r.orders) for r in out.collect()} == {tuple(r) for r in done.collect()}
