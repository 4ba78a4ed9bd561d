import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from orderlens.operators import clean as C
from orderlens.sources import files as IO

HEADER = ("order_id,customer_id,customer_segment,order_date,customer_signup_date,last_purchase_date,"
          "product_id,product_category,product_name,quantity,unit_price,discount,revenue,margin,city,"
          "sales_channel,campaign_name,payment_method,visits,cart_additions,completed_orders,order_status")


def _line(oid, qty="2", price="10.0", disc="0.1", rev="18.0", status="Completed", cust="C1", date="2025-03-03"):
    return (f"{oid},{cust},SMB,{date},2025-03-01,{date},P1,Software,CRM,{qty},{price},{disc},{rev},5.0,"
            f"Leeds,Direct,Promo,Card,10,2,1,{status}")


def test_csv_landing_zone_clean(spark, tmp_path):
    lines = [HEADER,
             _line("O1", rev="-5"),             # first copy invalid -> whole id dropped (keep-first then filter)
             _line("O1"),
             _line("O2"),
             _line("O2", qty="3"),              # later duplicate ignored
             _line("O3", qty="abc"),            # bad number -> dropped
             _line("O4", rev="NaN"),            # NaN -> missing -> dropped
             _line("O5", disc=""),              # missing discount -> 0, kept
             _line("O6", disc="1.5"),           # out of range
             _line("O7", cust=""),              # missing key
             _line("O8", qty="1.0d"),           # java suffix is not a number
             _line("O9", status="Refunded"),    # kept, not completed
             _line("O10", date="not a date")]   # missing key after date parse
    p = tmp_path / "orders_raw.csv"
    p.write_text("\n".join(lines) + "\n")
    out = IO.clean_raw_csv(spark, str(p)).orderBy("order_id").collect()
    ids = [r.order_id for r in out]
    assert ids == ["O2", "O5", "O9"]
    o2 = out[0]
    assert o2.quantity == 2.0 and o2.is_completed and o2.week_start == dt.date(2025, 3, 3)
    assert out[1].discount == 0.0
    assert out[2].is_completed is False
    assert (o2.year, o2.month, o2.quarter, o2.week_number) == (2025, 3, 1, 10)


def test_missing_input_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        IO.read_raw_csv(spark, str(tmp_path / "nope.csv")).count()


def test_dedup_keep_first_total_order(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), ("a", 2, "w")],
                               "order_id string, pos int, v string")
    got = {r.order_id: r.v for r in C.dedup_keep_first(df, "order_id", ["pos"]).collect()}
    assert got == {"a": "y", "b": "z"}


def test_clean_requires_order(spark):
    df = spark.createDataFrame([("a",)], "order_id string")
    with pytest.raises(ValueError):
        C.clean(df)


def test_nan_never_passes_rules(spark):
    df = spark.createDataFrame(
        [("a", "c", "p", dt.date(2025, 1, 1), float("nan"), 1.0, 0.0, 1.0, 1.0, "Completed")],
        "order_id string, customer_id string, product_id string, order_date date, revenue double, "
        "quantity double, discount double, unit_price double, margin double, order_status string")
    assert C.clean(df, dedup=False).count() == 0


def test_landing_read_loses_no_row(spark, tmp_path):
    """Doubled quotes, missing words, counts with a fraction, exact money, and
    rows with too few or too many fields."""
    lines = [HEADER,
             _line("Q1").replace("CRM", '"24"" Monitor, black"'), _line("Q2").replace("CRM", '"say ""hi"""'),
             _line("Q3").replace(",10,2,1,", ",3.0,2.0,1.0,"), _line("NaN"), _line("Q4", cust="NA"),
             _line("Q5", rev="0.001"), _line("Q6").replace(",SMB,", ",null,"), _line("Q7") + ",extra", "Q8,C1,SMB"]
    p = tmp_path / "orders_raw.csv"
    p.write_text("\n".join(lines) + "\n")
    got = {r.order_id: r for r in IO.clean_raw_csv(spark, str(p)).collect()}
    assert set(got) == {"Q1", "Q2", "Q3", "Q5", "Q6", "Q7"}
    assert got["Q1"].product_name == '24" Monitor, black' and got["Q2"].product_name == 'say "hi"'
    assert got["Q1"].revenue == 18 and got["Q1"].margin == 5
    assert (got["Q3"].visits, got["Q3"].cart_additions, got["Q3"].completed_orders) == (3, 2, 1)
    assert str(got["Q5"].revenue) == "0.001000" and got["Q6"].customer_segment is None
    audit = IO.landing_audit(spark, str(p)).first()
    assert (audit.rows_read, audit.rows_corrupt, audit.rows_after_dedup, audit.rows_after) == (9, 2, 9, 6)


def test_csv_sink_round_trip_of_quotes(spark, tmp_path):
    rows = [("1", 'a "b", c'), ("2", "x,y"), ("3", '"')]
    df = spark.createDataFrame(rows, "order_id string, name string")
    IO.write_csv(df, str(tmp_path / "out"))
    got = IO.read_raw_csv(spark, str(tmp_path / "out"))
    assert sorted((r.order_id, r.name) for r in got.select("order_id", "name").collect()) == rows
    IO.write_csv(spark.createDataFrame([("1", "two\nlines")], "order_id string, name string"), str(tmp_path / "ml"))
    assert IO.read_raw_csv(spark, str(tmp_path / "ml"), multi_line=True).first()["name"] == "two\nlines"


def test_landing_numbers_are_uncut_or_counted(spark, tmp_path):
    """Eight decimals, 1e25, infinity and 2.7 are there uncut; rows whose exact
    columns cannot hold them are counted."""
    head = "order_id,customer_id,product_id,order_date,quantity,unit_price,discount,revenue,margin,order_status,visits"
    lines = ["o1,c,p,2024-01-01,1,1.12345678,0,1e25,1,Completed,3", "o2,c,p,2024-01-01,1,2,0,inf,1,Completed,3",
             "o3,c,p,2024-01-01,1,2,0,2,1,Completed,2.7", "o4,c,p,2024-01-01,1,0.123456789012,0,2,1,Completed,"]
    (tmp_path / "x.csv").write_text("\n".join([head, *lines]) + "\n")
    out = {r.order_id: r for r in IO.clean_raw_csv(spark, str(tmp_path), uncut=True).collect()}
    assert (out["o1"].unit_price_uncut, out["o1"].revenue_uncut, out["o2"].revenue_uncut) == (1.12345678, 1e25, float("inf"))
    assert (out["o3"].visits_uncut, out["o3"].visits, out["o4"].visits_uncut) == (2.7, 2, None)
    audit = IO.landing_audit(spark, str(tmp_path)).first()
    assert (audit.rows_read, audit.rows_inexact, audit.rows_after) == (4, 4, 4)
