import datetime as dt

from pyspark.sql import functions as F

from orderlens.functions import exprs as E


def test_rnd_is_half_even_on_scaled_double(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,), (-0.125,), (None,)], "x double")
    got = [r[0] for r in df.select(E.rnd("x", 2)).collect()]
    assert got == [0.12, 0.38, 2.5, -0.12, None]
    got0 = [r[0] for r in df.select(E.rnd("x", 0)).collect()]
    assert got0[2] == 2.0


def test_clip_keeps_null_and_ratio_guards_zero(spark):
    df = spark.createDataFrame([(None, 1), (2.0, 0), (0.5, 2), (-1.0, 1)], "x double, d int")
    rows = df.select(E.clip01("x").alias("c"), E.ratio("x", "d").alias("r"),
                     E.safe_div("x", "d").alias("s")).collect()
    assert [r.c for r in rows] == [None, 1.0, 0.5, 0.0]
    assert rows[1].r is None and rows[1].s == 0.0
    assert rows[2].r == 0.25


def test_coerce_double_matches_coercing_parse(spark):
    vals = ["1.5", " 12 ", "1e3", "1.0d", "NaN", "abc", None, "-3"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(E.coerce_double("s")).collect()]
    assert got == [1.5, 12.0, 1000.0, None, None, None, None, -3.0]


def test_week_start_and_iso_label(spark):
    df = spark.createDataFrame([("2025-12-29",), ("2025-12-28",), ("2024-01-07",)], "d string") \
        .select(F.col("d").cast("date").alias("d"))
    rows = df.select(E.week_start("d").alias("w"), E.iso_year_week("d").alias("l"),
                     E.month_name("d").alias("m")).collect()
    assert rows[0].w == dt.date(2025, 12, 29) and rows[0].l == "2026-W01"
    assert rows[1].w == dt.date(2025, 12, 22) and rows[1].l == "2025-W52"
    assert rows[2].w == dt.date(2024, 1, 1) and rows[2].m == "January"


def test_display_formats(spark):
    df = spark.createDataFrame([(1_234_567.0, 0.12345, 0.0567, 1234.0), (999.994, 0.5, -0.25, 5.0)],
                               "v double, p double, w double, n double")
    rows = df.select(E.fmt_currency("v").alias("c"), E.fmt_pct("p").alias("p"),
                     E.fmt_signed_pct("w", 1, " WoW").alias("w"), E.fmt_thousands("n").alias("n")).collect()
    assert rows[0].c == "$1.23M" and rows[0].p == "12.35%" and rows[0].w == "+5.7% WoW" and rows[0].n == "1,234"
    assert rows[1].c == "$999.99" and rows[1].w == "-25.0% WoW"


def test_first_by_skips_missing(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), ("a", "y", 3)], "k string, v string, o int")
    assert df.groupBy("k").agg(E.first_by("v", "o").alias("f"), E.last_by("v", "o").alias("l")).first() \
        .asDict() == {"k": "a", "f": "x", "l": "y"}


def test_display_formats_round_the_value_itself(spark):
    """fmt_currency and fmt_pct print what C prints for the unrounded number."""
    import random
    random.seed(9)
    values = [1115.0, 1145.0, 2675.0, 0.125, 0.375, 1.005, 2.675, -1115.0, -0.0, 0.0, 999.995, 999999.995, 1e13 + 0.5]
    values += [round(random.uniform(0, 10 ** random.randint(0, 9)), random.randint(0, 4)) for _ in range(3000)]
    values += [(2 * random.randint(0, 10 ** 6) + 1) / 200 for _ in range(1000)]

    def money(v):
        if v >= 1_000_000:
            return f"${v / 1_000_000:.2f}M"
        return f"${v / 1_000:.2f}K" if v >= 1_000 else f"${v:.2f}"

    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", E.fmt_currency("v").alias("c"), E.fmt_pct("v").alias("p"),
                       E.fmt_signed_pct("v", 1, " WoW").alias("w")).collect():
        assert (r.c, r.p, r.w) == (money(r.v), f"{r.v * 100:.2f}%", f"{r.v * 100:+.1f}% WoW")
    r = spark.sql("SELECT CAST(NULL AS DOUBLE) v").select(
        E.fmt_currency("v").alias("c"), E.fmt_pct("v").alias("p"), E.fmt_signed_pct("v").alias("w")).first()
    assert (r.c, r.p, r.w) == ("$nan", "nan%", None)
