"""Dashboard queries DB1-DB17: the data behind each page (rendering is out of
scope).  Every function takes the serving tables as DataFrames and an
optional year selection (PF6): orders are sliced by ``year(order_date)``,
weekly rows by ``year(week_start)``.  An empty selection is an error
(PF11), ``None`` means every year.

Cards are one-row aggregates; values from different tables are combined
with scalar subqueries (each one a distributed aggregate).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.constants import RISK_LEVELS, TOP_PRODUCTS
from orderlens.functions import exprs as E
from orderlens.plans import ml_queries as MQ
from orderlens.plans import oracle as O
from orderlens.plans import stages as S
from orderlens.plans.catalog import register
from orderlens.plans.measures_q import DIMC_CTE



def check_years(years: Sequence[int] | None) -> None:
    """PF11: selecting no year stops the page."""
    if years is not None and len(years) == 0:
        raise ValueError("Select at least one year.")


def slice_orders(fact: DataFrame, years: Sequence[int] | None) -> DataFrame:
    check_years(years)
    if years is None:
        return fact
    # the clean fact is stored partitioned by ``year`` (= year(order_date)):
    # filtering that column prunes whole directories
    yr = F.col("year") if "year" in fact.columns else F.year("order_date")
    return fact.filter(yr.isin(list(years)))


def slice_weekly(weekly: DataFrame, years: Sequence[int] | None) -> DataFrame:
    check_years(years)
    return weekly if years is None else weekly.filter(F.year("week_start").isin(list(years)))


@dataclass(frozen=True)
class Slicers:
    """Selections of a report page.  ``None`` selects everything; an empty
    selection is an error (PF11).  Each method slices one table by those
    selections that its columns carry; a table without the column is not
    related to the slicer and stays whole."""
    years: Sequence[int] | None = None
    quarters: Sequence[int] | None = None
    segments: Sequence[str] | None = None
    channels: Sequence[str] | None = None
    categories: Sequence[str] | None = None
    risk_levels: Sequence[str] | None = None
    model_names: Sequence[str] | None = None
    start: date | str | None = None
    end: date | str | None = None

    def __post_init__(self) -> None:
        check_years(self.years)
        for name in ("quarters", "segments", "channels", "categories", "risk_levels", "model_names"):
            if getattr(self, name) is not None and len(getattr(self, name)) == 0:
                raise ValueError(f"Select at least one of {name}.")

    def _by(self, df: DataFrame, selections: Sequence[tuple[Column, Sequence | None]]) -> DataFrame:
        for column, chosen in selections:
            if chosen is not None:
                df = df.filter(column.isin(list(chosen)))
        return df

    def orders(self, fact: DataFrame) -> DataFrame:
        return self._by(slice_orders(fact, self.years), [
            (F.quarter("order_date"), self.quarters), (F.col("customer_segment"), self.segments),
            (F.col("sales_channel"), self.channels), (F.col("product_category"), self.categories)])

    def weekly(self, weekly: DataFrame) -> DataFrame:
        wk = self._by(slice_weekly(weekly, self.years), [(F.quarter("week_start"), self.quarters)])
        return self._dates(wk)

    def _dates(self, df: DataFrame) -> DataFrame:
        if self.start is not None:
            df = df.filter(F.col("week_start") >= F.lit(self.start).cast("date"))
        return df if self.end is None else df.filter(F.col("week_start") <= F.lit(self.end).cast("date"))

    def customers(self, df: DataFrame) -> DataFrame:
        return self._by(df, [(F.col("customer_segment"), self.segments)])

    def churn(self, df: DataFrame) -> DataFrame:
        return self._by(df, [(F.col("customer_segment"), self.segments), (F.col("risk_level"), self.risk_levels)])

    def demand(self, df: DataFrame) -> DataFrame:
        return self._by(df, [(F.col("product_category"), self.categories)])

    def forecast(self, df: DataFrame) -> DataFrame:
        return self._dates(self._by(df, [(F.col("model_name"), self.model_names)]))


def slicer_values(fact: DataFrame) -> DataFrame:
    """TK4: sorted distinct years and categories offered by the slicers."""
    years = fact.select(F.lit("year").alias("slicer"), F.year("order_date").cast("string").alias("value"))
    cats = fact.select(F.lit("product_category").alias("slicer"), F.col("product_category").alias("value"))
    return (years.unionByName(cats).filter(F.col("value").isNotNull())
            .distinct().orderBy("slicer", "value"))


def exec_cards(fact: DataFrame, weekly: DataFrame, years=None) -> DataFrame:
    """DB1 / WN13 / AG11: revenue, orders, AOV, margin %, active customers and
    the latest week's WoW deltas (only when more than one week is shown)."""
    comp = slice_orders(fact, years).filter(F.col("is_completed"))
    wk = slice_weekly(weekly, years)
    last = wk.agg(F.when(F.count(F.lit(1)) > 1,
                         F.max_by(F.struct("revenue_wow_growth", "orders_wow_growth"), "week_start"))
                  .alias("last"))
    wow = last.scalar()  # both from one subquery
    rev_wow, ord_wow = wow.getField("revenue_wow_growth"), wow.getField("orders_wow_growth")
    cards = comp.agg(F.coalesce(F.sum("revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
                     F.count(F.lit(1)).alias("total_orders"),
                     F.coalesce(F.sum("margin").cast("double"), F.lit(0.0)).alias("_margin"),
                     F.count_distinct("customer_id").alias("active_customers"))
    cards = cards.select("total_revenue", "total_orders",
                         E.safe_div("total_revenue", "total_orders").alias("avg_order_value"),
                         E.safe_div("_margin", "total_revenue").alias("gross_margin_pct"),
                         "active_customers")
    return cards.select(
        "*",
        E.fmt_currency("total_revenue").alias("revenue_display"),
        E.fmt_thousands("total_orders").alias("orders_display"),
        E.fmt_currency("avg_order_value").alias("aov_display"),
        E.fmt_pct("gross_margin_pct").alias("margin_display"),
        E.fmt_thousands("active_customers").alias("customers_display"),
        E.fmt_signed_pct(rev_wow, 1, " WoW").alias("revenue_delta"),
        E.fmt_signed_pct(ord_wow, 1, " WoW").alias("orders_delta"),
    )


def weekly_series(weekly: DataFrame, years=None, start=None, end=None) -> DataFrame:
    """DB2 / DB5 / PF10: weekly revenue and orders with WoW growth in percent."""
    wk = slice_weekly(weekly, years)
    if start is not None or end is not None:
        lo = F.lit(start).cast("date") if start is not None else F.col("week_start")
        hi = F.lit(end).cast("date") if end is not None else F.col("week_start")
        wk = wk.filter(F.col("week_start").between(lo, hi))
    return (wk.select("week_start", "total_revenue",
                      (F.col("revenue_wow_growth") * 100.0).alias("revenue_wow_pct"),
                      "total_orders",
                      (F.col("orders_wow_growth") * 100.0).alias("orders_wow_pct"))
            .orderBy("week_start"))


def revenue_by(fact: DataFrame, dim: str, years=None) -> DataFrame:
    """DB3: completed revenue per value of ``dim``, ascending."""
    comp = slice_orders(fact, years).filter(F.col("is_completed") & F.col(dim).isNotNull())
    return (comp.groupBy(dim).agg(F.sum("revenue").cast("double").alias("total_revenue"))
            .orderBy("total_revenue", dim))


def weekly_funnel_cards(fact: DataFrame, weekly: DataFrame, years=None) -> DataFrame:
    """DB4: ratio-of-sums conversion and abandonment over the shown weeks
    (0 when the denominator is 0) and mean discount of completed orders."""
    wk = slice_weekly(weekly, years)
    comp = slice_orders(fact, years).filter(F.col("is_completed"))
    avg_disc = comp.agg(F.sum("discount").cast("double") / F.count("discount")).scalar()
    s = wk.agg(F.sum("completed_orders").alias("co"), F.sum("visits").alias("v"),
               F.sum("cart_additions").alias("ca"))
    out = s.select(
        E.safe_div("co", "v").alias("conversion_rate"),
        F.when(F.coalesce(F.col("ca"), F.lit(0)) != 0, F.lit(1.0) - E.ratio("co", "ca"))
        .otherwise(F.lit(0.0)).alias("cart_abandonment_rate"),
        avg_disc.alias("avg_discount"))
    return out.select("*", *[E.fmt_pct(c).alias(f"{c}_display") for c in out.columns])


def new_vs_repeat_series(weekly: DataFrame, years=None) -> DataFrame:
    """DB6."""
    return (slice_weekly(weekly, years)
            .select("week_start", "new_customers", "repeat_customers").orderBy("week_start"))


def latest_units_by_category(demand: DataFrame) -> DataFrame:
    """DB7 / AG7: per category, the last non-missing value of each column in
    week order, sorted by units."""
    return (demand.groupBy("product_category")
            .agg(E.last_by("week", "week").alias("week"),
                 E.last_by("actual_units_sold", "week").alias("actual_units_sold"),
                 E.last_by("predicted_units_sold", "week").alias("predicted_units_sold"),
                 E.last_by("demand_trend", "week").alias("demand_trend"))
            .orderBy("actual_units_sold", "product_category"))


def category_series(demand: DataFrame, category: str | None = None) -> DataFrame:
    """DB8 / PF7: actual vs predicted units of one category (default: the
    first category in sorted order, as the selector opens)."""
    pick = (F.lit(category) if category is not None
            else demand.agg(F.min("product_category")).scalar())
    return (demand.filter(F.col("product_category") == pick)
            .select("product_category", "week", "actual_units_sold", "predicted_units_sold")
            .orderBy("week"))


def customer_cards(churn: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """DB9 / AG15 / AG21."""
    rep = dim_customers.agg(F.count_if(F.col("is_repeat_customer")).alias("rc"),
                            F.count(F.lit(1)).alias("n"))
    rc = rep.select("rc").scalar()
    rate = rep.select(E.safe_div("rc", "n")).scalar()
    c = churn.agg(F.count_if(F.col("risk_level") == "High").alias("high_risk_customers"),
                  F.count(F.lit(1)).alias("_n"))
    out = c.select("high_risk_customers",
                   E.ratio("high_risk_customers", "_n").alias("churn_rate"),
                   rc.alias("repeat_customers"), rate.alias("repeat_rate"))
    return out.select(
        "*",
        E.fmt_thousands("high_risk_customers").alias("high_risk_display"),
        F.format_string("%.0f%% of base", E.rnd(F.col("churn_rate") * 100.0, 0)).alias("churn_delta"),
        E.fmt_thousands("repeat_customers").alias("repeat_display"),
        E.fmt_pct("repeat_rate").alias("repeat_rate_display"),
    )


def segment_share(fact: DataFrame, years=None) -> DataFrame:
    """DB16 / AG14: completed revenue per segment and its share of the total."""
    comp = slice_orders(fact, years).filter(F.col("is_completed") & F.col("customer_segment").isNotNull())
    total = comp.agg(F.sum("revenue")).scalar()
    return (comp.groupBy("customer_segment")
            .agg(F.sum("revenue").alias("_rev"))
            .select("customer_segment", F.col("_rev").cast("double").alias("total_revenue"),
                    E.ratio("_rev", total).alias("revenue_share")))


def segment_table_formatted(segments: DataFrame) -> DataFrame:
    """DB10 / SC7 / SC8 / SC9: segment table with display strings."""
    return segments.select(
        F.col("customer_segment").alias("segment"),
        E.fmt_currency("total_revenue").alias("revenue"),
        F.col("total_orders").alias("orders"),
        E.fmt_currency("avg_order_value").alias("aov"),
        E.fmt_pct("repeat_rate").alias("repeat_rate"),
        E.fmt_thousands("total_orders").alias("orders_display"),
    )


def churn_scatter(churn: DataFrame) -> DataFrame:
    """DB11."""
    return churn.select("customer_id", "customer_segment", "purchase_frequency",
                        "churn_risk_probability", "total_revenue", "risk_level")


def forecast_cards(forecast: DataFrame, churn: DataFrame) -> DataFrame:
    """DB12: next-4-week predicted revenue, forecast error % (sum of |error|
    over actual rows / actual revenue, 0 when undefined), high-risk count."""
    c = churn.agg(F.count_if(F.col("risk_level") == "High").alias("h"), F.count(F.lit(1)).alias("n"))
    high = c.select("h").scalar()
    rate = c.select(E.ratio("h", "n")).scalar()
    f = forecast.agg(
        E.exact_sum(F.when(F.col("is_future"), F.col("predicted_revenue"))).alias("_pred"),
        E.exact_sum(F.when(~F.col("is_future"), F.abs("prediction_error"))).alias("_abs"),
        E.exact_sum(F.when(~F.col("is_future"), F.col("actual_revenue"))).alias("_act"))
    out = f.select(F.coalesce("_pred", F.lit(0.0)).alias("predicted_revenue_next"),
                   E.safe_div("_abs", "_act").alias("forecast_error_pct"),
                   high.alias("high_risk_customers"), rate.alias("churn_rate"))
    return out.select(
        "*",
        E.fmt_currency("predicted_revenue_next").alias("predicted_display"),
        E.fmt_pct("forecast_error_pct").alias("error_display"),
        F.format_string("%.0f%% of customer base", E.rnd(F.col("churn_rate") * 100.0, 0)).alias("churn_delta"),
    )


def forecast_line(forecast: DataFrame) -> DataFrame:
    """DB13 / SO2 / TK5: actual, in-sample and forecast series; the forecast
    line starts at the last actual week (bridge)."""
    actuals = forecast.filter(~F.col("is_future"))
    future = forecast.filter(F.col("is_future"))
    last = actuals.agg(F.max_by(F.struct("week_start", "predicted_revenue"), "week_start").alias("b"))
    bridge = last.select(F.col("b.week_start").alias("week_start"),
                         F.col("b.predicted_revenue").alias("value")).filter(F.col("week_start").isNotNull())
    return (actuals.select(F.lit("Actual").alias("series"), "week_start",
                           F.col("actual_revenue").alias("value"))
            .unionByName(actuals.select(F.lit("Predicted (in-sample)").alias("series"), "week_start",
                                        F.col("predicted_revenue").alias("value")))
            .unionByName(bridge.select(F.lit("Forecast").alias("series"), "week_start", "value"))
            .unionByName(future.select(F.lit("Forecast").alias("series"), "week_start",
                                       F.col("predicted_revenue").alias("value"))))


def risk_distribution(spark: SparkSession, churn: DataFrame) -> DataFrame:
    """DB14 / AG13 / JN9: counts per risk level on the fixed domain
    Low, Medium, High (absent level -> NULL count)."""
    domain = spark.createDataFrame([(lvl, i) for i, lvl in enumerate(RISK_LEVELS)],
                                   "risk_level string, ordinal int")
    # one row per distinct level (at most the domain plus NULL): a proven bound
    counts = churn.groupBy("risk_level").agg(F.count(F.lit(1)).alias("count"))
    return (domain.join(F.broadcast(counts), "risk_level", "left")
            .select("risk_level", "ordinal", "count").orderBy("ordinal"))


def top_products(fact: DataFrame, dim_products: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    """DB15 / JN10 / TK3: the ``k`` products with the highest completed
    revenue (ties by product id); the limit is the feature."""
    rev = (fact.filter(F.col("is_completed"))
           .groupBy("product_id").agg(F.sum("revenue").cast("double").alias("total_revenue"),
                                      F.count(F.lit(1)).alias("total_orders")))
    # the k rows are picked first, so the product lookup joins k rows
    top = rev.orderBy(F.desc("total_revenue"), "product_id").limit(k)
    return (top.join(dim_products.select("product_id", "product_name", "product_category"), "product_id", "left")
            .orderBy(F.desc("total_revenue"), "product_id"))


# ---------------------------------------------------------------------------
# Registered queries (all years selected; stand-in prediction tables)
# ---------------------------------------------------------------------------

def _fact(spark, sf):
    return S.orders_clean(spark, sf)


def _weekly(spark, sf):
    return S.serving(spark, sf, "weekly_kpis")


def dsql(select: str, extra: str = "") -> str:
    ctes = DIMC_CTE + ",\n" + O.WEEKLY_CTE.strip()
    if extra.strip():
        ctes += ",\n" + extra.strip()
    return MQ.ml_sql(select, ctes)


def f_cur(x: str) -> str:
    """The raw value under ``printf``; a missing one prints as nan."""
    return (f"(CASE WHEN {x} IS NULL THEN '$nan' WHEN {x} >= 1000000 THEN printf('$%.2fM', {x} / 1000000.0) "
            f"WHEN {x} >= 1000 THEN printf('$%.2fK', {x} / 1000.0) ELSE printf('$%.2f', CAST({x} AS DOUBLE)) END)")


def f_pct(x: str, d: int = 2) -> str:
    return f"(CASE WHEN {x} IS NULL THEN 'nan%' ELSE printf('%.{d}f%%', {x} * 100.0) END)"


def f_signed(x: str, d: int, suffix: str) -> str:
    return f"(CASE WHEN {x} IS NOT NULL THEN printf('%+.{d}f%%{suffix}', {x} * 100.0) END)"


def f_thou(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


EXEC_REV = "COALESCE(CAST(sum(revenue) AS DOUBLE), 0.0)"
EXEC_MARGIN = "COALESCE(CAST(sum(margin) AS DOUBLE), 0.0)"


def exec_sql(orders: str = "true", weeks: str = "true") -> str:
    """Executive cards of the orders and weeks that pass two conditions."""
    shown = f"FROM weekly WHERE {weeks}"
    return dsql(f"""
SELECT total_revenue, total_orders, avg_order_value, gross_margin_pct, active_customers,
       {f_cur('total_revenue')} AS revenue_display, {f_thou('total_orders')} AS orders_display,
       {f_cur('avg_order_value')} AS aov_display, {f_pct('gross_margin_pct')} AS margin_display,
       {f_thou('active_customers')} AS customers_display,
       {f_signed('rw', 1, ' WoW')} AS revenue_delta, {f_signed('ow', 1, ' WoW')} AS orders_delta
FROM (
  SELECT {EXEC_REV} AS total_revenue, count(*) AS total_orders,
         COALESCE({O.ratio(EXEC_REV, 'count(*)')}, 0.0) AS avg_order_value,
         COALESCE({O.ratio(EXEC_MARGIN, EXEC_REV)}, 0.0) AS gross_margin_pct,
         count(DISTINCT customer_id) AS active_customers,
         CASE WHEN (SELECT count(*) {shown}) > 1 THEN
              (SELECT revenue_wow_growth {shown} ORDER BY week_start DESC LIMIT 1) END AS rw,
         CASE WHEN (SELECT count(*) {shown}) > 1 THEN
              (SELECT orders_wow_growth {shown} ORDER BY week_start DESC LIMIT 1) END AS ow
  FROM comp WHERE {orders}
) x""")


def sliced_exec_cards(spark: SparkSession, sf_dir: str, slicers: Slicers) -> DataFrame:
    return exec_cards(slicers.orders(_fact(spark, sf_dir)), slicers.weekly(_weekly(spark, sf_dir)))


@register("exec_cards", exec_sql())
def q_exec_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliced_exec_cards(spark, sf_dir, Slicers())


@register("exec_cards_year", exec_sql("year(order_date) IN (1995, 1996)", "year(week_start) IN (1995, 1996)"))
def q_exec_cards_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PF6 on the executive page."""
    return sliced_exec_cards(spark, sf_dir, Slicers(years=[1995, 1996]))


@register("exec_cards_quarter", exec_sql("quarter(order_date) = 2", "quarter(week_start) = 2"))
def q_exec_cards_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliced_exec_cards(spark, sf_dir, Slicers(quarters=[2]))


@register("exec_cards_segment", exec_sql("customer_segment IN ('BUILDING', 'MACHINERY')"))
def q_exec_cards_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliced_exec_cards(spark, sf_dir, Slicers(segments=["BUILDING", "MACHINERY"]))


@register("exec_cards_channel", exec_sql("sales_channel = '1-URGENT'"))
def q_exec_cards_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliced_exec_cards(spark, sf_dir, Slicers(channels=["1-URGENT"]))


@register("weekly_series_range", dsql("""
SELECT week_start, total_revenue, revenue_wow_growth * 100.0 AS revenue_wow_pct,
       total_orders, orders_wow_growth * 100.0 AS orders_wow_pct
FROM weekly WHERE week_start BETWEEN DATE '1995-03-01' AND DATE '1996-06-30' ORDER BY week_start"""))
def q_weekly_series_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PF10: the date-range slicer."""
    return weekly_series(Slicers(start="1995-03-01", end="1996-06-30").weekly(_weekly(spark, sf_dir)))


@register("churn_scatter_sliced", dsql("""
SELECT customer_id, customer_segment, purchase_frequency, churn_risk_probability, total_revenue, risk_level
FROM cr WHERE risk_level IN ('Low', 'High') AND customer_segment = 'BUILDING'"""))
def q_churn_scatter_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk-level and segment slicers of the customer page."""
    return churn_scatter(Slicers(risk_levels=["Low", "High"], segments=["BUILDING"]).churn(
        MQ.naive_churn_risk(spark, sf_dir)))


@register("forecast_line_model", dsql(f"""
SELECT 'Actual' AS series, week_start, actual_revenue AS value FROM sf
WHERE NOT is_future AND model_name = '{MQ.NAIVE_FORECAST_NAME}'
UNION ALL
SELECT 'Predicted (in-sample)', week_start, predicted_revenue FROM sf
WHERE NOT is_future AND model_name = '{MQ.NAIVE_FORECAST_NAME}'
UNION ALL
SELECT 'Forecast', week_start, predicted_revenue
FROM (SELECT * FROM sf WHERE NOT is_future ORDER BY week_start DESC LIMIT 1) b
UNION ALL
SELECT 'Forecast', week_start, predicted_revenue FROM sf WHERE is_future AND model_name <> 'other'"""))
def q_forecast_line_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model slicer of the insights page: the rows of a second model are left out."""
    own = MQ.naive_sales_forecast(spark, sf_dir)
    other = own.withColumn("model_name", F.lit("other")).withColumn(
        "predicted_revenue", F.col("predicted_revenue") * F.lit(2.0))
    return forecast_line(Slicers(model_names=[MQ.NAIVE_FORECAST_NAME]).forecast(own.unionByName(other)))


@register("weekly_series", dsql("""
SELECT week_start, total_revenue, revenue_wow_growth * 100.0 AS revenue_wow_pct,
       total_orders, orders_wow_growth * 100.0 AS orders_wow_pct
FROM weekly ORDER BY week_start"""))
def q_weekly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_series(_weekly(spark, sf_dir))


def _rev_by_sql(dim: str) -> str:
    return dsql(f"""
SELECT {dim}, CAST(sum(revenue) AS DOUBLE) AS total_revenue
FROM comp WHERE {dim} IS NOT NULL GROUP BY {dim} ORDER BY total_revenue, {dim}""")


@register("revenue_by_segment", _rev_by_sql("customer_segment"))
def q_revenue_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_by(_fact(spark, sf_dir), "customer_segment")


@register("revenue_by_channel", _rev_by_sql("sales_channel"))
def q_revenue_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_by(_fact(spark, sf_dir), "sales_channel")


@register("revenue_by_category", _rev_by_sql("product_category"))
def q_revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_by(_fact(spark, sf_dir), "product_category")


@register("weekly_funnel_cards", dsql(f"""
SELECT conversion_rate, cart_abandonment_rate, avg_discount,
       {f_pct('conversion_rate')} AS conversion_rate_display,
       {f_pct('cart_abandonment_rate')} AS cart_abandonment_rate_display,
       {f_pct('avg_discount')} AS avg_discount_display
FROM (
  SELECT COALESCE({O.ratio('sum(completed_orders)', 'sum(visits)')}, 0.0) AS conversion_rate,
         CASE WHEN COALESCE(sum(cart_additions), 0) <> 0
              THEN 1.0 - {O.ratio('sum(completed_orders)', 'sum(cart_additions)')} ELSE 0.0 END
             AS cart_abandonment_rate,
         (SELECT CAST(sum(discount) AS DOUBLE) / count(discount) FROM comp) AS avg_discount
  FROM weekly
) x"""))
def q_weekly_funnel_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_funnel_cards(_fact(spark, sf_dir), _weekly(spark, sf_dir))


@register("new_vs_repeat_series", dsql(
    "SELECT week_start, new_customers, repeat_customers FROM weekly ORDER BY week_start"))
def q_new_vs_repeat_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_vs_repeat_series(_weekly(spark, sf_dir))


@register("latest_units_by_category", dsql("""
SELECT product_category,
       arg_max(week, CASE WHEN week IS NOT NULL THEN week END) AS week,
       arg_max(actual_units_sold, CASE WHEN actual_units_sold IS NOT NULL THEN week END) AS actual_units_sold,
       arg_max(predicted_units_sold, CASE WHEN predicted_units_sold IS NOT NULL THEN week END)
           AS predicted_units_sold,
       arg_max(demand_trend, CASE WHEN demand_trend IS NOT NULL THEN week END) AS demand_trend
FROM dp GROUP BY product_category ORDER BY actual_units_sold, product_category"""))
def q_latest_units_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_units_by_category(MQ.naive_demand_predictions(spark, sf_dir))


@register("category_series", dsql("""
SELECT product_category, week, actual_units_sold, predicted_units_sold
FROM dp WHERE product_category = (SELECT min(product_category) FROM dp) ORDER BY week"""))
def q_category_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_series(MQ.naive_demand_predictions(spark, sf_dir))


@register("customer_cards", dsql(f"""
SELECT high_risk_customers, churn_rate, repeat_customers, repeat_rate,
       {f_thou('high_risk_customers')} AS high_risk_display,
       printf('%.0f%% of base', {O.rnd('churn_rate * 100.0', 0)}) AS churn_delta,
       {f_thou('repeat_customers')} AS repeat_display,
       {f_pct('repeat_rate')} AS repeat_rate_display
FROM (
  SELECT CAST(count_if(risk_level = 'High') AS BIGINT) AS high_risk_customers,
         {O.ratio("count_if(risk_level = 'High')", 'count(*)')} AS churn_rate,
         (SELECT CAST(count_if(is_repeat_customer) AS BIGINT) FROM dimc) AS repeat_customers,
         (SELECT COALESCE({O.ratio('count_if(is_repeat_customer)', 'count(*)')}, 0.0) FROM dimc) AS repeat_rate
  FROM cr
) x"""))
def q_customer_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_cards(MQ.naive_churn_risk(spark, sf_dir), S.serving(spark, sf_dir, "dim_customers"))


@register("segment_share", dsql(f"""
SELECT customer_segment, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       {O.ratio('sum(revenue)', '(SELECT sum(revenue) FROM comp WHERE customer_segment IS NOT NULL)')} AS revenue_share
FROM comp WHERE customer_segment IS NOT NULL GROUP BY customer_segment"""))
def q_segment_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_share(_fact(spark, sf_dir))


SEGMENT_PERF_CTE = f"""
sg AS ({O.group_sums('customer_segment')}),
sgr AS ({O.repeat_by('customer_segment')}),
segp AS (
  SELECT g.customer_segment, CAST(_rev AS DOUBLE) AS total_revenue, total_orders, unique_customers,
         {O.rnd('CAST(_rev AS DOUBLE) / _rev_n', 2)} AS avg_order_value,
         {O.rnd(O.ratio('COALESCE(r.repeat_customers, 0)', 'unique_customers'), 4)} AS repeat_rate
  FROM sg g LEFT JOIN sgr r ON r.customer_segment = g.customer_segment
)"""


@register("segment_table_formatted", dsql(f"""
SELECT customer_segment AS segment, {f_cur('total_revenue')} AS revenue, total_orders AS orders,
       {f_cur('avg_order_value')} AS aov, {f_pct('repeat_rate')} AS repeat_rate,
       {f_thou('total_orders')} AS orders_display
FROM segp""", SEGMENT_PERF_CTE))
def q_segment_table_formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_table_formatted(S.serving(spark, sf_dir, "segment_performance"))


@register("churn_scatter", dsql("""
SELECT customer_id, customer_segment, purchase_frequency, churn_risk_probability, total_revenue, risk_level
FROM cr"""))
def q_churn_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn_scatter(MQ.naive_churn_risk(spark, sf_dir))


@register("forecast_cards", dsql(f"""
SELECT predicted_revenue_next, forecast_error_pct, high_risk_customers, churn_rate,
       {f_cur('predicted_revenue_next')} AS predicted_display,
       {f_pct('forecast_error_pct')} AS error_display,
       printf('%.0f%% of customer base', {O.rnd('churn_rate * 100.0', 0)}) AS churn_delta
FROM (
  SELECT COALESCE({O.binary_sum('CASE WHEN is_future THEN predicted_revenue END')}, 0.0) AS predicted_revenue_next,
         COALESCE({O.ratio(O.binary_sum('CASE WHEN NOT is_future THEN abs(prediction_error) END'),
                           O.binary_sum('CASE WHEN NOT is_future THEN actual_revenue END'))}, 0.0) AS forecast_error_pct,
         (SELECT CAST(count_if(risk_level = 'High') AS BIGINT) FROM cr) AS high_risk_customers,
         (SELECT {O.ratio("count_if(risk_level = 'High')", 'count(*)')} FROM cr) AS churn_rate
  FROM sf
) x"""))
def q_forecast_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_cards(MQ.naive_sales_forecast(spark, sf_dir), MQ.naive_churn_risk(spark, sf_dir))


@register("forecast_line", dsql("""
SELECT 'Actual' AS series, week_start, actual_revenue AS value FROM sf WHERE NOT is_future
UNION ALL
SELECT 'Predicted (in-sample)', week_start, predicted_revenue FROM sf WHERE NOT is_future
UNION ALL
SELECT 'Forecast', week_start, predicted_revenue
FROM (SELECT * FROM sf WHERE NOT is_future ORDER BY week_start DESC LIMIT 1) b
UNION ALL
SELECT 'Forecast', week_start, predicted_revenue FROM sf WHERE is_future"""))
def q_forecast_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_line(MQ.naive_sales_forecast(spark, sf_dir))


@register("risk_distribution", dsql("""
SELECT d.risk_level, d.ordinal, c.cnt AS count
FROM (VALUES ('Low', 0), ('Medium', 1), ('High', 2)) d(risk_level, ordinal)
LEFT JOIN (SELECT risk_level, count(*) AS cnt FROM cr GROUP BY risk_level) c ON c.risk_level = d.risk_level
ORDER BY d.ordinal"""))
def q_risk_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_distribution(spark, MQ.naive_churn_risk(spark, sf_dir))


@register("top20_products", dsql(f"""
SELECT r.product_id, r.total_revenue, r.total_orders, p.product_name, p.product_category
FROM (SELECT product_id, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(*) AS total_orders
      FROM comp GROUP BY product_id) r
LEFT JOIN (SELECT product_id, {O.first_by('product_name')} AS product_name,
                  {O.first_by('product_category')} AS product_category FROM cl GROUP BY product_id) p
  ON p.product_id = r.product_id
ORDER BY r.total_revenue DESC, r.product_id LIMIT {TOP_PRODUCTS}"""))
def q_top20_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(S.orders_clean(spark, sf_dir), S.serving(spark, sf_dir, "dim_products"))


@register("slicer_values", dsql("""
SELECT * FROM (
  SELECT DISTINCT 'year' AS slicer, CAST(year(order_date) AS VARCHAR) AS value FROM cl
  UNION
  SELECT DISTINCT 'product_category', product_category FROM cl WHERE product_category IS NOT NULL
) ORDER BY slicer, value"""))
def q_slicer_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slicer_values(_fact(spark, sf_dir))


# ---------------------------------------------------------------------------
# Page API: every frame a dashboard page shows, under the page's slicers
# ---------------------------------------------------------------------------

PAGES = ("executive_overview", "weekly_kpi_tracking", "product_category", "customer_segment",
         "predictive_insights", "model_performance")


class _Predictions:
    """Prediction tables of a page, made when a page asks: learned models are
    not trained for pages that show none."""

    def __init__(self, spark: SparkSession, sf_dir: str, kind: str):
        if kind not in ("learned", "naive"):
            raise ValueError("predictions must be 'learned' or 'naive'")
        self.spark, self.sf_dir, self.learned = spark, sf_dir, kind == "learned"

    def _model(self, name: str):
        from orderlens.plans import models as MD
        return MD.fitted_models(self.spark, self.sf_dir)[name]

    def forecast(self) -> DataFrame:
        from orderlens.plans import ml_features as MF
        if not self.learned:
            return MQ.naive_sales_forecast(self.spark, self.sf_dir)
        m = self._model("forecast")
        return MF.sales_forecast(MQ.weekly_frame(self.spark, self.sf_dir), m.score, m.name)

    def churn(self) -> DataFrame:
        from orderlens.plans import ml_features as MF
        if not self.learned:
            return MQ.naive_churn_risk(self.spark, self.sf_dir)
        return MF.churn_risk(MQ.churn_frame(self.spark, self.sf_dir), self._model("churn").score)

    def demand(self) -> DataFrame:
        from orderlens.plans import ml_features as MF
        if not self.learned:
            return MQ.naive_demand_predictions(self.spark, self.sf_dir)
        return MF.demand_predictions(MQ.demand_frame(self.spark, self.sf_dir), self._model("demand").score)

    def performance(self) -> DataFrame:
        from orderlens.plans import metrics_q as MTQ
        from orderlens.plans import models as MD
        return (MD.q_model_performance if self.learned else MTQ.naive_model_performance)(self.spark, self.sf_dir)


def page(spark: SparkSession, sf_dir: str, name: str, years=None, category: str | None = None,
         predictions: str = "learned", slicers: Slicers | None = None) -> dict[str, DataFrame]:
    """The data behind one dashboard page as named DataFrames (lazy).

    ``slicers`` apply to every frame of the page; ``years`` is short for a year
    selection alone.  ``category`` is the product selector of the category
    series (default: first in order); ``predictions`` chooses the learned models
    or the stand-in scorers."""
    if slicers is not None and years is not None:
        raise ValueError("give years in the slicers")
    sl = slicers or Slicers(years=years)
    made = _Predictions(spark, sf_dir, predictions)
    fact = sl.orders(S.orders_clean(spark, sf_dir))
    weekly = sl.weekly(S.serving(spark, sf_dir, "weekly_kpis"))
    customers = sl.customers(S.serving(spark, sf_dir, "dim_customers"))
    if name == "executive_overview":
        return {"cards": exec_cards(fact, weekly),
                "weekly_revenue": weekly_series(weekly),
                "revenue_by_segment": revenue_by(fact, "customer_segment"),
                "revenue_by_channel": revenue_by(fact, "sales_channel")}
    if name == "weekly_kpi_tracking":
        return {"cards": weekly_funnel_cards(fact, weekly),
                "revenue_and_orders": weekly_series(weekly),
                "new_vs_repeat": new_vs_repeat_series(weekly)}
    if name == "product_category":
        demand = sl.demand(made.demand())
        return {"revenue_by_category": revenue_by(fact, "product_category"),
                "latest_units": latest_units_by_category(demand),
                "category_series": category_series(demand, category),
                "top_products": top_products(fact, S.serving(spark, sf_dir, "dim_products"))}
    if name == "customer_segment":
        churn = sl.churn(made.churn())
        return {"cards": customer_cards(churn, customers),
                "segment_share": segment_share(fact),
                "segment_table": segment_table_formatted(sl.customers(S.serving(spark, sf_dir, "segment_performance"))),
                "risk_distribution": risk_distribution(spark, churn),
                "churn_scatter": churn_scatter(churn)}
    if name == "predictive_insights":
        forecast, churn = sl.forecast(made.forecast()), sl.churn(made.churn())
        return {"cards": forecast_cards(forecast, churn),
                "forecast_line": forecast_line(forecast),
                "risk_distribution": risk_distribution(spark, churn),
                "latest_units": latest_units_by_category(sl.demand(made.demand()))}
    if name == "model_performance":
        from orderlens.plans import metrics as MT
        return {"matrix": MT.performance_pivot(made.performance())}
    raise ValueError(f"unknown page {name!r}; pages: {', '.join(PAGES)}")
