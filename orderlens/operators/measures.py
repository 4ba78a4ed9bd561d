"""Semantic-model measures (ME1-ME19) as named aggregate expressions.

A measure is evaluated in a *filter context*: ``evaluate(df, names, by,
where)`` applies ``where``, groups by ``by`` (no keys = the grand total) and
computes every requested measure in a single aggregation pass.  Ratios are
``DIVIDE(a, b, 0)`` (0 when undefined); sums of an empty context are NULL
(blank), counts are 0.

Tables the measures read:

* ``star``     - order lines related to dim_customers (JN7/JN8)
* ``weekly``   - the weekly KPI mart
* ``forecast`` - the sales-forecast table
* ``churn``    - the churn-risk table
* ``demand``   - the demand-prediction table
* ``customers``- dim_customers
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.constants import MEASURE_FORMATS
from orderlens.functions import exprs as E


@dataclass(frozen=True)
class Measure:
    name: str
    table: str
    build: Callable[[], Column] | None
    fmt: str = ""
    doc: str = ""
    # two-level form: level-1 aggregate per (keys, DISTINCT_KEY) and its merge
    partial: Callable[[], Column] | None = None
    merge: Callable[[str], Column] | None = None


# the column every distinct-count measure of the star counts
DISTINCT_KEY = "customer_id"


def _done():
    return F.col("is_completed")


def _sum_completed(col: str) -> Column:
    return F.sum(F.when(_done(), F.col(col)))


BASE: dict[str, Measure] = {}
DERIVED: dict[str, tuple[Callable[[], Column], tuple[str, ...]]] = {}


def _base(name, table, build, fmt="", doc="", partial=None, merge=None):
    BASE[name] = Measure(name, table, build, fmt, doc, partial, merge)


def _sum_merge(cast=None):
    def merge(c: str) -> Column:
        out = F.sum(c)
        return out.cast(cast) if cast else out
    return merge


def _flag(cond: Callable[[], Column]) -> Callable[[], Column]:
    """Level-1 flag: does this (keys, customer) group satisfy ``cond``?"""
    return lambda: F.max(F.when(cond() & F.col(DISTINCT_KEY).isNotNull(), F.lit(True)))


def _count_flags(c: str) -> Column:
    return F.count_if(F.col(c))


def _derived(name, build, needs):
    DERIVED[name] = (build, tuple(needs))


# --- star (fact_orders + dim_customers) -------------------------------------
_base("total_revenue", "star", lambda: _sum_completed("revenue").cast("double"), "currency", "ME1",
      lambda: _sum_completed("revenue"), _sum_merge("double"))
_base("total_orders", "star", lambda: F.count_if(_done()), "#,0", "ME2",
      lambda: F.count_if(_done()), lambda c: F.coalesce(F.sum(c), F.lit(0)))
_base("units_sold", "star", lambda: _sum_completed("quantity"), "#,0", "ME4",
      lambda: _sum_completed("quantity"), _sum_merge())
_base("gross_margin", "star", lambda: _sum_completed("margin").cast("double"), "currency", "ME5",
      lambda: _sum_completed("margin"), _sum_merge("double"))
_base("active_customers", "star",
      lambda: F.count_distinct(F.when(_done(), F.col("customer_id"))), "#,0", "ME7",
      _flag(_done), _count_flags)
_base("repeat_customers_model", "star", None, "#,0", "ME9 (model: distinct completed buyers flagged repeat)",
      _flag(_done), lambda c: F.count_if(F.col(c) & F.coalesce(F.col("is_repeat_customer"), F.lit(False))))
_base("_sum_completed_orders", "star", lambda: F.sum("completed_orders"), "", "",
      lambda: F.sum("completed_orders"), _sum_merge())
_base("_sum_visits", "star", lambda: F.sum("visits"), "", "", lambda: F.sum("visits"), _sum_merge())
_base("_sum_cart_additions", "star", lambda: F.sum("cart_additions"), "", "",
      lambda: F.sum("cart_additions"), _sum_merge())

_derived("average_order_value", lambda: E.safe_div("total_revenue", "total_orders"),
         ["total_revenue", "total_orders"])
_derived("gross_margin_pct", lambda: E.safe_div("gross_margin", "total_revenue"),
         ["gross_margin", "total_revenue"])
_derived("repeat_customer_rate_model", lambda: E.safe_div("repeat_customers_model", "active_customers"),
         ["repeat_customers_model", "active_customers"])
_derived("conversion_rate", lambda: E.safe_div("_sum_completed_orders", "_sum_visits"),
         ["_sum_completed_orders", "_sum_visits"])
_derived("cart_abandonment_rate",
         lambda: F.lit(1.0) - E.safe_div("_sum_completed_orders", "_sum_cart_additions"),
         ["_sum_completed_orders", "_sum_cart_additions"])

# --- other tables ------------------------------------------------------------
_base("new_customers", "weekly", lambda: F.sum("new_customers"), "#,0", "ME8")
_base("repeat_customers", "customers",
      lambda: F.count_if(F.col("purchase_frequency") >= 2), "#,0", "ME9 (plan: dim_customers frequency >= 2)")
_base("high_risk_customers", "churn", lambda: F.count_if(F.col("risk_level") == "High"), "#,0", "ME17")
_base("_churn_rows", "churn", lambda: F.count(F.lit(1)))
_derived("churn_risk_rate_model", lambda: E.safe_div("high_risk_customers", "_churn_rows"),
         ["high_risk_customers", "_churn_rows"])
_base("increasing_demand_categories", "demand",
      lambda: F.count_distinct(F.when(F.col("demand_trend") == "Increasing", F.col("product_category"))),
      "#,0", "ME19")
_base("predicted_revenue", "forecast",
      lambda: E.exact_sum(F.when(F.col("is_future"), F.col("predicted_revenue"))), "currency",
      "ME15 (plan: future rows only)")
_base("predicted_revenue_model", "forecast",
      lambda: E.exact_sum(F.when(F.col("predicted_revenue").isNotNull(), F.col("predicted_revenue"))),
      "currency", "ME15 (model: every non-blank prediction)")
_base("_abs_err_actual", "forecast",
      lambda: E.exact_sum(F.when(~F.col("is_future"), F.abs(F.col("prediction_error")))))
_base("_actual_actual", "forecast",
      lambda: E.exact_sum(F.when(~F.col("is_future"), F.col("actual_revenue"))))
_base("_sum_err", "forecast", lambda: E.exact_sum("prediction_error"))
_base("_sum_actual", "forecast", lambda: E.exact_sum("actual_revenue"))
_derived("forecast_error_pct", lambda: E.safe_div("_abs_err_actual", "_actual_actual"),
         ["_abs_err_actual", "_actual_actual"])
_derived("forecast_error_pct_model", lambda: E.safe_div(F.abs(F.col("_sum_err")), "_sum_actual"),
         ["_sum_err", "_sum_actual"])

STAR_MEASURES = ("total_revenue", "total_orders", "average_order_value", "units_sold", "gross_margin",
                 "gross_margin_pct", "active_customers", "repeat_customers_model", "repeat_customer_rate_model",
                 "conversion_rate", "cart_abandonment_rate")


@dataclass(frozen=True)
class Star:
    """The fact with its relation to dim_customers (JN7 / JN8).  The relation is
    followed after the fact has been reduced to a row per (slicers, customer),
    so order lines never cross the customer join."""
    fact: DataFrame
    customers: DataFrame

    def filter(self, where: Column) -> Star:
        return Star(self.fact.filter(where), self.customers)


def star(fact: DataFrame, dim_customers: DataFrame) -> Star:
    """JN7 / JN8: order lines related to the customer's repeat flag."""
    return Star(fact, dim_customers.select(DISTINCT_KEY, "is_repeat_customer"))


def _expand(names: Sequence[str]) -> tuple[list[str], list[str]]:
    base, derived = [], []

    def need(n):
        if n in BASE:
            if n not in base:
                base.append(n)
        elif n in DERIVED:
            for d in DERIVED[n][1]:
                need(d)
            if n not in derived:
                derived.append(n)
        else:
            raise KeyError(f"unknown measure {n}")

    for n in names:
        need(n)
    return base, derived


def _evaluate_star(star: Star, base: Sequence[str], by: list[str]) -> DataFrame:
    """Two levels: a partial aggregate per (slicers, customer), combined on the
    map side, so a hot customer collapses before the shuffle; the customer's
    flag joins those rows; a merge per slicer value, in which each distinct
    count is a count of flags (no ``Expand``)."""
    rows = star.fact.groupBy(*by, DISTINCT_KEY).agg(*[BASE[n].partial().alias(n) for n in base])
    if "repeat_customers_model" in base:
        rows = rows.join(star.customers, DISTINCT_KEY, "left")
    aggs = [BASE[n].merge(n).alias(n) for n in base]
    return rows.groupBy(*by).agg(*aggs) if by else rows.agg(*aggs)


def evaluate(table: DataFrame | Star, names: Sequence[str], by: Sequence[str] = (),
             where: Column | None = None) -> DataFrame:
    """Evaluate measures of one table in one aggregation pass over it; star
    measures take a ``Star`` and filters and slicers of its fact."""
    base, derived = _expand(names)
    if where is not None:
        table = table.filter(where)
    by = list(by)
    if isinstance(table, Star):
        out = _evaluate_star(table, base, by)
    else:
        aggs = [BASE[n].build().alias(n) for n in base]
        out = table.groupBy(*by).agg(*aggs) if by else table.agg(*aggs)
    for n in derived:
        out = out.withColumn(n, DERIVED[n][0]())
    return out.select(*by, *names)


def with_plan_repeat(out: DataFrame, customers: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add the plan's ``repeat_customers`` (dim_customers with two purchases or
    more, in the same slicer context) and ``repeat_customer_rate`` (ME10: over
    the active customers of the fact) to evaluated star measures."""
    repeat = evaluate(customers, ["repeat_customers"], by=by)
    if by:
        joined = out.join(repeat, list(by), "left").withColumn(
            "repeat_customers", F.coalesce("repeat_customers", F.lit(0)))
    else:
        joined = out.withColumn("repeat_customers", repeat.scalar())
    return joined.withColumn("repeat_customer_rate", E.safe_div("repeat_customers", "active_customers"))


def evaluate_scalar(df: DataFrame | Star, name: str, where: Column | None = None) -> Column:
    """One measure over a whole table as a scalar-subquery Column, for
    combining measures of different tables in one row."""
    return evaluate(df, [name], where=where).scalar()


def display(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """SC9: add ``<measure>_display`` strings in the model's display format
    (measures without a format are left as they are)."""
    cols = {f"{n}_display": E.fmt_measure(n, MEASURE_FORMATS[n]) for n in names
            if n in MEASURE_FORMATS and n in df.columns}
    return df.withColumns(cols)
