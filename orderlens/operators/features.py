"""Feature builders MT1-MT3.

* ``customer_rfm``        one row per customer with a completed order (MT1)
* ``product_weekly_units`` units per product-week + trailing 4-row mean (MT2)
* ``add_funnel_features`` per-order conversion / abandonment (MT3, row-local)
* ``build_features``      the source model's order-level feature frame: the
                          clean fact left-joined to MT1 and MT2 plus MT3

Scale notes: MT1 and MT2 are aggregates (partial aggregation before their
shuffle); the only window (trailing mean) runs on the product-week aggregate,
whose size is bounded by products x weeks, never by order lines.  Marts read
``customer_rfm`` directly instead of the joined-back frame, which avoids
shuffling the wide fact by customer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.constants import CHURN_INACTIVE_DAYS, REPEAT_MIN_ORDERS, ROLLING_WINDOW_ROWS
from orderlens.functions import exprs as E


RFM_COLUMNS = ("customer_id", "days_since_last_purchase", "purchase_frequency",
               "total_revenue", "avg_order_value", "is_repeat_customer", "is_churned")


#: What order lines say of their customer and of their product.
CUSTOMER_ATTRIBUTES = ("customer_segment", "city", "customer_signup_date")
PRODUCT_ATTRIBUTES = ("product_name", "product_category")


def customer_groups(clean: DataFrame) -> DataFrame:
    """Customers, the attributes that lines give them and completion: a few rows
    a customer, from which the attributes of MT5 and ML2 and the signups of AG10
    follow without another pass over the lines."""
    return clean.select("customer_id", *CUSTOMER_ATTRIBUTES, "is_completed").distinct()


def product_groups(clean: DataFrame) -> DataFrame:
    """Lines by product and the attributes that they give it, for MT6."""
    return (clean.groupBy("product_id", *PRODUCT_ATTRIBUTES)
            .agg(F.sum("unit_price").alias("_price"), F.count("unit_price").alias("_price_n")))


def first_values(groups: DataFrame, clean: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """First non-missing value of each column in row order per ``key``, which is
    not missing (CL6); ``groups`` are the groups of the lines of ``clean``.

    A first value by row order holds text, so its aggregate sorts the lines.  It
    is asked only of keys whose lines differ in a column; for others their one
    row of values is the answer, and rows of fixed width are hashed."""
    values = groups.select(key, *columns).distinct()
    differ = values.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(key)
    if differ.isEmpty():
        return values
    o = F.struct("order_date", "order_id")
    by_line = (clean.join(differ, key, "left_semi").groupBy(key)
               .agg(*[E.first_by(c, o).alias(c) for c in columns]))
    return values.join(differ, key, "left_anti").unionByName(by_line)


def snapshot_date(df: DataFrame):
    """Latest order date over *all* orders, as a scalar-subquery Column."""
    return df.agg(F.max("order_date")).scalar()


def customer_rfm(clean: DataFrame, churn_days: int = CHURN_INACTIVE_DAYS,
                 repeat_min_orders: int = REPEAT_MIN_ORDERS,
                 keep_decimal: bool = False) -> DataFrame:
    """MT1: recency / frequency / value over completed orders.

    Recency is measured from the snapshot (max order date over all orders).
    ``total_revenue`` is summed exactly (DECIMAL) and returned as DOUBLE
    unless ``keep_decimal``; the mean is ``sum / count``."""
    snap = snapshot_date(clean)
    rev_sum = F.sum("revenue")
    rfm = (clean.filter(F.col("is_completed"))
           .groupBy("customer_id")
           .agg(F.max("order_date").alias("last_purchase_date"),
                F.count("order_id").alias("purchase_frequency"),
                rev_sum.alias("_rev"),
                F.count("revenue").alias("_rev_n"),
                F.sum("quantity").alias("total_units")))
    total = F.col("_rev") if keep_decimal else F.col("_rev").cast("double")
    return (rfm
            .withColumn("days_since_last_purchase",
                        F.datediff(snap, F.col("last_purchase_date")).cast("bigint"))
            .withColumn("total_revenue", total)
            .withColumn("avg_order_value", F.col("_rev").cast("double") / F.col("_rev_n"))
            .withColumn("is_repeat_customer", F.col("purchase_frequency") >= repeat_min_orders)
            .withColumn("is_churned", F.col("days_since_last_purchase") >= churn_days)
            .select("customer_id", "last_purchase_date", "days_since_last_purchase",
                    "purchase_frequency", "total_revenue", "avg_order_value", "total_units",
                    "is_repeat_customer", "is_churned"))


def add_customer_features(clean: DataFrame, rfm: DataFrame | None = None) -> DataFrame:
    """JN1: order rows left-joined to their customer's RFM row."""
    rfm = customer_rfm(clean) if rfm is None else rfm
    return clean.join(rfm.select(*RFM_COLUMNS), "customer_id", "left")


def product_weekly_units(clean: DataFrame, window_rows: int = ROLLING_WINDOW_ROWS) -> DataFrame:
    """MT2: completed units per (product, week) and the mean of the current
    and previous ``window_rows - 1`` product-week rows (min 1 row)."""
    w = (Window.partitionBy("product_id").orderBy("week_start")
         .rowsBetween(-(window_rows - 1), Window.currentRow))
    return (clean.filter(F.col("is_completed"))
            .groupBy("product_id", "week_start")
            .agg(F.sum("quantity").alias("weekly_units"))
            .withColumn("rolling_4w_units", F.avg("weekly_units").over(w)))


def add_product_features(df: DataFrame, weekly: DataFrame | None = None) -> DataFrame:
    """JN2: order rows left-joined to their product-week trend row."""
    weekly = product_weekly_units(df) if weekly is None else weekly
    return df.join(weekly, ["product_id", "week_start"], "left")


def add_funnel_features(df: DataFrame) -> DataFrame:
    """MT3: per-order conversion and cart abandonment; zero denominators give
    NULL, values are clipped to [0, 1]."""
    return df.withColumns({
        "conversion_rate": E.clip01(E.ratio("completed_orders", "visits")),
        "cart_abandonment_rate": E.clip01(F.lit(1.0) - E.ratio("completed_orders", "cart_additions")),
    })


def build_features(clean: DataFrame) -> DataFrame:
    """The order-level feature frame (clean + MT1 + MT2 + MT3)."""
    df = add_customer_features(clean)
    df = add_product_features(df, product_weekly_units(clean))
    return add_funnel_features(df)
