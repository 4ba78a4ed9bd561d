"""File sources and sinks (IO1, IO2, IO4-IO8).

* ``read_raw_csv``    CSV landing zone, every column read as text, plus a
                      file-position key so keep-first de-duplication follows
                      file order (IO1; a missing path raises IO2's error)
* ``clean_raw_csv``   IO1 + CL8 for the landing zone
* ``write_parquet`` / ``write_csv``  overwrite sinks (IO4 / IO5)
* ``SERVING_SCHEMAS`` / ``read_serving_csv``  typed load of every serving table
                      with no quote handling (IO6)
* ``load_bundle``     the dashboard's table bundle as temp views (IO7)
* ``export_serving`` / ``export_manifest``  write the 12 serving tables and
                      report expected vs present (IO8)
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.constants import EXPECTED_TABLES as EXPECTED_TABLES_FIXED
from orderlens.constants import MISSING_WORDS
from orderlens.functions import exprs as E
from orderlens.operators import clean as C

RAW_DATE_COLUMNS = ("order_date", "customer_signup_date", "last_purchase_date")
FILE_POSITION = "_file_pos"
CORRUPT_RECORD = "_corrupt_record"
COUNT_COLUMNS = ("visits", "cart_additions", "completed_orders")
#: Exact type of landing numbers.  What does not fit (more than six decimals, 1e22
#: and more, infinite) is counted by ``landing_audit`` and kept by ``uncut``.
LANDING_DECIMAL = "decimal(28,6)"
#: Rows of a compressed CSV file.
GZIP_ROWS = 1_000_000


def _alike(files: list[str]) -> tuple[str, str]:
    """What all paths begin with and, where they are of one length (else their
    order could change without it), what they end with."""
    same = os.path.commonprefix(files)
    rest = [f[len(same):][::-1] for f in files]
    return same, os.path.commonprefix(rest)[::-1] if len({len(r) for r in rest}) == 1 else ""


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """IO1: header CSV, all columns as STRING (no inference), missing words as
    NULL, plus ``_file_pos`` = (file path without what all paths begin with,
    split start, row id within the split), a total order equal to file order, and ``_corrupt_record``, the
    text of a row with too few or too many fields (else NULL; such rows stay).

    Quotes are doubled inside quoted fields.  Fields that hold line breaks need
    ``multi_line``, which reads each file in one task.  A missing path raises
    ``AnalysisException`` (PATH_NOT_FOUND) when the frame is defined (IO2)."""
    reader = (spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE")
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line))
    found = reader.csv(path)
    # listed as file:///..., in the rows as file:/...
    names, files = found.columns, [f.replace("file:///", "file:/", 1) for f in found.inputFiles()]
    same, end = _alike(files)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT_RECORD]])
    df = reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT_RECORD).option(
        "columnPruning", False).csv(path)  # a pruned read would not see that a row is too short
    file = F.col("_metadata.file_path")
    within = file.substr(F.lit(len(same) + 1), F.length(file) - F.lit(len(same) + len(end)))
    pos = F.struct(F.when(file.startswith(same) & file.endswith(end), within).otherwise(file).alias("f"),
                   F.col("_metadata.file_block_start").alias("b"),
                   F.monotonically_increasing_id().alias("r"))
    known = {c: F.when(~F.col(f"`{c}`").isin(*MISSING_WORDS), F.col(f"`{c}`")) for c in names}
    return df.withColumn(FILE_POSITION, pos).withColumns(known)


def parse_dates(df: DataFrame, cols=RAW_DATE_COLUMNS) -> DataFrame:
    """Date columns of a text landing zone: unparseable -> NULL."""
    present = [c for c in cols if c in df.columns and dict(df.dtypes)[c] == "string"]
    return df.withColumns({c: F.try_to_date(F.trim(F.col(c))) for c in present}) if present else df


def _parse_numbers(raw: DataFrame) -> DataFrame:
    """Numbers and counts of a text landing zone, before keep-first: half the
    width of their text in the rows that it shuffles."""
    return raw.withColumns({
        **{c: E.coerce_double(c).try_cast("bigint") for c in COUNT_COLUMNS if c in raw.columns},
        **{c: E.coerce_double(c) for c in C.NUMERIC_COLUMNS if c in raw.columns}})


def clean_raw_csv(spark: SparkSession, path: str, completed_status: str = C.COMPLETED_STATUS,
                  multi_line: bool = False, uncut: bool = False, columns=None) -> DataFrame:
    """IO1 + CL8: keep-first in file order, coercing casts, rules, dates.  With
    ``uncut`` every number and count is there once more, as the DOUBLE that the
    file holds, in a column ``<name>_uncut``.  ``columns`` names those that are
    read further; with them only these and what the rules read go through the
    shuffle of keep-first (its rows are structs, which Spark does not prune).

    Counts may be written as ``3.0`` (a count column with a missing value);
    numbers leave as exact decimals once the rules have seen them."""
    raw = parse_dates(read_raw_csv(spark, path, multi_line)).drop(CORRUPT_RECORD)
    if uncut:
        raw = raw.withColumns({f"{c}_uncut": E.coerce_double(c) for c in (*C.NUMERIC_COLUMNS, *COUNT_COLUMNS)
                               if c in raw.columns})
    raw = _parse_numbers(raw)
    if columns is not None:
        kept = {*columns, *C.KEY_COLUMNS, *C.NUMERIC_COLUMNS, "order_status", FILE_POSITION}
        raw = raw.select(*[c for c in raw.columns if c in kept])
    out = C.clean(raw, completed_status=completed_status, dedup_order=[FILE_POSITION])
    return out.drop(FILE_POSITION).withColumns(
        {c: F.col(c).try_cast(LANDING_DECIMAL) for c in C.NUMERIC_COLUMNS if c in out.columns})


def clean_raw_csv_audited(spark: SparkSession, path: str, completed_status: str = C.COMPLETED_STATUS,
                          multi_line: bool = False):
    """``clean_raw_csv`` and its counts by rule (``clean.clean_with_audit``)."""
    raw = parse_dates(read_raw_csv(spark, path, multi_line)).drop(CORRUPT_RECORD)
    raw = _parse_numbers(raw)
    out, counts = C.clean_with_audit(raw, completed_status=completed_status, dedup_order=[FILE_POSITION])
    return out.drop(FILE_POSITION).withColumns(
        {c: F.col(c).try_cast(LANDING_DECIMAL) for c in C.NUMERIC_COLUMNS if c in out.columns}), counts


def _inexact(columns) -> Column:
    """Does a row hold a number that ``LANDING_DECIMAL`` cuts or drops, or a
    count that is no whole number?"""
    cut = F.lit(False)
    for c in columns:
        x = E.coerce_double(c)
        if c in C.NUMERIC_COLUMNS:
            kept = x.try_cast(LANDING_DECIMAL).try_cast("double")
        elif c in COUNT_COLUMNS:
            kept = x.try_cast("bigint").try_cast("double")
        else:
            continue
        cut = cut | (x.isNotNull() & ~kept.eqNullSafe(x))
    return cut


def landing_audit(spark: SparkSession, path: str, completed_status: str = C.COMPLETED_STATUS,
                  multi_line: bool = False) -> DataFrame:
    """IO10 of the landing zone in one row: rows read, corrupt rows among them,
    rows with a number or count that its column cannot hold uncut, distinct
    order ids, rows after the rules."""
    raw = read_raw_csv(spark, path, multi_line)
    raw = raw.select("order_id", CORRUPT_RECORD, _inexact(raw.columns).alias("_cut")).agg(
        F.count(F.lit(1)).alias("rows_read"), F.count(CORRUPT_RECORD).alias("rows_corrupt"),
        F.count_if("_cut").alias("rows_inexact"),
        (F.count_distinct("order_id") + F.max(F.col("order_id").isNull().cast("int"))).alias("rows_after_dedup"))
    after = clean_raw_csv(spark, path, completed_status, multi_line).agg(F.count(F.lit(1))).scalar()
    return raw.select("*", after.alias("rows_after"))


def write_parquet(df: DataFrame, path: str) -> None:
    """IO4."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, compressed: bool = False) -> None:
    """IO5: header CSV directory (one part per task), dates as yyyy-MM-dd.

    ``compressed`` writes ``.csv.gz``.  A gzip file is read by one task, so a
    part then ends after ``GZIP_ROWS`` rows, however many a task holds."""
    writer = (df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd")
              .option("escape", '"'))
    if compressed:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", GZIP_ROWS)
    writer.csv(path)


def _schema(spec: str) -> T.StructType:
    return T.StructType.fromDDL(spec)  # DDL "a string, b double, ..."


# IO6: declared column types of the serving tables (fixed values of the model).
SERVING_SCHEMAS: Mapping[str, str] = {
    "fact_orders": ("order_id string, order_date date, week_start date, year bigint, month bigint, "
                    "week_number bigint, quarter bigint, customer_id string, customer_segment string, "
                    "product_id string, product_category string, product_name string, quantity bigint, "
                    "unit_price double, discount double, revenue double, margin double, city string, "
                    "sales_channel string, campaign_name string, visits bigint, cart_additions bigint, "
                    "completed_orders bigint, payment_method string, order_status string, "
                    "is_completed boolean, conversion_rate double, cart_abandonment_rate double"),
    "dim_customers": ("customer_id string, customer_segment string, city string, customer_signup_date date, "
                      "days_since_last_purchase bigint, purchase_frequency bigint, total_revenue double, "
                      "avg_order_value double, is_repeat_customer boolean, is_churned boolean"),
    "dim_products": "product_id string, product_name string, product_category string, unit_price double",
    "dim_date": ("date date, week_start date, year bigint, quarter bigint, month bigint, month_name string, "
                 "week_number bigint, year_week string"),
    "weekly_kpis": ("week_start date, total_revenue double, total_orders bigint, total_units bigint, "
                    "total_margin double, avg_order_value double, unique_customers bigint, "
                    "avg_discount double, visits bigint, cart_additions bigint, completed_orders bigint, "
                    "gross_margin_pct double, conversion_rate double, cart_abandonment_rate double, "
                    "revenue_wow_growth double, orders_wow_growth double, new_customers bigint, "
                    "repeat_customers bigint"),
    "campaign_performance": ("campaign_name string, total_revenue double, total_orders bigint, "
                             "unique_customers bigint, avg_order_value double, total_margin double, "
                             "avg_discount double, gross_margin_pct double, revenue_share double"),
    "sales_channel_performance": ("sales_channel string, total_revenue double, total_orders bigint, "
                                  "unique_customers bigint, avg_order_value double, total_margin double, "
                                  "avg_discount double, gross_margin_pct double, revenue_share double"),
    "segment_performance": ("customer_segment string, total_revenue double, total_orders bigint, "
                            "unique_customers bigint, avg_order_value double, total_margin double, "
                            "repeat_customers bigint, gross_margin_pct double, repeat_rate double"),
    "sales_forecast": ("week_start date, actual_revenue double, predicted_revenue double, "
                       "prediction_error double, model_name string, is_future boolean"),
    "customer_churn_risk": ("customer_id string, customer_segment string, days_since_last_purchase bigint, "
                            "total_revenue double, purchase_frequency bigint, avg_order_value double, "
                            "churn_risk_probability double, risk_level string"),
    "product_demand_predictions": ("product_category string, week date, actual_units_sold bigint, "
                                   "demand_trend string, predicted_units_sold bigint"),
    "model_performance": ("model string, algorithm string, target string, metric_type string, "
                          "metric_name string, metric_value double"),
}

EXPECTED_TABLES = EXPECTED_TABLES_FIXED
assert set(EXPECTED_TABLES) == set(SERVING_SCHEMAS)


def serving_schema(name: str) -> T.StructType:
    return _schema(SERVING_SCHEMAS[name])


def read_serving_csv(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """IO6: typed CSV load (comma, UTF-8, header promoted, no quote handling)."""
    return (spark.read.schema(serving_schema(name)).option("header", True)
            .option("quote", "\u0000").option("encoding", "UTF-8").option("dateFormat", "yyyy-MM-dd")
            .csv(os.path.join(folder, name)))


def conform(df: DataFrame, name: str) -> DataFrame:
    """Cast a computed table to its declared serving schema (column order too)."""
    schema = serving_schema(name)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_bundle(spark: SparkSession, folder: str, names=("fact_orders", "weekly_kpis", "sales_forecast",
                                                        "customer_churn_risk", "product_demand_predictions",
                                                        "segment_performance", "campaign_performance",
                                                        "dim_customers")) -> dict[str, DataFrame]:
    """IO7: the dashboard bundle as typed frames, also registered as temp views."""
    out = {}
    for n in names:
        df = read_serving_csv(spark, folder, n)
        df.createOrReplaceTempView(n)
        out[n] = df
    return out


def export_serving(tables: Mapping[str, DataFrame], folder: str, parallel: int = 4, compressed: bool = False) -> None:
    """Write every computed serving table as CSV under ``folder/<name>``; the
    independent write jobs are submitted concurrently from a small pool."""
    from concurrent.futures import ThreadPoolExecutor

    def write(item):
        name, df = item
        write_csv(conform(df, name), os.path.join(folder, name), compressed)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(write, tables.items()))


# ---------------------------------------------------------------------------
# Published versions: a bundle is readable only once it is whole
# ---------------------------------------------------------------------------

_VERSIONS, _POINTERS = "versions", "pointers"


class PublishError(RuntimeError):
    """A version was written but not switched to."""


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _pointers(spark: SparkSession, root: str) -> list[str]:
    """Pointers of a published folder, the oldest first: ``<number>.<version>``."""
    fs, folder = _fs(spark, os.path.join(root, _POINTERS))
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder))


def current(spark: SparkSession, root: str) -> str | None:
    """Folder of the version that the last pointer names; None before the first."""
    names = _pointers(spark, root)
    return os.path.join(root, _VERSIONS, names[-1].split(".", 1)[1]) if names else None


def publish(tables: Mapping[str, DataFrame], root: str, write=None) -> str:
    """IO4 / IO5 as one step: write all tables into a new version folder, check
    its manifest, then switch readers to it by creating one empty pointer file.
    Versions stay beside one another, so their CSV is compressed.

    A run that fails before the switch leaves the version before it readable;
    its half-written folder is never named by a pointer.  Raises
    ``PublishError`` if a table is missing or two runs switch at once."""
    spark = next(iter(tables.values())).sparkSession
    version = uuid.uuid4().hex
    folder = os.path.join(root, _VERSIONS, version)
    (write or partial(export_serving, compressed=True))(tables, folder)
    whole = {r["table"]: r["status"] for r in export_manifest(spark, folder).collect()}
    lost = [t for t in tables if whole.get(t, "MISSING") != "OK"]
    if lost:
        raise PublishError(f"not switched: {lost} missing in {folder}")
    names = _pointers(spark, root)
    number = int(names[-1].split(".")[0]) + 1 if names else 0
    fs, pointer = _fs(spark, os.path.join(root, _POINTERS, f"{number:012d}.{version}"))
    if not fs.createNewFile(pointer):
        raise PublishError(f"not switched: {pointer} exists")
    same = [n for n in _pointers(spark, root) if n.startswith(f"{number:012d}.")]
    if len(same) > 1 and same[-1] != pointer.getName():
        raise PublishError(f"not switched: another run published at the same time ({same[-1]})")
    return folder


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` published versions (and what failed
    runs left); returns the versions removed."""
    names = _pointers(spark, root)
    held = {n.split(".", 1)[1] for n in names[-keep:]}
    fs, folder = _fs(spark, os.path.join(root, _VERSIONS))
    gone = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in held] if fs.exists(folder) else []
    for n in names[:-keep]:
        fs.delete(_fs(spark, os.path.join(root, _POINTERS, n))[1], False)
    for path in gone:
        fs.delete(path, True)
    return [p.getName() for p in gone]


def _dir_size(spark: SparkSession, path: str) -> int | None:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return None
    return int(fs.getContentSummary(hpath).getLength())


def export_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """IO8: expected tables vs written ones, with size, row count and status.
    Listing is metadata only; the row counts of all tables are one job."""
    sizes = {name: _dir_size(spark, os.path.join(folder, name)) for name in EXPECTED_TABLES}
    listed = spark.createDataFrame(
        [(name, None if size is None else round(size / 1024.0, 1)) for name, size in sizes.items()],
        "table string, size_kb double")
    counts = spark.createDataFrame([], "t string, n bigint")
    for name, size in sizes.items():
        if size is not None:
            counts = counts.unionByName(read_serving_csv(spark, folder, name).select(F.lit(name).alias("t")).groupBy(
                "t").agg(F.count(F.lit(1)).alias("n")))
    written = F.col("size_kb").isNotNull()
    return (listed.join(counts, F.col("table") == F.col("t"), "left")
            .select("table", F.when(written, "OK").otherwise("MISSING").alias("status"), "size_kb",
                    F.when(written, F.coalesce("n", F.lit(0))).cast("bigint").alias("rows")))
