"""Shared helpers of the corpus operators: reading tables, stage tables in the
shared checkpoint folder, and the document order."""

from __future__ import annotations

import gc
import os
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import ensure_checkpoint_dir

#: A NULL doc_id sorts after every other one.
NULL_ID = 9223372036854775807


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Covers sessions started outside the repository's folder; on a cluster whose
    machines lack that folder, pass the package with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor rereads files instead of replaying the
    operator, and both consumers of a branch see the same rows."""
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column name as Spark reads it, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def whole_rows(docs: DataFrame) -> DataFrame:
    """(_row, _o, _tag): every row as one struct beside its document's key, so
    that no column of ``docs``, whatever its name, meets a key or a join's
    column; ``select("_row.*")`` gives the rows back."""
    return docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row"),
                       doc_order().alias("_o"), text_tag().alias("_tag"))


def row_tag(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Column:
    """``text_tag`` where some doc_id comes more than once, else a constant: with
    unique ids the second part of the key says nothing and need not travel."""
    again = docs.groupBy(doc_order(doc_id).alias("o")).count().where("count > 1").limit(1).count()
    return text_tag(text) if again else F.lit(0).cast("long")


def release(spark: SparkSession) -> None:
    """Drop shuffle files that no frame refers to any more, before the next large
    shuffle (Spark does so at its own ``spark.cleaner.periodicGC.interval``)."""
    for _ in range(2):  # the cleaner works beside the driver: give it a moment
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.7)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def doc_order(doc_id: str = "doc_id") -> Column:
    """Order of documents as one non-null long: doc_id, NULL last."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID))


def text_tag(text: str = "text") -> Column:
    """Second part of a document's key: tells apart rows which share a doc_id
    but not the text.  Rows equal in both are one document given twice."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())
