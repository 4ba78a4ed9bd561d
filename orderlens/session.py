"""Session helpers: building a local session and locating the shared
checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "orderlens", extra: dict | None = None) -> SparkSession:
    """Local session used by tests and the bench.  On a cluster the session
    comes from the launcher and only ``ensure_checkpoint_dir`` is applied."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it; we only invent a scratch folder when it is unset,
    which happens in local tests."""
    jsc = spark.sparkContext._jsc
    current = jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS / object "
                               "store) for stage tables; a machine-local folder is not visible to "
                               "every executor")
        conf_dir = tempfile.mkdtemp(prefix="orderlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(conf_dir)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the input files (metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            total += int(fs.getContentSummary(hp).getLength())
    return total


def input_version(spark: SparkSession, folder: str, tables=()) -> str:
    """Size and latest change of the files of an input folder, or of the named
    tables in it (metadata only): another value means that something was added,
    removed or rewritten."""
    jvm = spark.sparkContext._jvm
    size = count = latest = 0
    for place in [f"{folder}/{t}.parquet" for t in tables] or [folder]:
        hp = jvm.org.apache.hadoop.fs.Path(place)
        fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files = fs.listFiles(hp, True)
        while files.hasNext():
            f = files.next()
            size, count, latest = size + f.getLen(), count + 1, max(latest, f.getModificationTime())
    return f"{count}-{size}-{latest}"


def scale_conf(total_input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle sizing for a given input: enough shuffle partitions that the
    widest shuffle (the order-line fact, ~3x its compressed Parquet size once
    decoded) lands near ``target_partition_bytes`` per partition, never fewer
    than 2 per core; AQE then coalesces small partitions and splits skewed
    ones.  Scan splits stay at 128 MB."""
    decoded = total_input_bytes * 3
    parts = max(2 * cores, -(-decoded // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
    }
