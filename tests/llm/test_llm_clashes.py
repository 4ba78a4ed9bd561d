"""Pipeline stages keep the values and types of columns with clashing names."""
import pytest
from pyspark.sql import functions as F

from orderlens.llm import decontaminate, quality, secrets, simhash

NAMES = ["_o", "_tag", "_row", "_live", "_vo", "_vt", "_ho", "_so", "_verdicts", "a.b", "a`c", "root", "n_words", "c0", "text "]
TEXT = " ".join(f"word{i}" for i in range(40))


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, f"{TEXT} number{i * i} password = 'Zx9kQ2mLp8Rt4Vw{i}'" if i else None, *[f"{n}-{i}" for n in NAMES], i / 2)
            for i in range(8)]
    fields = ["doc_id", "text", *NAMES, "x"]
    kinds = ["long", "string", *["string"] * len(NAMES), "double"]
    schema = ", ".join(f"`{n.replace('`', '``')}` {k}" for n, k in zip(fields, kinds))
    return spark.createDataFrame(rows, schema).withColumn("source", F.col("doc_id").cast("string"))


def stages(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    bench = spark.createDataFrame([(0, " ".join(f"other{i}" for i in range(30)))], "item_id long, text string")
    return {
        "quality": lambda d: quality.keep_good(d, labels), "simhash": simhash.one_of_each,
        "benchmark": lambda d: decontaminate.without_benchmark(d, bench), "secrets": secrets.redact_live,
    }


@pytest.mark.parametrize("name", ["quality", "simhash", "benchmark", "secrets"])
def test_clashing_columns_keep_values(spark, clashing, name):
    out = stages(spark)[name](clashing)
    assert out.schema.names == clashing.schema.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in clashing.schema]
    before = {r[0]: tuple(r) for r in clashing.collect()}
    rows = out.collect()
    assert rows
    for r in rows:
        got, want = tuple(r), before[r[0]]
        assert got[:1] + got[2:] == want[:1] + want[2:]
        assert (got[1] == want[1]) if name != "secrets" or want[1] is None else secrets.REDACTED in got[1]
    assert stages(spark)[name](clashing.limit(0)).collect() == []
