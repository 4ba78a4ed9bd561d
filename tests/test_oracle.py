"""Every SQL-backed query against its DuckDB oracle (the driver's check),
on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

SQL = entry.oracle_sql()
NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_is_registered_with_unique_name():
    qs = entry.queries()
    assert set(SQL) <= set(qs)
    assert len(qs) >= 60


SPARK_TO_DUCK = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "DateType()": "DATE", "BooleanType()": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    want_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({SQL[name]})").fetchall()}
    got_types = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
    assert got_types == want_types
    got = df.toPandas()
    want = con.execute(SQL[name]).df()
    ok, msg = compare(got, want)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "week_start"


@pytest.mark.parametrize("name", ["weekly_kpis", "measures_total", "csv_landing_clean"])
def test_results_do_not_depend_on_session_settings(spark, sf_dir, con, name):
    """Same results with ANSI off and many shuffle partitions (a driver's session may differ)."""
    conf = {"spark.sql.ansi.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ok, msg = compare(entry.queries()[name](spark, sf_dir).toPandas(), con.execute(SQL[name]).df())
        assert ok, msg
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
