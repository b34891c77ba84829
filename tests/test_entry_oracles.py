"""Every registered query against its DuckDB oracle, at sf0.001 (the driver does sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v.isoformat() if hasattr(v, "isoformat") else v


def _sorted_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_contract_keys():
    assert set(E.oracle_sql()) <= set(E.queries())
    # the queries on the record stream all have SQL; some on documents can't have it
    assert {n for n in E.queries() if not n.startswith("op") and n != "pipeline"} <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "_lsn" in df.columns


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    duck_types = {d[0]: str(d[1]) for d in res.description}
    assert {n: TYPE_MAP.get(t, t) for n, t in df.dtypes} == duck_types
    assert _sorted_rows(df.columns, got) == _sorted_rows(ocols, res.fetchall())


@pytest.mark.parametrize("name", ["sliding_event_counts", "sliding_stream", "probe_rates", "log_file_progress"])
def test_time_queries_do_not_depend_on_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF)
        got = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert _sorted_rows(df.columns, got) == _sorted_rows(ocols, res.fetchall())
