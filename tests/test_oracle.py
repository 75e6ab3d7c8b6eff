"""Every registered query against its DuckDB twin (the driver's gate)."""

import pytest

import __spark_entry__ as E
from conftest import SF0001, SF001
from footfall.plans import catalog
from oracle_compare import compare, duck

QUERIES = E.queries()
OWN = catalog.QUERIES
SQL = E.oracle_sql()


def test_every_query_has_an_oracle():
    """The library's own; corpus queries that SQL cannot express are tested by brute force in tests/llm."""
    assert set(OWN) <= set(SQL) <= set(QUERIES)


@pytest.fixture(scope="module")
def con_small():
    return duck(SF0001)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb_sf0001(spark, con_small, name):
    r = compare(spark, SF0001, name, QUERIES[name], SQL[name], con_small)
    assert r["names_match"], (r["spark_cols"], r["duck_cols"])
    assert r["spark_rows"] == r["duck_rows"]
    assert r["hash_match"]


@pytest.mark.parametrize("name", ["foot_traffic_as_coded", "traffic_jam_as_coded",
                                  "offer_recipients", "customer_journey", "sale_sessions"])
def test_matches_duckdb_sf001(spark, name):
    r = compare(spark, SF001, name, QUERIES[name], SQL[name])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "category", "date", "total_sales"]


def test_outputs_carry_no_timestamps(spark):
    """Instants leave as epoch numbers, so Spark and DuckDB values compare
    exactly whatever the session time zone."""
    from pyspark.sql import types as T

    for name, q in OWN.items():
        df = q(spark, SF0001)
        bad = [f.name for f in df.schema.fields
               if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.StructType))]
        assert not bad, (name, bad)
