"""Brute force: the source's pair-listing zone joins, run literally in DuckDB
on whole small tables, against our per-key counts and expanded factors."""

from collections import Counter
from datetime import datetime, timezone
from types import SimpleNamespace

import pytest

from conftest import SF0001, SF001
from footfall.operators import foot_traffic as ft
from footfall.plans.catalog import prepare
from footfall.plans.documents import foot_traffic_factor_docs
from footfall.plans.oracle import M10, M20, RUNNING
from footfall.sources.testdata import table_readings
from oracle_compare import duck
from test_fixtures import expand

PAIRS = RUNNING + f"""
SELECT (a.arrival_us // {M10} * {M10} + {M10}) // {M20} * {M20} AS w20, a.first_ts,
       a.visitors AS n1, b.visitors AS n2, c.visitors AS n3
FROM running a
JOIN running b ON b.zone = 2 AND a.first_ts = b.first_ts
              AND a.arrival_us // {M10} = b.arrival_us // {M10}
JOIN running c ON c.zone = 3 AND c.first_ts = a.first_ts
              AND c.arrival_us // {M20} = (a.arrival_us // {M10} * {M10} + {M10}) // {M20}
WHERE a.zone = 1"""


@pytest.mark.parametrize("source", ["readings", "running"])
@pytest.mark.parametrize("sf,expected", [(SF0001, 0), (SF001, 98)])
def test_factors_equal_brute_force_pairs(spark, sf, expected, source):
    want = Counter(duck(sf).sql(PAIRS).fetchall())
    assert sum(want.values()) == expected
    prepare(spark)
    running = table_readings(spark, sf)
    if source == "running":
        running = ft.running_visitors(running)
    got = expand(ft.foot_traffic_factors(running).collect())
    as_us = Counter({(int(k[0].replace(tzinfo=timezone.utc).timestamp() * 1_000_000)
                      if isinstance(k[0], datetime) else k[0], *k[1:]): v for k, v in got.items()})
    assert as_us == want
    total = ft.foot_traffic_as_coded(running).agg({"documents": "sum"}).first()[0]
    assert (total or 0) == expected


@pytest.mark.parametrize("condition", [" AND a.first_ts = b.first_ts", "c.first_ts = a.first_ts\n              AND "])
def test_the_tables_tell_each_join_key(condition):
    """Without either key condition the list is another one, so a query that dropped it would not pass."""
    assert condition in PAIRS
    con = duck(SF001)
    assert len(con.sql(PAIRS.replace(condition, "")).fetchall()) > 3 * len(con.sql(PAIRS).fetchall()) > 0


def test_documents_alone_expand_to_brute_force_pairs(spark):
    want = Counter(duck(SF001).sql(PAIRS).fetchall())
    prepare(spark)
    docs = foot_traffic_factor_docs(ft.foot_traffic_factors(table_readings(spark, SF001))).collect()
    rows = [SimpleNamespace(window=SimpleNamespace(start=d.window_start * 1_000_000), timestamp=d.timestamp, zone=d.zone,
                            join_window=SimpleNamespace(start=d.join_window_start),
                            visitors_from=d.visitors_from, visitors_to=d.visitors_to) for d in docs]
    assert expand(rows) == want


def test_factor_documents_of_all_sensors(spark):
    """The query's readings are clocked by the day: no pair of zones is lost to the sensors' groups."""
    from footfall.plans.catalog import q_docs_foot_traffic_factors

    want = Counter(duck(SF001).sql(PAIRS.replace(" + 60 * (user_id % 5)", "")).fetchall())
    docs = q_docs_foot_traffic_factors(spark, SF001).collect()
    assert len(docs) == len({d.doc_id for d in docs}) == 4941
    rows = [SimpleNamespace(window=SimpleNamespace(start=d.window_start * 1_000_000), timestamp=d.timestamp, zone=d.zone,
                            join_window=SimpleNamespace(start=d.join_window_start),
                            sensor_uid=d.sensor_uid, visitors_from=d.visitors_from, visitors_to=d.visitors_to) for d in docs]
    assert expand(rows) == want
