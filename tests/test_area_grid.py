"""The areas table against a plain loop over all boxes, and against the configured CASE."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from footfall.operators import area_grid as G
from footfall.operators import proximity
from footfall.schemas import READING
from footfall.sources.testdata import table_readings


def _inside(lat, lon, a) -> bool:
    _, _, lat_lo, lat_hi, lon_lo, lon_hi, *closed = a
    low = [v > b or (c and v == b) for v, b, c in ((lat, lat_lo, closed[0]), (lon, lon_lo, closed[2]))]
    high = [v < b or (c and v == b) for v, b, c in ((lat, lat_hi, closed[1]), (lon, lon_hi, closed[3]))]
    return all(low + high)


def _plain(points, areas):
    return {i: max(((a[1], a[0]) for a in areas if _inside(lat, lon, a)), default=(0, None))[1] if lat is not None and lon is not None else None
            for i, lat, lon in points}


def _boxes(rng, n, size):
    rows = []
    for k in range(n):
        lat, lon = (float(x) / 8 for x in rng.integers(-80, 80, 2))
        high, wide = (float(x) / 8 for x in rng.integers(0, size, 2))
        rows.append((f"a{k}", int(k // 2), lat, lat + high, lon, lon + wide, *[bool(x) for x in rng.integers(0, 2, 4)]))
    return rows


@pytest.mark.parametrize("n,size,limit", [(5, 4, 64), (300, 6, 64), (300, 160, 64), (300, 40, 3), (1, 1, 64)])
def test_grid_equals_a_loop_over_boxes(spark, monkeypatch, n, size, limit):
    """Points on edges, overlapping and huge boxes, equal positions, crowded cells."""
    monkeypatch.setattr(G, "LIST", limit)
    rng = np.random.default_rng(n + size)
    areas = _boxes(rng, n, size)
    points = [(i, float(a) / 8, float(b) / 8) for i, (a, b) in enumerate(rng.integers(-90, 110, (500, 2)))] + [(900, None, 0.0), (901, float("nan"), 0.0)]
    df = spark.createDataFrame(points, "id long, latitude double, longitude double")
    table = spark.createDataFrame(areas, G.AREAS_SCHEMA)
    for base in (None, 0.05):
        got = {r.id: r.area for r in G.classify_by_table(df, table, base=base).collect()}
        assert got == _plain(points, areas)


def test_default_areas_equal_the_configured_case(spark):
    r = table_readings(spark, SF0001)
    got = G.classify_by_table(r, G.areas_table(spark)).select("id", "area")
    want = proximity.classify_area(r).select("id", "area")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_awkward_areas(spark):
    nan = float("nan")
    rows = [("none", 1, None, 1.0, 0.0, 1.0, True, True, True, True), ("nan", 2, nan, 1.0, 0.0, 1.0, True, True, True, True),
            ("back", 3, 1.0, 0.0, 0.0, 1.0, True, True, True, True), ("point", 4, 0.5, 0.5, 0.5, 0.5, True, True, True, True), ("open", 0, 0.0, 1.0, 0.0, 1.0, None, None, None, None)]
    table = spark.createDataFrame(rows, G.AREAS_SCHEMA)
    df = spark.createDataFrame([(1, 0.5, 0.5, "x"), (2, 0.0, 0.5, "x"), (3, 0.2, 0.2, "x"), (3, 0.2, 0.2, "x")], "id long, latitude double, longitude double, area string")
    got = G.classify_by_table(df, table)
    assert got.columns == ["id", "latitude", "longitude", "area"]
    assert sorted((r.id, r.area) for r in got.collect() if r.area) == [(1, "point"), (3, "open"), (3, "open")] and got.count() == 4
    assert {r.area for r in G.classify_by_table(df, table.where("false")).collect()} == {None}
    assert G.classify_by_table(df.where("false"), table).count() == 0


def test_plan_has_no_nested_loop_and_no_shuffle_of_readings(spark):
    from footfall.plans.catalog import q_classify_by_table

    plan = q_classify_by_table(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "BroadcastHashJoin" in plan


def test_sides_beyond_the_bound_are_shuffled(spark, monkeypatch):
    """Cells and boxes beyond ``BROADCAST`` do not pass through the driver, however small the planner takes them to be."""
    monkeypatch.setattr(G, "LIST", 8)
    monkeypatch.setattr(G, "PART", 16)
    monkeypatch.setattr(G, "BROADCAST", 10)
    rng = np.random.default_rng(5)
    areas = _boxes(rng, 400, 40)
    points = [(i % 7, float(a) / 8, float(b) / 8) for i, (a, b) in enumerate(rng.integers(-90, 110, (400, 2)))]  # ids repeat
    df = spark.createDataFrame(points, "id long, latitude double, longitude double")
    got = G.classify_by_table(df, spark.createDataFrame(areas, G.AREAS_SCHEMA))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    want = sorted((i, lat, lon, _plain([(i, lat, lon)], areas)[i]) for i, lat, lon in points if _plain([(i, lat, lon)], areas)[i])
    assert sorted(tuple(r) for r in got.collect() if r.area) == want and got.count() == len(points)


def test_boxes_below_one_that_spans_the_cell_are_left_out(spark):
    areas = [(f"a{k}", k, 0.5, 3.5, 0.5, 3.5, True, True, True, True) for k in range(3)]
    cells = G.grid_cells(spark.createDataFrame(areas, G.AREAS_SCHEMA), 1.0).collect()
    assert len(cells) == 3 * 16 and {(r.x, r.y) for r in cells if r.spans} == {(x, y) for x in (1, 2) for y in (1, 2)}


def test_stream_equals_batch(spark, scratch):
    from footfall.sources.files import stream_files

    r = table_readings(spark, SF0001).select([f.name for f in READING.fields])
    r.write.parquet(f"{scratch}/in")
    areas = G.areas_table(spark)
    q = (G.classify_by_table(stream_files(spark, f"{scratch}/in", READING), areas).select("id", "area").writeStream.format("memory")
         .queryName("s_grid").option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    want = G.classify_by_table(r, areas).select("id", "area")
    assert spark.table("s_grid").where(F.col("area").isNotNull()).count() > 0
    assert sorted(map(tuple, spark.table("s_grid").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
