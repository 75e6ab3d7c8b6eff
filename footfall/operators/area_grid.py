"""Point-in-box classification against a table of areas, by a grid index.

A shop is a row: ``name``, the four bounds ``lat_lo lat_hi lon_lo lon_hi``, one
flag per bound that says whether the bound itself is inside (``lat_lo_closed``
and so on), and ``position``. A reading gets the name of the matching area with
the greatest position (the last match wins), or null.

* ``grid_cells`` cuts every box into the cells of a square grid that it
  touches. Grids come in levels, each twice as coarse as the one before; a box
  goes to the finest level where it touches at most ``SPAN`` x ``SPAN`` cells,
  so a large box costs no more rows than a small one.
* A reading has one cell per level in use (few: each doubles the size of the
  boxes it holds). Per level, one equi-join on the cell brings the cell's boxes
  as one array, sorted by position, and an exact test with open and closed
  bounds picks the last match inside the row. No row is multiplied or shuffled
  back together, and there is no range condition in any join.
* A cell under more than ``LIST`` boxes (many overlapping areas) is not held as
  an array: its boxes stay rows, dealt over one salt per ``PART`` boxes, and the
  distinct points in it meet them in an equi-join of their own, reduced by
  ``max`` per point. Boxes below one that spans the whole cell are left out
  there: no point of the cell can be theirs.

A level's cells are broadcast only while they hold at most ``BROADCAST`` boxes
together (counted); beyond that both sides are shuffled by cell, and AQE splits a cell
that holds many readings. Joins whose sides no count bounds ask for a shuffle
by name: the planner's estimate, from the size of the areas' files, knows
nothing of the cells that a box is cut into.

Readings without coordinates are in no area. Areas with a null bound, or with
bounds that hold nothing, match nothing; null flags count as open. Of areas
with equal positions the greater name wins. An empty table gives null areas.
Streams work as batch does, except that crowded cells are held as arrays too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.areas import ZONE1_AREAS

SPAN = 4  # cells that a box may touch per direction
LIST = 64  # boxes that a cell holds as an array
PART = 4096  # boxes per salt of a crowded cell
BROADCAST = 200_000  # boxes in cells, some 100 bytes each

BOUNDS = ("lat_lo", "lat_hi", "lon_lo", "lon_hi")
AREAS_SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("position", T.LongType()),
                             *[T.StructField(b, T.DoubleType()) for b in BOUNDS], *[T.StructField(f"{b}_closed", T.BooleanType()) for b in BOUNDS]])


def areas_table(spark: SparkSession, areas=ZONE1_AREAS) -> DataFrame:
    """The configured areas as a table; their order is their position."""
    rows = [(a.name, i, *(getattr(a, b) for b in BOUNDS), *(getattr(a, f"{b}_closed") for b in BOUNDS)) for i, a in enumerate(areas)]
    return spark.createDataFrame(rows, AREAS_SCHEMA)


def _cell(value: Column, level: Column | int, base: float) -> Column:
    """Number of the cell along one direction. Never decreasing in ``value``, so a box's cells hold its points."""
    return F.floor(value / (F.lit(base) * F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level))).cast("long")


def grid_cells(areas: DataFrame, base: float) -> DataFrame:
    """``level, x, y, box, spans`` for every cell that a box touches; ``base`` is the finest grid's cell size in degrees.

    ``spans``: the box's bounds lie in other cells on all four sides, so every point of the cell is inside it.
    """
    whole = areas
    for b in BOUNDS:
        whole = whole.where(F.col(b).isNotNull() & ~F.isnan(b) & (F.abs(b) < float("inf")))
    boxes = whole.where("lat_lo <= lat_hi and lon_lo <= lon_hi").withColumn("box", F.struct(
        F.col("position").cast("long").alias("position"), "name", *BOUNDS, *[F.coalesce(f"{b}_closed", F.lit(False)).alias(f"{b}_closed") for b in BOUNDS]))
    extent = F.greatest(F.col("lat_hi") - F.col("lat_lo"), F.col("lon_hi") - F.col("lon_lo"))
    # An extent of SPAN - 1 cells touches SPAN of them at most.
    level = F.when(extent <= (SPAN - 1) * base, 0).otherwise(F.ceil(F.log2(extent / F.lit((SPAN - 1) * base)))).cast("int")
    leveled = boxes.withColumn("level", level)
    ends = [_cell(F.col(b), F.col("level"), base).alias(a) for a, b in zip(("x0", "x1", "y0", "y1"), BOUNDS, strict=True)]
    return (leveled.select("level", "box", *ends).withColumn("x", F.explode(F.sequence("x0", "x1"))).withColumn("y", F.explode(F.sequence("y0", "y1")))
            .select("level", "x", "y", "box", F.expr("x > x0 and x < x1 and y > y0 and y < y1").alias("spans")))


def _inside(box: Column, lat: Column, lon: Column) -> Column:
    def bound(v: Column, low: str, high: str) -> Column:
        return (((v > box[low]) | (box[f"{low}_closed"] & (v == box[low])))
                & ((v < box[high]) | (box[f"{high}_closed"] & (v == box[high]))))
    return bound(lat, "lat_lo", "lat_hi") & bound(lon, "lon_lo", "lon_hi")


def _match(box: Column) -> Column:
    return F.struct(box["position"].alias("position"), box["name"].alias("name"))


def default_base(areas: DataFrame) -> float:
    """A cell as wide as the median box, so that most boxes touch a few cells of the finest grid."""
    extent = F.greatest(F.col("lat_hi") - F.col("lat_lo"), F.col("lon_hi") - F.col("lon_lo"))
    found = areas.select(extent.alias("e")).where("e > 0").agg(F.percentile_approx("e", 0.5)).first()[0]
    return float(found) if found and found < 360 else 1e-3


def classify_by_table(readings: DataFrame, areas: DataFrame, lat: str = "latitude", lon: str = "longitude",
                      base: float | None = None, out: str = "area") -> DataFrame:
    """``readings`` with ``area``: the name of the last area that holds the point."""
    base = base or default_base(areas)
    cells = grid_cells(areas, base)
    counts = cells.groupBy("level", "x", "y").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("spans"), _match(F.col("box")))).alias("top"))
    streaming = readings.isStreaming
    # A few numbers: the levels in use, the boxes that their cells hold as arrays, and how many cells are crowded.
    as_array = F.lit(True) if streaming else F.col("n") <= LIST
    levels = sorted((r.level, r.boxes or 0, r.crowded) for r in counts.groupBy("level").agg(
        F.sum(F.when(as_array, F.col("n"))).alias("boxes"), F.count_if(F.col("n") > LIST).alias("crowded")).collect())
    point = (F.col(lat), F.col(lon))
    held = readings.withColumn("_found", F.lit(None).cast("struct<position:bigint,name:string>"))
    for level, n, crowded in levels:
        own = cells.where(F.col("level") == level)
        if crowded and not streaming:
            few = counts.where((F.col("level") == level) & (F.col("n") <= LIST)).select("x", "y")
            own = own.join(_bounded(few, n), ["x", "y"], "left_semi")
        lists = own.groupBy(F.col("x").alias(f"_x{level}"), F.col("y").alias(f"_y{level}")).agg(F.sort_array(F.collect_list("box"), asc=False).alias("_boxes"))
        lists = _bounded(lists, n)
        at = (_cell(point[0], level, base) == F.col(f"_x{level}")) & (_cell(point[1], level, base) == F.col(f"_y{level}"))
        first = F.get(F.filter("_boxes", lambda box: _inside(box, *point)), F.lit(0))
        found = F.when(first.isNotNull(), _match(first))
        held = held.join(lists, at, "left").withColumn("_found", F.greatest("_found", found)).drop("_boxes", f"_x{level}", f"_y{level}")
    if not streaming and any(crowded for _, _, crowded in levels):
        held = _with_crowded(held, readings, cells, counts, levels, base, point)
    return held.withColumn(out, F.col("_found.name")).select(*[c for c in readings.columns if c != out], out)


def _bounded(side: DataFrame, n: int) -> DataFrame:
    """A join's right side of at most ``n`` rows or boxes: broadcast up to ``BROADCAST``, otherwise shuffled whatever the planner expects."""
    return F.broadcast(side) if n <= BROADCAST else side.hint("merge")


def _with_crowded(held: DataFrame, readings: DataFrame, cells: DataFrame, counts: DataFrame, levels: list, base: float, point: tuple) -> DataFrame:
    """Matches in cells under more than ``LIST`` boxes: rows of boxes, spread by salt, and one result per point."""
    crowded = counts.where(F.col("n") > LIST).select("level", "x", "y", F.ceil(F.col("n") / PART).cast("int").alias("parts"), "top")
    crowded = _bounded(crowded, sum(many for _, _, many in levels))
    boxes = (cells.join(crowded, ["level", "x", "y"]).where(F.col("top").isNull() | (_match(F.col("box")) >= F.col("top")))
             .select("level", "x", "y", F.pmod(F.xxhash64("box"), F.col("parts")).cast("int").alias("salt"), "box"))
    probes = F.explode(F.array(*[F.struct(F.lit(level).alias("level"), _cell(F.col("_lat"), level, base).alias("x"), _cell(F.col("_lon"), level, base).alias("y"))
                                 for level, _, many in levels if many]))
    points = readings.select(point[0].alias("_lat"), point[1].alias("_lon")).where("_lat is not null and _lon is not null").distinct()
    near = (points.select("_lat", "_lon", probes.alias("p")).select("_lat", "_lon", "p.*").join(crowded, ["level", "x", "y"])
            .select("level", "x", "y", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), "_lat", "_lon"))
    met = near.join(boxes.hint("merge"), ["level", "x", "y", "salt"]).where(_inside(F.col("box"), F.col("_lat"), F.col("_lon")))
    best = met.groupBy("_lat", "_lon").agg(F.max(_match(F.col("box"))).alias("_more"))
    here = (point[0] == F.col("_lat")) & (point[1] == F.col("_lon"))
    return held.join(best.hint("merge"), here, "left").withColumn("_found", F.greatest("_found", "_more")).drop("_lat", "_lon", "_more")
