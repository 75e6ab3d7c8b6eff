"""Point-in-box classification of readings into shop areas.

Areas are configuration (a short list of boxes), not data, so the
classification is a single ``CASE`` expression inside whole-stage codegen:
no join, no shuffle, no Python. Each bound says whether it is inclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Area:
    name: str
    lat_lo: float
    lat_hi: float
    lon_lo: float
    lon_hi: float
    lat_lo_closed: bool
    lat_hi_closed: bool
    lon_lo_closed: bool
    lon_hi_closed: bool

    def contains(self, lat: Column, lon: Column) -> Column:
        def lower(c, v, closed):
            return c >= F.lit(v) if closed else c > F.lit(v)

        def upper(c, v, closed):
            return c <= F.lit(v) if closed else c < F.lit(v)

        return (lower(lat, self.lat_lo, self.lat_lo_closed)
                & upper(lat, self.lat_hi, self.lat_hi_closed)
                & lower(lon, self.lon_lo, self.lon_lo_closed)
                & upper(lon, self.lon_hi, self.lon_hi_closed))

    def contains_py(self, lat: float, lon: float) -> bool:
        def lower(x, v, closed):
            return x >= v if closed else x > v

        def upper(x, v, closed):
            return x <= v if closed else x < v

        return (lower(lat, self.lat_lo, self.lat_lo_closed)
                and upper(lat, self.lat_hi, self.lat_hi_closed)
                and lower(lon, self.lon_lo, self.lon_lo_closed)
                and upper(lon, self.lon_hi, self.lon_hi_closed))


# The three zone-1 shop boxes of the source application
# (name, lat low, lat high, lon low, lon high, then closed flags for
# lat low, lat high, lon low, lon high).
ZONE1_AREAS = (
    Area("Zone1-Area1-Zara", 40.419373, 40.419643, -3.705999, -3.705689, True, False, True, False),
    Area("Zone1-Area2-H&M", 40.419643, 40.419890, -3.705689, -3.705381, False, True, False, True),
    Area("Zone1-Area3-Mango", 40.419890, 40.419999, -3.705689, -3.705075, False, True, False, True),
)


def area_of(lat: str | Column = "latitude", lon: str | Column = "longitude",
            areas=ZONE1_AREAS) -> Column:
    """Name of the area containing the point, null if none.

    The source checks every box and keeps the last match; the default boxes
    are disjoint, so the last match is the only match. To keep "last match
    wins" for overlapping custom boxes the ``CASE`` tests boxes in reverse.
    """
    lat_c = F.col(lat) if isinstance(lat, str) else lat
    lon_c = F.col(lon) if isinstance(lon, str) else lon
    expr = None
    for a in reversed(areas):
        cond = a.contains(lat_c, lon_c)
        expr = F.when(cond, F.lit(a.name)) if expr is None else expr.when(cond, F.lit(a.name))
    return expr


def area_index_of(lat: str | Column = "latitude", lon: str | Column = "longitude",
                  areas=ZONE1_AREAS) -> Column:
    """1-based position of the area containing the point (null if none):
    a fixed-width stand-in for the name inside aggregations."""
    lat_c = F.col(lat) if isinstance(lat, str) else lat
    lon_c = F.col(lon) if isinstance(lon, str) else lon
    expr = None
    for i in reversed(range(len(areas))):
        cond = areas[i].contains(lat_c, lon_c)
        expr = F.when(cond, F.lit(i + 1)) if expr is None else expr.when(cond, F.lit(i + 1))
    return expr


def area_name(index: Column, areas=ZONE1_AREAS) -> Column:
    """Area name for a 1-based position from ``area_index_of`` (null stays
    null). An explicit CASE: ``element_at`` over a literal array was seen to
    return names for a null position once the optimizer folded the CASE."""
    expr = None
    for i, a in enumerate(areas):
        cond = index == F.lit(i + 1)
        expr = F.when(cond, F.lit(a.name)) if expr is None else expr.when(cond, F.lit(a.name))
    return expr
