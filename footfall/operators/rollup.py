"""Day tables that roll up to any span: distinct devices by sketch, visit history exactly.

A distinct count over a month cannot be added up from days. ``day_devices``
therefore keeps, per (day, group), a mergeable HyperLogLog sketch of the devices
beside the plain count of readings; ``unique_devices`` unites the sketches of any
set of days and estimates. A sketch has at most 2**``PRECISION`` registers (some
kilobytes) whatever the number of devices, and its estimate has a relative
standard error of about ``ERROR``; small sets (some hundred devices) are held, and
counted, exactly. A stream keeps one sketch per open day and group and frees it
when the day closes. The exact counts (``foot_traffic_intended``, ``capture_rate``)
stay beside it.

Visit history needs no sketch: ``device_days`` has one row per device, day and
zone, written once when its day closes, and ``history_of`` reduces those rows. A
stream writes device days; history over any span is a query over what it wrote.

Days are those of the session's time zone in batch and, on a stream, of UTC (jobs
pin the session to it). Readings without ``arrival`` are in no day; readings without
MAC count as readings, not as a device; in ``device_days`` they are one device, null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.areas import ZONE1_AREAS, area_of

PRECISION = 12  # 4096 registers
ERROR = 0.02  # a little over 1.04 / sqrt(4096)


def _day(readings: DataFrame) -> Column:
    if readings.isStreaming:
        return F.window("arrival", "1 day").alias("window")
    begin = F.date_trunc("day", F.col("arrival"))
    return F.struct(begin.alias("start"), (begin + F.expr("INTERVAL 1 DAY")).alias("end")).alias("window")


def day_devices(readings: DataFrame, by: str = "zone", precision: int = PRECISION) -> DataFrame:
    """Per (day, group): readings and a sketch of their devices. Batch, or a stream with a watermark."""
    return (readings.where(F.col("arrival").isNotNull()).groupBy(_day(readings), by)
            .agg(F.count(F.lit(1)).alias("readings"), F.hll_sketch_agg("mac", precision).alias("devices")))


def day_devices_by_area(readings: DataFrame, areas=ZONE1_AREAS, precision: int = PRECISION) -> DataFrame:
    """``day_devices`` per shop area (readings outside of all areas are left out): the capture rate's counts."""
    inside = readings.withColumn("area", area_of("latitude", "longitude", areas)).where(F.col("area").isNotNull())
    return day_devices(inside, "area", precision)


def unique_devices(days: DataFrame, span: str = "month", by: str = "zone") -> DataFrame:
    """Devices per (``span``, group), from any number of day tables united; ``span`` as in ``date_trunc``."""
    return (days.groupBy(F.date_trunc(span, F.col("window.start")).alias("begin"), by)
            .agg(F.sum("readings").alias("readings"), F.hll_sketch_estimate(F.hll_union_agg("devices")).alias("devices")))


def device_days(readings: DataFrame) -> DataFrame:
    """Per (day, device, zone): readings, first and last seen. Batch, or a stream with a watermark."""
    return (readings.where(F.col("arrival").isNotNull()).groupBy(_day(readings), "mac", "zone")
            .agg(F.count(F.lit(1)).alias("n"), F.min("arrival").alias("lo"), F.max("arrival").alias("hi")))


def history_of(days: DataFrame) -> DataFrame:
    """The columns of ``visit_history`` from device days."""
    return days.groupBy("mac").agg(
        F.sum("n").alias("readings"), F.countDistinct("window").alias("days_seen"), F.countDistinct("zone").alias("zones_seen"),
        F.min("lo").alias("first_seen"), F.max("hi").alias("last_seen"))
