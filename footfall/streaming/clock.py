"""A clock input: windows of a silent source close, and the last ones are written.

The source application's windows run on the processing clock, so they close
whether or not another row comes. Here a watermark closes them, and it moves
only when rows do. ``with_ticks`` puts a second, tiny input beside the data: a
folder of *ticks*, rows of the data's own schema that carry a time in
``arrival``, no ``id`` and nothing that is counted. Ticks move the watermark of
the union and are then left out, so

* a till or zone that is idle holds nobody back (one watermark over all inputs),
* a supervisor that writes a tick every minute (``tick(..., at=now)``) closes
  windows as the processing clock would, and
* ``run_to_end`` ends a backfill: it reads all data first, then writes one tick
  behind the last row, and reads on, so the last windows are written too.

Spark moves an operator's filters below the watermark. A tick must pass them to
be seen by it, so it is written once per template: the values of the columns
that the jobs filter on. The filter that drops ticks mentions ``arrival`` and
therefore stays above the watermark.

Data that arrives after a tick with an older ``arrival`` than the tick's, less
the watermark's delay, is late, as with any row. Ticks must hence not run ahead
of the data; ``run_to_end`` never does. A data row without ``id`` has to have one
(``id`` is what tells rows from ticks).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from footfall.settings import DEFAULTS, Settings

#: What a tick must carry to pass the filters of the jobs.
TILLS = ({"pos": "POS1"}, {"pos": "POS2"})
ZONES = ({"zone": 1, "latitude": 40.4195, "longitude": -3.7058}, {"zone": 2}, {"zone": 3})


def _folder(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return folder


def tick(spark: SparkSession, folder: str, schema: T.StructType, at: datetime, templates=TILLS) -> None:
    """Write one tick per template, at time ``at``."""
    rows = [tuple({**t, "arrival": at}.get(f.name) for f in schema.fields) for t in templates]
    (spark.createDataFrame(rows, T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))
     .coalesce(1).write.mode("append").parquet(_folder(spark, folder)))


def with_ticks(stream: DataFrame, folder: str, settings: Settings = DEFAULTS) -> DataFrame:
    """``stream`` under a watermark that the ticks in ``folder`` move too."""
    spark = stream.sparkSession
    ticks = spark.readStream.schema(stream.schema).parquet(_folder(spark, folder)).where("id is null")
    both = stream.where("id is not null").unionByName(ticks)
    # Mentions arrival, so it is not moved below the watermark.
    return both.withWatermark("arrival", settings.watermark_delay).where(F.col("id").isNotNull() | F.col("arrival").isNull())


def run_to_end(start: Callable[[DataFrame], dict[str, StreamingQuery]], source: Callable[[], DataFrame], folder: str, last: datetime,
               templates=TILLS, settings: Settings = DEFAULTS) -> None:
    """Read all of ``source()`` with ``availableNow`` queries, then close every window.

    ``start`` starts the queries of a stream (with ``availableNow`` and checkpoints of their own) and is
    called twice; ``last`` is a time behind all windows that the data can be in.
    """
    for closing in (False, True):
        stream = source()
        if closing:
            tick(stream.sparkSession, folder, stream.schema, last, templates)
        for query in start(with_ticks(stream, folder, settings)).values():
            query.awaitTermination()
            if query.exception() is not None:
                raise query.exception()
