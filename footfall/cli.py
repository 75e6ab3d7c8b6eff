"""Command line: start one of the three applications as streaming queries.

    python -m footfall.cli instore --files /data/purchases --out /data/docs
    python -m footfall.cli proximity --kafka broker:9092 --topic zone1 --zone 1 --out /data/docs
    python -m footfall.cli foot-traffic --kafka broker:9092 --topic 1,2,3 --out /data/docs

File sources read parquet files with the library schema (``READING`` /
``PURCHASE``). Kafka sources need the Kafka and Avro packages; with several
topics, the n-th topic is zone n (readings) or POS n (purchases).
``--available-now`` processes what is there and stops (backfills, tests).
``--shared`` reads the tills once for all four in-store results; ``--publish``
writes published runs (committed batches, latest document by id).
Checkpoints go under ``--checkpoint`` or the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from footfall.schemas import PURCHASE, READING
from footfall.settings import DEFAULTS
from footfall.sources import files, kafka
from footfall.streaming import jobs

STARTERS = {
    "foot-traffic": (jobs.start_foot_traffic, jobs.foot_traffic_documents, READING),
    "proximity": (jobs.start_proximity, jobs.proximity_documents, READING),
    "instore": (jobs.start_instore, jobs.instore_documents, PURCHASE),
}


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="footfall")
    p.add_argument("job", choices=sorted(STARTERS))
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--files", help="directory of parquet files (library schema)")
    src.add_argument("--kafka", help="bootstrap servers")
    p.add_argument("--topic", default="", help="comma-separated topics (Kafka)")
    p.add_argument("--group-id", default=None)
    p.add_argument("--zone", type=int, default=None, help="zone of a single reading topic")
    p.add_argument("--out", required=True, help="root folder of the document indexes")
    p.add_argument("--checkpoint", default=None)
    p.add_argument("--watermark", default=DEFAULTS.watermark_delay)
    p.add_argument("--crowd-threshold", type=int, default=DEFAULTS.crowd_threshold)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--batch", action="store_true", help="one batch run over all input, last windows included")
    p.add_argument("--shared", action="store_true", help="instore: one read of the tills for all results")
    p.add_argument("--publish", action="store_true", help="write published runs instead of plain batch folders")
    p.add_argument("--max-offsets-per-trigger", type=int, default=None)
    p.add_argument("--max-files-per-trigger", type=int, default=None)
    return p.parse_args(argv)


def source(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    _, _, schema = STARTERS[a.job]
    if a.files and a.batch:
        return files.read_files(spark, a.files, schema)
    if a.files:
        return files.stream_files(spark, a.files, schema, max_files_per_trigger=a.max_files_per_trigger)
    topics = [t for t in a.topic.split(",") if t]
    parts = []
    for i, t in enumerate(topics, start=1):
        if schema is READING:
            zone = a.zone if (a.zone is not None and len(topics) == 1) else i
            parts.append(kafka.read_readings(spark, a.kafka, t, zone, a.group_id, not a.batch, a.max_offsets_per_trigger))
        else:
            parts.append(kafka.read_purchases(spark, a.kafka, t, f"POS{i}", a.group_id, not a.batch, a.max_offsets_per_trigger))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def main(argv=None, spark: SparkSession | None = None) -> dict:
    a = parse(argv)
    spark = spark or SparkSession.builder.appName(f"footfall-{a.job}").getOrCreate()
    settings = DEFAULTS.with_(watermark_delay=a.watermark, crowd_threshold=a.crowd_threshold)
    start, documents, _ = STARTERS[a.job]
    if a.batch:
        spark.conf.set("spark.sql.session.timeZone", settings.session_zone)
        return jobs.write_all(documents(source(spark, a), settings), a.out, a.publish)
    if a.shared and a.job == "instore":
        start = jobs.start_instore_shared
    trigger = {"availableNow": True} if a.available_now else None
    queries = start(source(spark, a), root=a.out, settings=settings, trigger=trigger,
                    checkpoint_base=a.checkpoint, publish=a.publish)
    if a.available_now:
        for q in queries.values():
            q.awaitTermination()
    return queries


if __name__ == "__main__":
    main()
    if SparkSession.getActiveSession().streams.active:
        SparkSession.getActiveSession().streams.awaitAnyTermination()
