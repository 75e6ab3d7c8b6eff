"""Kafka sources for sensor and till topics (Avro values, schema-registry framing).

The Kafka and Avro data sources are separate Spark packages
(``spark-sql-kafka-0-10`` and ``spark-avro``); they are not part of a plain
PySpark install, so these readers only build the query and fail at
``load``/``start`` time if the jars are missing.

Values carry the registry wire format: one magic byte (0) and a four-byte schema
id before the Avro body. A producer that is upgraded writes under a new id, so a
message is decoded with the schema of its own id and resolved to the reader's:
give the readers ``schemas``, the writer schemas by id (a registry export; the
registry itself is not called). Without ``schemas`` every id is taken to mean the
library's own schema. Messages that are too short, have another magic byte or a
schema id that is not known are not decoded; ``dead_letters`` gives them, with the
reason, for an output of their own. A body that its schema does not fit gives a
row of nulls (``from_avro`` in permissive mode), not a failed stream.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.schemas import PURCHASE_RENAMES, PURCHASE_WIRE, SENSOR_RENAMES, SENSOR_WIRE

_AVRO_TYPES = {
    T.StringType: "string", T.LongType: "long", T.IntegerType: "int",
    T.DoubleType: "double",
}


def avro_schema_json(name: str, schema: T.StructType, namespace: str = "footfall") -> str:
    """Avro record schema (JSON text) for a flat struct of primitive fields."""
    fields = [{"name": f.name, "type": _AVRO_TYPES[type(f.dataType)]} for f in schema.fields]
    return json.dumps({"type": "record", "name": name, "namespace": namespace, "fields": fields})


def registry_payload(value: str = "value") -> Column:
    """Avro body of a registry-framed message (drops the 5-byte header)."""
    return F.expr(f"substring({value}, 6, length({value}) - 5)")


HEADER = 5  # bytes before the Avro body


def framed(value: str = "value") -> Column:
    """``magic, schema_id, body`` of a registry-framed message; nulls where it is too short to have them."""
    whole = F.coalesce(F.octet_length(value), F.lit(0)) >= HEADER

    def number(start: int, length: int) -> Column:
        return F.when(whole, F.conv(F.hex(F.substring(value, start, length)), 16, 10).cast("long"))
    return F.struct(number(1, 1).alias("magic"), number(2, 4).alias("schema_id"), F.when(whole, registry_payload(value)).alias("body"))


def problem(frame: Column, schemas: dict[int, str] | None = None) -> Column:
    """Why a frame cannot be decoded; null if it can."""
    reason = F.when(frame["magic"].isNull(), "short message").when(frame["magic"] != 0, "not registry-framed")
    return reason.when(~frame["schema_id"].isin(*schemas), "unknown schema") if schemas else reason


def dead_letters(raw: DataFrame, schemas: dict[int, str] | None = None) -> DataFrame:
    """The messages of a raw Kafka table or stream that the readers leave out, with ``problem``."""
    return raw.withColumn("problem", problem(framed(), schemas)).where(F.col("problem").isNotNull())


def decoded(frame: Column, reader: str, schemas: dict[int, str] | None, from_avro) -> Column:
    """The body as the reader's record: decoded with the schema of the message's id, resolved to the reader's."""
    if not schemas:
        return from_avro(frame["body"], reader, {"mode": "PERMISSIVE"})
    out = None
    for schema_id, writer in sorted(schemas.items()):
        own, record = frame["schema_id"] == schema_id, from_avro(frame["body"], writer, {"mode": "PERMISSIVE", "avroSchema": reader})
        out = F.when(own, record) if out is None else out.when(own, record)
    return out


def kafka_options(bootstrap_servers: str, topics: str, group_id: str | None = None,
                  starting_offsets: str = "earliest", max_offsets: int | None = None) -> dict:
    """Reader options. ``max_offsets`` paces a stream (rows per trigger over all partitions); it drops nothing."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topics,
        "startingOffsets": starting_offsets,
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    return opts


def _decode(raw: DataFrame, wire: T.StructType, name: str, renames: dict, number: int, schemas: dict[int, str] | None = None) -> DataFrame:
    from pyspark.sql.avro.functions import from_avro  # needs the spark-avro package

    raw = raw.withColumn("frame", framed()).where(problem(F.col("frame"), schemas).isNull())
    rec = decoded(F.col("frame"), avro_schema_json(name, wire), schemas, from_avro).alias("r")
    # id = (topic's number, partition, offset) packed into one long: unique across topics, ordered per partition.
    packed_id = (F.lit(number % 128 << 56) + F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")).alias("id")
    return raw.select(packed_id, F.col("timestamp").alias("arrival"), rec).select(
        "id", "arrival", *[F.col(f"r.{w}").alias(c) for w, c in renames.items()])


def read_readings(spark: SparkSession, bootstrap_servers: str, topic: str, zone: int,
                  group_id: str | None = None, stream: bool = True, max_offsets: int | None = None,
                  schemas: dict[int, str] | None = None) -> DataFrame:
    """Sensor readings of one zone topic, in the library's READING shape."""
    reader = spark.readStream if stream else spark.read
    raw = reader.format("kafka").options(**kafka_options(bootstrap_servers, topic, group_id, max_offsets=max_offsets if stream else None)).load()
    df = _decode(raw, SENSOR_WIRE, "Sensor", SENSOR_RENAMES, zone, schemas)
    return df.select("id", "arrival", F.lit(zone).cast("int").alias("zone"),
                     "sensor_uid", "mac", "ip", "latitude", "longitude", "ts")


def read_purchases(spark: SparkSession, bootstrap_servers: str, topic: str, pos: str,
                   group_id: str | None = None, stream: bool = True, max_offsets: int | None = None,
                   schemas: dict[int, str] | None = None) -> DataFrame:
    """Purchases of one till topic (``pos`` ends in its number, as POS1), in the library's PURCHASE shape."""
    reader = spark.readStream if stream else spark.read
    raw = reader.format("kafka").options(**kafka_options(bootstrap_servers, topic, group_id, max_offsets=max_offsets if stream else None)).load()
    df = _decode(raw, PURCHASE_WIRE, "Purchase", PURCHASE_RENAMES, int("".join(c for c in pos if c.isdigit()) or 0), schemas)
    return df.select("id", "arrival", F.lit(pos).alias("pos"), "seller_name", "productid",
                     "product_category", "available_stock", "payment_method", "amount",
                     "loyalty_card", "ts")
