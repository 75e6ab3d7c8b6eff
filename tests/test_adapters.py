"""Kafka/Avro/sink adapters: what can be checked without the external jars."""

import json

from pyspark.sql import functions as F

from footfall.schemas import PURCHASE_WIRE, SENSOR_WIRE
from footfall.sources.kafka import avro_schema_json, dead_letters, decoded, framed, kafka_options, registry_payload
from footfall.streaming.sinks import batch_path, checkpoint_root


def test_avro_reader_schema_matches_wire_fields():
    s = json.loads(avro_schema_json("Sensor", SENSOR_WIRE))
    assert [f["name"] for f in s["fields"]] == ["sensor_UID", "MAC", "ip", "latitude",
                                                "longitude", "Timestamp"]
    assert [f["type"] for f in s["fields"]] == ["string", "string", "string", "double",
                                                "double", "long"]
    p = json.loads(avro_schema_json("Purchase", PURCHASE_WIRE))
    assert dict((f["name"], f["type"]) for f in p["fields"])["Number_Available_stock"] == "int"


def test_kafka_options():
    o = kafka_options("broker:9092", "POS1", group_id="RetailProject")
    assert o == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "POS1",
                 "startingOffsets": "earliest", "kafka.group.id": "RetailProject"}


def test_registry_header_is_dropped(spark):
    framed = bytes([0, 0, 0, 0, 7]) + b"avro-body"
    df = spark.createDataFrame([(bytearray(framed),)], "value binary")
    (row,) = df.select(registry_payload().alias("body")).collect()
    assert bytes(row.body) == b"avro-body"


def _frame(magic: int, schema_id: int, body: bytes) -> bytearray:
    return bytearray(bytes([magic]) + schema_id.to_bytes(4, "big") + body)


def test_frames_are_split_and_routed(spark):
    rows = [(0, _frame(0, 7, b"avro-body")), (1, _frame(0, 2**31 + 5, b"")), (2, _frame(1, 7, b"x")), (3, bytearray(b"\0\0\0")), (4, None), (5, _frame(0, 8, b"y"))]
    df = spark.createDataFrame(rows, "n int, value binary")
    got = {r.n: (r.f.magic, r.f.schema_id, None if r.f.body is None else bytes(r.f.body)) for r in df.select("n", framed().alias("f")).collect()}
    assert got == {0: (0, 7, b"avro-body"), 1: (0, 2**31 + 5, b""), 2: (1, 7, b"x"), 3: (None,) * 3, 4: (None,) * 3, 5: (0, 8, b"y")}
    lost = {r.n: r.problem for r in dead_letters(df, {7: "seven", 2**31 + 5: "high"}).collect()}
    assert lost == {2: "not registry-framed", 3: "short message", 4: "short message", 5: "unknown schema"}
    assert {r.n for r in dead_letters(df).collect()} == {2, 3, 4}


def test_each_message_is_decoded_with_the_schema_of_its_id(spark):
    """The decoder itself is in a package that is not installed; a stand-in says which schemas it was given."""
    def stand_in(body, writer, options):
        return F.concat_ws(" ", body.cast("string"), F.lit(writer), F.lit(options.get("avroSchema", "-")), F.lit(options["mode"]))

    df = spark.createDataFrame([(_frame(0, 7, b"a"),), (_frame(0, 9, b"b"),)], "value binary").select(framed().alias("f"))
    both = df.select(decoded(F.col("f"), "reader", {7: "old", 9: "new"}, stand_in).alias("r")).collect()
    assert {r.r for r in both} == {"a old reader PERMISSIVE", "b new reader PERMISSIVE"}
    assert {r.r for r in df.select(decoded(F.col("f"), "reader", None, stand_in).alias("r")).collect()} == {"a reader - PERMISSIVE", "b reader - PERMISSIVE"}


def test_checkpoint_root_comes_from_the_session(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert batch_path("/x/", "store-sales", 3) == "/x/index=store-sales/batch=3"


def test_documents_have_unique_ids(spark):
    import __spark_entry__ as E
    from conftest import SF0001

    for name, q in E.queries().items():
        if name.startswith("docs_"):
            d = q(spark, SF0001)
            assert d.count() == d.select("doc_id").distinct().count(), name
            assert d.where(F.col("doc_id").isNull()).count() == 0
