"""Explicit schemas. Nothing is ever inferred.

One reading schema serves all zones (plus a ``zone`` column) and one purchase
schema serves all points of sale (plus a ``pos`` column). ``arrival`` is the
processing clock (Kafka record timestamp, or a column of the file) and ``id``
is a unique tie-break so that "last row of a window" is deterministic.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Wire records as produced by the sensors / tills (Avro field names).
SENSOR_WIRE = T.StructType([
    T.StructField("sensor_UID", T.StringType()),
    T.StructField("MAC", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("Timestamp", T.LongType()),
])

PURCHASE_WIRE = T.StructType([
    T.StructField("Seller_Name", T.StringType()),
    T.StructField("productid", T.LongType()),
    T.StructField("Product_Category", T.StringType()),
    T.StructField("Number_Available_stock", T.IntegerType()),
    T.StructField("Payment_Method", T.StringType()),
    T.StructField("Amount", T.IntegerType()),
    T.StructField("Loyalty_Card", T.StringType()),
    T.StructField("Timestamp", T.LongType()),
])

# Wire field -> library column.
SENSOR_RENAMES = {
    "sensor_UID": "sensor_uid", "MAC": "mac", "ip": "ip",
    "latitude": "latitude", "longitude": "longitude", "Timestamp": "ts",
}
PURCHASE_RENAMES = {
    "Seller_Name": "seller_name", "productid": "productid",
    "Product_Category": "product_category",
    "Number_Available_stock": "available_stock",
    "Payment_Method": "payment_method", "Amount": "amount",
    "Loyalty_Card": "loyalty_card", "Timestamp": "ts",
}

# Library row shapes.
READING = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("arrival", T.TimestampType()),
    T.StructField("zone", T.IntegerType()),
    T.StructField("sensor_uid", T.StringType()),
    T.StructField("mac", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

PURCHASE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("arrival", T.TimestampType()),
    T.StructField("pos", T.StringType()),
    T.StructField("seller_name", T.StringType()),
    T.StructField("productid", T.LongType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("available_stock", T.IntegerType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("amount", T.IntegerType()),
    T.StructField("loyalty_card", T.StringType()),
    T.StructField("ts", T.LongType()),
])
