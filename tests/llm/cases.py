"""Small tables shared by the tests: awkward rows that every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"wort{i % 701} noch{i % 37}" for i in range(40000))
SAME = "the same words stand in this text as in the other one, which is a copy of it word for word"

ROWS = [
    (0, None, "en", None, None), (1, "", None, "a", 0), (2, " \n\t ", "en", "a", 4), (3, "one", "en", None, 3),
    (4, "one two three", "de", "b", 13), (5, SAME, "en", "b", 1), (6, SAME, "en", "ü", 1), (7, SAME.upper(), "en", "c", 1),
    (7, SAME.upper(), "en", "c", 1), (None, SAME, "fr", "c", 2), (None, None, None, None, None),
    (9, LONG, "en", "a", 9), (10, LONG + " end", "en", "a", 9), (11, "ä€𝄞 x\x0by\x85 z w", "fr", "ü", 1),
    (12, "line one of some length here\nline one of some length here\r\n\nlast", "en", "b", 7),
    (13, "LINE one of some length here \nother", "en", "b", 7), (14, "x\nline one of some length here", "en", None, 7),
    (-5, "idiot! you are an idiot and a loser", "en", "a", 7), (2**40, "\x00 nul ﻿ bom", "en", "a", 7),
]


def awkward(spark: SparkSession) -> DataFrame:
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    from pyspark.sql import functions as F

    for name in ("size", "node", "component_id", "kept", "pos", "bucket", "shard", "slot", "spans", "u", "v", "hash", "key", "line", "target",
                 "n_dropped", "n_lines", "m_id", "m_source", "m_copy", "copies", "doc", "row_id", "row_hash", "text_hash", "digest", "root", "first", "score"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def nothing(spark: SparkSession) -> DataFrame:
    return awkward(spark).where("false")
