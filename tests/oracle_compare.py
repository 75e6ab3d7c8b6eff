"""Spark-vs-DuckDB comparison used by the tests and by hand.

Mirrors the driver's check: same row count, same column names, and the
same order-insensitive hash of the values (columns sorted by name, rows
sorted, floats rounded to 9 significant digits).

Run by hand: ``python tests/oracle_compare.py /root/testdata/sf0.01 [names...]``
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "\x00"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def digest(columns, rows) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return names, len(lines), h


def compare(spark, sf_dir: str, name: str, query, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    df = query(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_rows = rel.fetchall()
    s = digest(df.columns, s_rows)
    d = digest(rel.columns, d_rows)
    return {
        "name": name, "spark_rows": s[1], "duck_rows": d[1],
        "names_match": s[0] == d[0], "hash_match": s[2] == d[2],
        "spark_cols": s[0], "duck_cols": d[0], "spark_sec": round(t1 - t0, 2),
        "ok": s == d,
    }


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if wanted and name not in wanted:
            continue
        if name not in sqls:
            print(f"{name:32s} no oracle")
            continue
        r = compare(spark, sf, name, q, sqls[name], con)
        bad += not r["ok"]
        print(f"{name:32s} {'OK ' if r['ok'] else 'BAD'} spark={r['spark_rows']} duck={r['duck_rows']} "
              f"names={r['names_match']} hash={r['hash_match']} {r['spark_sec']}s"
              + ("" if r["names_match"] else f" {r['spark_cols']} vs {r['duck_cols']}"))
    print("mismatches:", bad)
