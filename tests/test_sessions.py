"""Sale sessions at the edges of the gap and of the buckets."""

from __future__ import annotations

import datetime as dt

from footfall.operators.instore import sale_sessions


def test_gap_and_bucket_edges(spark):
    start = dt.datetime(2024, 1, 1, 10, 0, 0, tzinfo=dt.timezone.utc)
    # Exactly the gap merges (also across buckets), a second more breaks, and a busy bucket is one session.
    seconds = {"a": [0, 600, 1201], "b": [599, 601, 1150], "c": [0, 1, 2, 3, 599, 5000]}
    rows = [(i, start + dt.timedelta(seconds=s), name, 2) for name, ss in seconds.items() for i, s in enumerate(ss)]
    got = sale_sessions(spark.createDataFrame(rows, "id long, arrival timestamp, seller_name string, amount int"))
    assert sorted((r.seller_name, r.purchases, r.amount) for r in got.collect()) == [
        ("a", 1, 2), ("a", 2, 4), ("b", 3, 6), ("c", 1, 2), ("c", 5, 10)]
