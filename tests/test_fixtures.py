"""Hand-computed golden fixtures, one per operator family."""

from datetime import datetime

from pyspark.sql import functions as F

from footfall.functions.areas import ZONE1_AREAS
from footfall.operators import foot_traffic as ft
from footfall.operators import instore, proximity
from footfall.schemas import PURCHASE, READING
from footfall.settings import DEFAULTS

T0 = datetime(2024, 1, 1, 0, 0, 0)


def at(h, m, s=0):
    return datetime(2024, 1, 1, h, m, s)


AREA_CASES = [
    (40.419373, -3.705999, "Zone1-Area1-Zara"),
    (40.419372, -3.705999, None),
    (40.419642, -3.705690, "Zone1-Area1-Zara"),
    (40.419642, -3.705689, None),
    (40.419643, -3.705700, None),
    (40.419643, -3.705500, None),
    (40.419644, -3.705689, None),
    (40.419644, -3.705688, "Zone1-Area2-H&M"),
    (40.419890, -3.705381, "Zone1-Area2-H&M"),
    (40.419890, -3.705380, None),
    (40.419891, -3.705075, "Zone1-Area3-Mango"),
    (40.419999, -3.705688, "Zone1-Area3-Mango"),
    (40.419999, -3.705689, None),
    (40.420000, -3.705200, None),
]


def readings(spark, rows):
    """rows: (id, arrival, zone, sensor_uid, ts, lat, lon)."""
    data = [(i, a, z, s, None, None, lat, lon, ts) for (i, a, z, s, ts, lat, lon) in rows]
    return spark.createDataFrame(data, READING)


def purchases(spark, rows):
    """rows: (id, arrival, pos, category, stock, method, amount, ts, productid)."""
    data = [(i, a, pos, "Seller_1", pid, cat, stock, meth, amt, "true", ts)
            for (i, a, pos, cat, stock, meth, amt, ts, pid) in rows]
    return spark.createDataFrame(data, PURCHASE)


def test_area_boxes(spark):
    rows = [(i, T0, 1, "s", 0, lat, lon) for i, (lat, lon, _) in enumerate(AREA_CASES)]
    got = {r.id: r.area for r in proximity.classify_area(readings(spark, rows)).collect()}
    assert [got[i] for i in range(len(AREA_CASES))] == [a for _, _, a in AREA_CASES]
    for lat, lon, want in AREA_CASES:
        hits = [a.name for a in ZONE1_AREAS if a.contains_py(lat, lon)]
        assert hits == ([want] if want else [])


FOOT_ROWS = [  # id, sensor, ts, arrival
    (1, "s", 100, at(0, 11)), (2, "s", 101, at(0, 12)), (3, "t", 100, at(0, 13)),
    (8, "u", 100, at(0, 25)), (9, "flush", 999, at(5, 0)), (10, "flush", 999, at(6, 0)),
]


def foot_readings(spark):
    rows = []
    for zone in (1, 2, 3):
        for (i, s, ts, a) in FOOT_ROWS:
            rows.append((zone * 100 + i, a, zone, s, ts, 0.0, 0.0))
    return readings(spark, rows)


def test_running_count_keeps_first_timestamp(spark):
    r = ft.running_visitors(foot_readings(spark)).where("zone = 1")
    got = {r.id % 100: (r.first_ts, r.visitors) for r in r.collect()}
    assert got == {1: (100, 1), 2: (100, 2), 3: (100, 1), 8: (100, 1), 9: (999, 1), 10: (999, 2)}


def test_window_join_12_counts_pairs(spark):
    j = ft.foot_traffic_window_join_12(ft.running_visitors(foot_readings(spark))).collect()
    got = {(r.window.start, r.timestamp): (r.readings_zone1, r.readings_zone2, r.documents) for r in j}
    assert got == {(at(0, 10), 100): (3, 3, 9), (at(0, 20), 100): (1, 1, 1),
                   (at(5, 0), 999): (1, 1, 1), (at(6, 0), 999): (1, 1, 1)}


def test_second_join_hands_over_at_window_end(spark):
    out = ft.foot_traffic_as_coded(ft.running_visitors(foot_readings(spark))).collect()
    assert sum(r.documents for r in out) == 12  # end - 1us hand-over would give 30
    got = {(r.window.start, r.timestamp): (r.pairs_12, r.readings_zone3, r.documents) for r in out}
    assert got == {(at(0, 20), 100): (10, 1, 10), (at(5, 0), 999): (1, 1, 1),
                   (at(6, 0), 999): (1, 1, 1)}


def expand(factors):
    """The pair list the factors stand for: (w20, ts, n1, n2, n3) per document."""
    from collections import Counter, defaultdict
    by_key = defaultdict(lambda: {1: defaultdict(list), 2: defaultdict(list), 3: []})
    for r in factors:
        k = (r.window.start, r.timestamp)
        vals = range(r.visitors_from, r.visitors_to + 1)
        if r.zone == 3:
            by_key[k][3].extend(vals)
        else:
            by_key[k][r.zone][r.join_window.start].extend(vals)
    docs = Counter()
    for k, z in by_key.items():
        for w10, ones in z[1].items():
            for n1 in ones:
                for n2 in z[2].get(w10, []):
                    for n3 in z[3]:
                        docs[(k[0], k[1], n1, n2, n3)] += 1
    return docs


def test_factors_expand_to_the_pair_list(spark):
    f = ft.foot_traffic_factors(ft.running_visitors(foot_readings(spark))).collect()
    docs = expand(f)
    assert sum(docs.values()) == 12
    assert docs[(at(0, 20), 100, 1, 1, 1)] == 5 and docs[(at(0, 20), 100, 2, 2, 1)] == 1


A1, A2, A3, NONE = (40.4195, -3.7058), (40.4197, -3.7055), (40.41995, -3.7054), (40.4201, -3.7)


def test_proximity_last_area_and_empty_group(spark):
    groups = {10: [A1, A2, NONE], 20: [NONE, NONE], 30: [A3, A1, A1]}
    rows, i = [], 0
    for ts, pts in groups.items():
        for k, (lat, lon) in enumerate(pts):
            i += 1
            rows.append((i, at(1, 0, k), 1, "s", ts, lat, lon))
    out = {r.ts: (r.area, r.visitors) for r in
           proximity.proximity_traffic_as_coded(readings(spark, rows)).collect()}
    assert out == {10: ("Zone1-Area2-H&M", 2), 20: ("", 0), 30: ("Zone1-Area1-Zara", 3)}


def prox_rows(spark, rows):
    """rows: (window_start, ts, area, visitors) with 30-minute windows."""
    df = spark.createDataFrame(rows, "ws timestamp, ts long, area string, visitors long")
    return df.select(F.struct(F.col("ws").alias("start"),
                              (F.col("ws") + F.expr("INTERVAL 30 MINUTES")).alias("end")).alias("window"),
                     "ts", "area", "visitors")


def test_jam_thresholds(spark):
    rows = [(at(h, 0), 1, f"A{h}", v) for h, v in ((1, 24), (2, 25), (3, 26))]
    out = {r.area: r.observation for r in proximity.traffic_jam_as_coded(prox_rows(spark, rows)).collect()}
    assert out == {"A1": DEFAULTS.no_jam_text, "A2": DEFAULTS.offer_message, "A3": DEFAULTS.offer_message}


def test_jam_keeps_last_row_but_alerts_each(spark):
    p = prox_rows(spark, [(at(1, 0), 1, "X", 30), (at(1, 0), 2, "X", 3)])
    jam = proximity.traffic_jam_as_coded(p).collect()
    assert [(r.visitors, r.area, r.observation) for r in jam] == [(3, "X", DEFAULTS.no_jam_text)]
    alerts = proximity.offer_alerts(p).collect()
    assert [(r.visitors, r.message) for r in alerts] == [(30, DEFAULTS.offer_message)]


def test_jam_window_is_clocked_at_proximity_end(spark):
    # a proximity window ending at 01:00 lands in the 01:00-01:20 jam window
    p = prox_rows(spark, [(at(0, 30), 1, "X", 3)])
    (r,) = proximity.traffic_jam_as_coded(p).collect()
    assert (r.window.start, r.window.end) == (at(1, 0), at(1, 20))


def test_stock_thresholds(spark):
    rows = [(i, at(0, 1, i), "POS1", "Kids", s, "Cash", 5, 1583024400, i)
            for i, s in enumerate((29, 30, 31))]
    out = {r.productid: r.observation for r in
           instore.stock_availability(purchases(spark, rows)).collect()}
    assert out == {0: DEFAULTS.reorder_text, 1: DEFAULTS.sufficient_text, 2: DEFAULTS.sufficient_text}


def test_instore_one_window(spark):
    rows = [(1, at(0, 1), "POS2", "Kids", 50, "Cash", 10, 1583024400, 1),
            (2, at(0, 2), "POS2", "Kids", 50, "Cash", 50, 1583024520, 1),
            (3, at(0, 3), "POS2", "Kids", 50, "Cash", 7, 1583024460, 1)]
    p = purchases(spark, rows)
    (c,) = instore.category_count(p).collect()
    assert (c.category, c.date, c.total_sales) == ("Kids", "03/01/2020 01:01:00", 3)
    (s,) = instore.total_sales_as_coded(p).collect()
    assert (s.date, s.total_sales) == ("03/01/2020 01:01:00", 7)
    (t,) = instore.total_sales_intended(p).collect()
    assert (t.category, t.total_sales) == ("Kids", 67)


def test_payment_ties_pick_alphabetically_first(spark):
    rows = [(1, at(0, 1), "POS1", "Kids", 50, "Credit Card", 1, 0, 1),
            (2, at(0, 2), "POS1", "Kids", 50, "Cash", 1, 0, 1)]
    (r,) = instore.most_used_payment_method(purchases(spark, rows)).collect()
    assert (r["payment_method"], r["count"], r["purchases"]) == ("Cash", 1, 2)


def test_second_window_need_not_be_a_multiple_of_the_first(spark):
    r, s = foot_readings(spark), DEFAULTS.with_(foot_join_second="15 minutes")
    got = ft.foot_traffic_as_coded(r, s)
    want = ft.foot_traffic_as_coded(ft.running_visitors(r), s)
    assert sorted(got.collect()) == sorted(want.collect())
