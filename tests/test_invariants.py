"""Invariants checked against brute force on small fixtures."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wxmesh.functions.geo import EARTH_RADIUS_M
from wxmesh.operators import checks as K
from wxmesh.operators.sequence import dense_row_number, previous_in_set
from wxmesh.operators.spatial_join import distance_join


def hav(lat1, lon1, lat2, lon2):
    s1 = math.sin(math.radians(lat2 - lat1) / 2)
    s2 = math.sin(math.radians(lon2 - lon1) / 2)
    a = s1 * s1 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * s2 * s2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(a))


@pytest.mark.parametrize("centre", [(52.5, 13.4), (0.0, 0.0), (71.0, 25.0), (10.0, 179.95), (-10.0, -179.9),
                                    (89.95, 0.0)])
def test_grid_join_equals_brute_force(spark, centre):
    rnd = random.Random(hash(centre) & 0xFFFF)
    lat0, lon0 = centre

    def jitter(n, spread):
        out = []
        for _ in range(n):
            lat = max(-90.0, min(90.0, lat0 + rnd.uniform(-spread, spread)))
            lon = (lon0 + rnd.uniform(-spread, spread) * 3 + 180.0) % 360.0 - 180.0
            out.append((lat, lon))
        return out

    radius = 15000.0
    pts = jitter(150, 0.4)
    ars = jitter(60, 0.4)
    p = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pts)], "pid int, lat double, lon double")
    a = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(ars)], "aid int, area_lat double, area_lon double")
    got = {(r["pid"], r["aid"]) for r in distance_join(p, a, radius).collect()}
    want, edge = set(), set()
    for i, (pl, po) in enumerate(pts):
        for j, (al, ao) in enumerate(ars):
            d = hav(al, ao, pl, po)
            if abs(d - radius) < 1e-3:
                edge.add((i, j))
            elif d <= radius:
                want.add((i, j))
    assert want - got == set()
    assert got - want - edge == set()


def test_dense_row_number_is_exact(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 50), rnd.random()) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k int, v double")
    out = dense_row_number(df, ["k", "v"], "rn", num_partitions=7).collect()
    got = sorted((r["rn"], r["k"], r["v"]) for r in out)
    want = [(i + 1, k, v) for i, (k, v) in enumerate(sorted(rows))]
    assert got == want


def test_previous_in_set_equals_lag(spark):
    vals = sorted(set(random.Random(3).sample(range(10000), 500)))
    df = spark.createDataFrame([(v,) for v in vals] * 2, "h int")
    got = {r["h"]: r["prev_h"] for r in previous_in_set(df, "h", num_partitions=5).collect()}
    assert got == {v: (vals[i - 1] if i else None) for i, v in enumerate(vals)}


def test_check_operators(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", None), (None, "c", 70.0), (2, "c", -1.0)],
                               "k int, s string, t double")
    assert K.violations(df, K.not_null("k")).count() == 1
    assert K.violations(df, K.unique("k")).collect()[0]["n_rows"] == 2
    assert K.violations(df, K.unique_combination("k", "s")).count() == 0
    assert K.violations(df, K.accepted_range("t", 0, 60)).count() == 2
    rep = {(r["model"], r["rule"]): r["violations"] for r in K.report(
        [("m", df, [K.not_null("k"), K.unique("k"), K.accepted_range("t", 0, 60)])]).collect()}
    assert rep == {("m", "not_null(k)"): 1, ("m", "unique(k)"): 1, ("m", "accepted_range(t, 0, 60)"): 2}
    with pytest.raises(K.CheckFailed):
        K.gate([("m", df, [K.not_null("k")])])
    K.gate([("m", df, [K.not_null("k")])], allow=[("m", "not_null(k)")])


def test_map_ranks_start_at_one(spark):
    import __spark_entry__ as entry

    m = entry.queries()["station_area_map"](spark, "/root/testdata/sf0.001")
    firsts = m.groupBy("postal_code").agg(F.min("station_rank").alias("r")).collect()
    assert firsts and all(r["r"] == 1 for r in firsts)


def test_hot_key_holding_a_third_of_the_rows(spark):
    """One (WMO id, hour) holds a third of all rows: the newest-row dedup and
    the canonical first value still give the brute-force answer."""
    import datetime as dt

    from wxmesh import schemas
    from wxmesh.operators.dedup import canonical_first
    from wxmesh.plans import products as P

    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        wmo = "W00001" if hot else f"W{rnd.randint(2, 60):05d}"
        ts = base if hot else base + dt.timedelta(hours=rnd.randint(0, 47))
        rows.append((f"S{i % 97:03d}", wmo, ts, float(i), base + dt.timedelta(seconds=rnd.randint(0, 10**6)), i))
    df = spark.createDataFrame(rows, "station_id string, wmo_station_id string, timestamp timestamp_ntz, "
                                     "temperature double, ingested_at timestamp_ntz, event_id bigint")
    got = {(r["wmo_station_id"], r["timestamp"]): r["temperature"]
           for r in P.stg_facts(schemas.bind_by_name(df, schemas.OBSERVATIONS, keep=("event_id",)),
                                P.OBSERVATIONS, ("ingested_at", "event_id")).collect()}
    want = {}
    for sid, wmo, ts, t, ing, eid in rows:
        k = (wmo, ts)
        if k not in want or (ing, eid) > want[k][0]:
            want[k] = ((ing, eid), t)
    assert got == {k: v[1] for k, v in want.items()}

    canon = canonical_first(df, "wmo_station_id", "station_id", F.col("temperature"), "first_t").collect()
    first = {}
    for sid, wmo, ts, t, ing, eid in rows:
        if wmo not in first or sid < first[wmo][0]:
            first[wmo] = (sid, t)
    firsts_by_wmo = {}
    for r in canon:
        firsts_by_wmo.setdefault(r["wmo_station_id"], set()).add(r["first_t"])
    assert len(canon) == len(rows)
    for wmo, vals in firsts_by_wmo.items():
        # the first station id of the group may have several rows; the value is one of theirs
        cands = {t for sid, w, ts, t, ing, eid in rows if w == wmo and sid == first[wmo][0]}
        assert len(vals) == 1 and vals <= cands
