"""Nearest place of each source: equal to comparing everything, with far fewer comparisons."""

import math
import random

import pytest

from wxmesh.operators import nearest as N

PLACES = "route_key string, lat double, lon double"
SOURCES = "station_id string, s_lat double, s_lon double"


def metres(a, b, c, d):
    la, lc = math.radians(a), math.radians(c)
    h = math.sin((lc - la) / 2) ** 2 + math.cos(la) * math.cos(lc) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371000.0 * math.asin(min(1.0, math.sqrt(h)))


def brute(sources, places):
    out = {}
    for i, la, lo in sources:
        best = min(((round(metres(la, lo, a, b), 3), k) for k, a, b in places), default=None)
        out[i] = best
    return out


def same(got, want):
    assert set(got) == set(want)
    for i, (d, k) in want.items():
        assert got[i][0] == pytest.approx(d, abs=2e-3)
        assert got[i][1] == k or got[i][0] <= d, (i, got[i], d, k)


def found(spark, sources, places):
    rows = N.nearest_place(spark.createDataFrame(sources, SOURCES), spark.createDataFrame(places, PLACES)).collect()
    assert len(rows) == len(sources)
    return {r["station_id"]: (r["route_dist"], r["route_key"]) for r in rows}


def test_anywhere_on_the_globe(spark):
    rng = random.Random(8)
    spot = lambda: (math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180))
    places = [(f"P{k:03d}", *spot()) for k in range(150)]
    places += [(f"Q{k:03d}", 48 + k % 20 * 1e-4, 11 + k // 20 * 1e-4) for k in range(200)]      # a dense town
    places += [("north", 90.0, 0.0), ("south", -90.0, 33.0), ("west", 0.0, -179.999), ("east", 0.5, 180.0)]
    sources = [(f"s{k}", *spot()) for k in range(120)]
    sources += [("pole", 89.99, 170.0), ("below", -90.0, -5.0), ("line", 0.0, 179.999), ("town", 48.00031, 11.0003),
                ("exact", 48.0, 11.0), ("turn", 0.0, 180.0)]
    same(found(spark, sources, places), brute(sources, places))


def test_ties_nulls_and_no_places(spark):
    places = [("b", 10.0, 10.0), ("a", 10.0, 10.0), ("c", 10.0, 20.0), (None, 1.0, 1.0), ("n", None, 3.0), ("x", float("nan"), 1.0)]
    sources = [("same", 10.0, 10.0), ("same too", 10.0, 10.0), ("between", 10.0, 15.0), ("no lat", None, 1.0), ("no number", 5.0, float("nan"))]
    got = found(spark, sources, places)
    assert got["same"] == got["same too"] == (0.0, "a") and got["between"][1] == "a"
    assert got["no lat"] == got["no number"] == (None, None)
    assert set(found(spark, sources, places[3:]).values()) == {(None, None)}


def test_an_island_does_not_meet_the_whole_coast(spark):
    """Sources off a coast: what is compared grows with the sources, not with the places."""
    rng = random.Random(3)
    compared = []
    for m in (500, 4000):
        places = [(f"P{k}", rng.uniform(-4, 4), rng.uniform(10.0, 11.0)) for k in range(m)]
        sources = [(f"s{k}", rng.uniform(-0.3, 0.3), rng.uniform(-0.3, 0.3)) for k in range(200)]
        p, s = spark.createDataFrame(places, PLACES), spark.createDataFrame(sources, SOURCES)
        same(found(spark, sources, places), brute(sources, places))
        pairs = N.candidate_pairs(s.select("s_lat", "s_lon"), *N.place_tree(p)).count()
        compared.append(pairs / len(sources))
    assert max(compared) < 80, compared        # of 500 and 4,000 places
