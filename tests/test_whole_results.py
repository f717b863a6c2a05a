"""Queries on tables large enough that a cut of their result would show."""

import random

import __spark_entry__ as entry
from compare_util import compare, duck
from wxmesh.plans import products as P


def test_station_rank_has_every_rank(spark):
    sf_dir = "/root/testdata/sf0.1"
    r = compare(entry.queries()["station_rank"](spark, sf_dir), duck(sf_dir), entry.oracle_sql()["station_rank"])
    assert r["ok"], r["rows"]
    assert max(row[r["spark_cols"].index("station_rank")] for row in r["s_rows"]) > 50


def test_one_dense_area_is_ranked_across_partitions(spark):
    rng = random.Random(4)
    rows = [(f"W{k}", "dense", rng.randrange(3_000) / 8) for k in range(6_000)]
    rows += [(f"W{k}", f"a{k % 7}", rng.randrange(5) * 1.5) for k in range(70)] + [("W1", "z", 0.0)]
    got = P.rank_all_stations(spark.createDataFrame(rows, "wmo_station_id string, postal_code string, dist double")).collect()
    order = {a: {d: n for n, d in enumerate(sorted({d for _, b, d in rows if b == a}), 1)} for a in {a for _, a, _ in rows}}
    assert sorted(map(tuple, got)) == sorted((w, a, d, order[a][d]) for w, a, d in rows)


def test_grid_join_matches_in_every_box(spark):
    sf_dir = "/root/testdata/sf0.1"
    r = compare(entry.queries()["distance_join_grid"](spark, sf_dir), duck(sf_dir), entry.oracle_sql()["distance_join_grid"])
    assert r["ok"], r["rows"]
    at = r["spark_cols"].index("postal_code")
    boxes = [int(row[at][1:]) // 1500 for row in r["s_rows"]]
    assert set(boxes) == set(range(10)) and min(map(boxes.count, range(10))) > 0.7 * max(map(boxes.count, range(10)))


def test_range_lookup_is_a_search_of_the_bounds(spark):
    """Every key in the range that counting all bounds gives, for few and for ten thousand bounds."""
    from bisect import bisect_right

    from wxmesh.operators.ingest import range_part

    keys = [f"{k:06d}" for k in range(0, 100_000, 37)] + ["", "zzz", "050000"]
    frame = spark.createDataFrame([(k,) for k in keys] + [(None,)], "key string")
    for n in (1, 2, 3, 8, 1000, 10_000):
        bounds = [f"{k * (100_000 // n):06d}" for k in range(n)]
        got = {r["key"]: r["p"] for r in frame.select("key", range_part("key", bounds).alias("p")).collect()}
        assert got.pop(None) == 0 and got == {k: bisect_right(bounds[1:], k) for k in keys}
