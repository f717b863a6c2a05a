"""Areas: collection documents split over tasks, mixed layouts, and polygon repair against winding numbers."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wxmesh import schemas
from wxmesh.operators.repair import clean_ring, few_meetings, few_winding, meetings, repair, repair_areas, signed_area, winding
from wxmesh.plans import pipeline
from wxmesh.sources import landed

SQUARE = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]


def feature(code, *order, **more):
    members = {"type": "Feature", "properties": {"postcode": code, "note": 'a "quoted" },{ "type": brace'},
               "geometry": {"type": "Polygon", "coordinates": [SQUARE]}, **more}
    return {k: members[k] for k in (order or members)}


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def collection(features, indent=None, **more):
    return json.dumps({"type": "FeatureCollection", **more, "features": features, "crs": {"type": "name"}}, indent=indent)


def codes(spark, path, layout="collection"):
    rows, rejects = landed.read_geojson(spark, path, layout=layout)
    return sorted(r["plz"] for r in rows.collect()), sorted(r["reason"] for r in rejects.collect())


LAST = ("properties", "geometry", "type")


@pytest.mark.parametrize("order", [(), LAST, ("id", "type", "properties", "geometry")])
@pytest.mark.parametrize("indent", [None, 2])
def test_a_collection_is_split_over_tasks(spark, tmp_dir, order, indent):
    want = [f"{k:05d}" for k in range(2000)]
    write(f"{tmp_dir}/c", "all.geojson", collection([feature(c, *order, id=5) if order else feature(c) for c in want], indent))
    size = os.path.getsize(f"{tmp_dir}/c/all.geojson")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 23))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        pieces = landed.collection_pieces(spark, f"{tmp_dir}/c")
        assert pieces.rdd.getNumPartitions() > 10
        assert codes(spark, f"{tmp_dir}/c") == (want, [])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_every_feature_of_a_collection_is_a_row_or_a_reject(spark, tmp_dir):
    odd = [feature("1"), feature("2", geometry=None), feature("3", geometry={"type": "Point", "coordinates": [1, 2]}),
           feature("4", geometry={"type": "Polygon", "coordinates": [[["a", 2]]]}), feature(None), feature("6")]
    write(f"{tmp_dir}/c", "odd.geojson", collection(odd))
    assert codes(spark, f"{tmp_dir}/c") == (["1", "6"], ["bad coordinates", "no geometry", "no postcode", "not a polygon"])
    write(f"{tmp_dir}/d", "none.geojson", collection([]))
    assert codes(spark, f"{tmp_dir}/d") == ([], [])
    write(f"{tmp_dir}/e", "cut.geojson", collection([feature("1"), feature("2")])[:-200])
    assert codes(spark, f"{tmp_dir}/e") == (["1"], ["malformed document"])
    write(f"{tmp_dir}/f", "both.geojson", collection([feature("1"), feature("2", "properties", "type", "geometry"), feature("3")]))
    assert codes(spark, f"{tmp_dir}/f")[1]  # what one piece cannot hold is told, not lost


def test_files_of_both_layouts_load_together(spark, tmp_dir):
    write(f"{tmp_dir}/in", "a.geojson", collection([feature("10115"), feature("10117"), feature("99999")], 1))
    write(f"{tmp_dir}/in", "b.jsonl", "".join(json.dumps(feature(c)) + "\n" for c in ("12043", "13347")) + "not json\n")
    rejects = pipeline.load_areas(spark, f"{tmp_dir}/in", f"{tmp_dir}/raw", "2024-01-01 00:00:00")
    assert sorted(r["plz"] for r in schemas.read_raw(spark, f"{tmp_dir}/raw", "postal_codes").collect()) == ["10115", "10117", "12043", "13347"]
    assert [(r["reason"], r["value"]) for r in rejects.collect()] == [("malformed document", "not json")]
    assert spark.read.parquet(f"{tmp_dir}/raw/rejects/areas").count() == 1


# ------------------------------------------------------------------ repair --

def wound(point, ring):
    x, y = point
    times = 0
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
        side = (x1 - x0) * (y - y0) - (x - x0) * (y1 - y0)
        times += (y0 <= y < y1 and side > 0) - (y1 <= y < y0 and side < 0)
    return times


def extent(shape):
    return sum(abs(signed_area(clean_ring(ring))) / 2 * (1 if k == 0 else -1) for part in shape for k, ring in enumerate(part))


@pytest.mark.parametrize("seed", range(120))
def test_a_repaired_area_covers_what_its_rings_wind_around(seed):
    rng = random.Random(seed)
    at = (lambda: rng.random() * 10) if seed % 2 else (lambda: float(rng.randrange(7)))
    shape = []
    for _ in range(rng.randrange(1, 4)):
        shape.append([])
        for _ in range(rng.randrange(1, 3)):
            ring = [(at(), at()) for _ in range(rng.randrange(3, 9))]
            shape[-1].append(ring + ring[:1])
    sound = repair(shape)
    again = repair(sound)
    assert extent(again) == pytest.approx(extent(sound), abs=1e-9)
    senses = []
    for part in shape:
        for k, ring in enumerate(part):
            ring = clean_ring(ring)
            if len(ring) > 2:
                senses.append(ring if (signed_area(ring) > 0) == (k == 0) else ring[::-1])
    for _ in range(60):
        p = (rng.random() * 10 + 1e-4, rng.random() * 10 + 1e-4)
        covered = [part for part in sound if wound(p, clean_ring(part[0])) and not any(wound(p, clean_ring(h)) for h in part[1:])]
        assert len(covered) == (sum(wound(p, ring) for ring in senses) > 0)


def test_sound_areas_stay_as_they_are(spark):
    shape = [[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (1.0, 1.0)]],
             [[(5.0, 0.0), (6.0, 0.0), (6.0, 1.0), (5.0, 0.0)]]]
    assert repair(shape) is shape
    assert repair([]) == [] and repair([[[(1.0, 1.0)]]]) == []
    schema = "plz string, geometry array<array<array<struct<x:double,y:double>>>>, x string"
    rows = [("1", [[[{"x": x, "y": y} for x, y in r] for r in p] for p in shape], "k"), ("2", None, None), ("3", [], "e"),
            ("4", [[[{"x": 1.0, "y": 1.0}] * 4]], None)]
    got = {r["plz"]: r for r in repair_areas(spark.createDataFrame(rows, schema)).collect()}
    assert [[[(p["x"], p["y"]) for p in ring] for ring in part] for part in got["1"]["geometry"]] == shape
    assert got["2"]["geometry"] is None and not got["3"]["geometry"] and not got["4"]["geometry"] and got["1"]["x"] == "k"


def test_areas_of_one_file_are_repaired_by_all_tasks(spark):
    box = "array(array(array(named_struct('x', id + 0D, 'y', 0D), named_struct('x', id + 2D, 'y', 2D), named_struct('x', id + 2D, 'y', 0D), " \
          "named_struct('x', id + 0D, 'y', 2D), named_struct('x', id + 0D, 'y', 0D))))"
    areas = spark.range(400).selectExpr("id", f"IF(id % 4 = 0, NULL, {box}) AS geometry").coalesce(1)
    mended = repair_areas(areas).withColumn("task", F.spark_partition_id())
    rows = mended.collect()
    assert sorted(r["id"] for r in rows) == list(range(400))
    assert all((r["geometry"] is None) == (r["id"] % 4 == 0) for r in rows)
    sizes = [r["count"] for r in mended.groupBy("task").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 100


@pytest.mark.parametrize("seed", range(40))
def test_few_edges_are_cut_and_wound_as_many_are(seed):
    rng = random.Random(seed)
    at = (lambda: rng.random()) if seed % 2 else (lambda: float(rng.randrange(4)))
    ends = [(at(), at()) for _ in range(24)]
    edges = [(p, q) for p, q in zip(ends, ends[1:]) if p != q]
    a, b = (np.array([e[k] for e in edges]) for k in (0, 1))
    assert few_meetings(edges, 11) == meetings(a, b, 11)
    points = [(rng.random() * 4, rng.random() * 4) for _ in range(30)] + ends
    times = [rng.choice((-1, 1, 2)) for _ in edges]
    assert few_winding(points, edges, times) == winding(np.array(points), a, b, np.array(times)).tolist()
