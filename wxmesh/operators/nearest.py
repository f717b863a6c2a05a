"""Nearest-place join (B13): for every source the nearest of all places, however far.

Places are points of the unit sphere, cut into a tree of cubes; a cube is eight
times finer on each axis than the one above it and knows the box of the places in
it. A source goes down the tree with the cubes that may hold its nearest place:
some place is no further than the far corner of the best box, so a box whose
near side is beyond that is never joined to anything below. Straight-line
distances grow with great-circle distances, so there are no special cases at the
poles or the antimeridian.

What a source is compared with follows the few boxes that touch its nearest
distance, not the places in a ring around it: sources on an island do not meet
all places across the water.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import DISTANCE_DECIMALS, haversine_m
from ..session import materialise

STEP = 3          # bits of each axis from one level to the next
LEVELS = 7        # the finest cubes are about 6 metres wide
LEAF = 16         # places of a cube that are compared one by one
MARGIN = 1e-8     # of the radius, 6 cm: distances are compared when rounded to millimetres
BROADCAST_MAX_CUBES = 500_000   # about 100 bytes each
AXES = ("x", "y", "z")


def _on_sphere(df: DataFrame, lat: str, lon: str) -> DataFrame:
    la, lo = F.radians(lat), F.radians(lon)
    return df.withColumns({"x": F.cos(la) * F.cos(lo), "y": F.cos(la) * F.sin(lo), "z": F.sin(la)})


def _cube(level: int) -> Column:
    """The number of the cube of a level that holds a point; level 0 is one cube."""
    side = 1 << (STEP * level)
    number = lambda axis: F.least(F.floor((F.col(axis) + 1) / 2 * side), F.lit(side - 1)).cast("long")
    return reduce(lambda code, axis: code * side + number(axis), AXES, F.lit(0).cast("long"))


def place_tree(places: DataFrame) -> tuple[DataFrame, DataFrame, list]:
    """The places (one row a point, least key) with their place on the sphere; the boxes of all
    levels; and for each level (boxes, most places in one) down to where a cube has few places."""
    known = "lat is not null and lon is not null and not isnan(lat) and not isnan(lon)"
    points = materialise(_on_sphere(
        places.filter("route_key is not null").filter(known).groupBy("lat", "lon").agg(F.min("route_key").alias("route_key")),
        "lat", "lon"), "places")
    nodes = F.array(*(F.struct(F.lit(k).alias("level"), _cube(k - 1).alias("up"), _cube(k).alias("cube"))
                      for k in range(1, LEVELS + 1)))
    extent = [f(a).alias(f"{n}_{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max))]
    boxes = materialise(points.select(*AXES, F.explode(nodes).alias("node")).select(*AXES, "node.*")
                        .groupBy("level", "up", "cube").agg(F.count(F.lit(1)).alias("n"), *extent), "boxes")
    sizes = boxes.groupBy("level").agg(F.count(F.lit(1)), F.max("n")).orderBy("level").collect()   # one row a level
    depth = next((k for k, (_, _, most) in enumerate(sizes, 1) if most <= LEAF), len(sizes))
    return points, boxes, [(count, most) for _, count, most in sizes[:depth]]


def candidate_pairs(spots: DataFrame, points: DataFrame, boxes: DataFrame, sizes: list) -> DataFrame:
    """Pairs of ``spots(s_lat, s_lon)`` and the places in the cubes that may hold their nearest place."""
    front = _on_sphere(spots, "s_lat", "s_lon").withColumn("cube", F.lit(0).cast("long"))
    for level, (count, _) in enumerate(sizes, 1):
        own = boxes.filter(F.col("level") == level).drop("level", "n").withColumnRenamed("cube", "below")
        if count <= BROADCAST_MAX_CUBES:
            own = F.broadcast(own)
        gap = [F.greatest(F.col(f"lo_{a}") - F.col(a), F.col(a) - F.col(f"hi_{a}"), F.lit(0.0)) for a in AXES]
        reach = [F.greatest(F.col(a) - F.col(f"lo_{a}"), F.col(f"hi_{a}") - F.col(a)) for a in AXES]
        length = lambda parts: F.sqrt(reduce(Column.__add__, [p * p for p in parts]))
        front = (front.join(own, F.col("cube") == F.col("up"))
                 .select("s_lat", "s_lon", *AXES, "below", length(gap).alias("near"), length(reach).alias("far"))
                 .withColumn("bound", F.min("far").over(Window.partitionBy("s_lat", "s_lon")))
                 .filter(F.col("near") <= F.col("bound") + MARGIN)
                 .select("s_lat", "s_lon", *AXES, F.col("below").alias("cube")))
    leaves = points.select("lat", "lon", "route_key", _cube(len(sizes)).alias("_leaf"))
    if sizes and sizes[-1][0] * max(1, sizes[-1][1]) <= BROADCAST_MAX_CUBES:   # no more places than that
        leaves = F.broadcast(leaves)
    return front.join(leaves, F.col("cube") == F.col("_leaf")).select("s_lat", "s_lon", "lat", "lon", "route_key")


def nearest_place(sources: DataFrame, places: DataFrame) -> DataFrame:
    """``station_id, route_key, route_dist`` of ``sources(station_id, s_lat, s_lon)`` and ``places(route_key, lat, lon)``.

    Distances are rounded to millimetres; of equally near places the least key
    counts. Places without a key or coordinates play no part. A source without
    coordinates, and every source if there are no places, gets nulls. Sources at
    one point are looked up once.
    """
    points, boxes, sizes = place_tree(places)
    spots = sources.select("s_lat", "s_lon").distinct().filter(
        "s_lat is not null and s_lon is not null and not isnan(s_lat) and not isnan(s_lon)")
    dist = F.round(haversine_m(F.col("s_lat"), F.col("s_lon"), F.col("lat"), F.col("lon")), DISTANCE_DECIMALS)
    best = (candidate_pairs(spots, points, boxes, sizes)
            .groupBy("s_lat", "s_lon").agg(F.min(F.struct(dist.alias("route_dist"), "route_key")).alias("_b")))
    return (sources.join(best, ["s_lat", "s_lon"], "left")
            .select("station_id", "_b.route_key", "_b.route_dist"))
