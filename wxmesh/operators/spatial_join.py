"""Distance join: all (point, area) pairs within a radius.

The reference forms the full cross product and filters it. Here the join is
an equi-join on grid cells so its cost follows the number of *near* pairs,
not |points| x |areas|:

* the sphere is cut into cells of ``cell`` degrees of latitude (at least the
  search radius) and ``360 / nx`` degrees of longitude; a point lies in one
  cell, so no pair can be produced twice;
* each area (centre) lists every cell its search cap can touch: the latitude
  band ``lat +- d`` and the longitude band ``lon +- asin(sin(d) / cos(lat))``
  (the exact longitude extent of a spherical cap), wrapped at the
  antimeridian, and the whole ring of cells when the cap reaches a pole;
* the candidates are filtered by the exact haversine distance, rounded to
  millimetres as everywhere else.

The point side (stations: one row per place) is broadcast only after its
rows and bytes are measured against the bounds below; the areas then stream through the join in their own partitions, so the pair distances are
computed by all tasks. Beyond the bound no side is forced: adaptive
execution picks the join from measured sizes, and a shuffled join on the
cell key has its skewed cells split by the skew-join rule.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import DISTANCE_DECIMALS, EARTH_RADIUS_M, haversine_m

# Candidate margin in metres: the filter keeps rounded distances <= radius,
# so true distances up to radius + 0.5 mm qualify.
SEARCH_MARGIN_M = 1.0

# Largest point side broadcast to every task, in rows and in bytes.
POINT_BROADCAST_MAX_ROWS = 1_000_000
POINT_BROADCAST_MAX_BYTES = 64 << 20


def grid_shape(radius_m: float) -> tuple[float, int, float]:
    """(cell height in degrees, number of longitude cells, cell width in degrees)."""
    cell = math.degrees((radius_m + SEARCH_MARGIN_M) / EARTH_RADIUS_M)
    cell = math.ceil(cell * 1e4) / 1e4
    nx = max(1, int(360.0 // cell))
    return cell, nx, 360.0 / nx


def _cell_y(lat: Column, cell: float) -> Column:
    return F.floor((lat + 90.0) / cell)


def _cell_x(lon: Column, width: float, nx: int) -> Column:
    return F.pmod(F.floor((lon + 180.0) / width), F.lit(nx))


def point_cells(df: DataFrame, lat: str, lon: str, radius_m: float) -> DataFrame:
    cell, nx, width = grid_shape(radius_m)
    return df.withColumn("_cx", _cell_x(F.col(lon), width, nx)) \
             .withColumn("_cy", _cell_y(F.col(lat), cell))


def cover_cells(df: DataFrame, lat: str, lon: str, radius_m: float) -> DataFrame:
    """One row per (area, cell) the search cap around (lat, lon) touches."""
    cell, nx, width = grid_shape(radius_m)
    delta = (radius_m + SEARCH_MARGIN_M) / EARTH_RADIUS_M
    dlat = math.degrees(delta)
    la, lo = F.col(lat), F.col(lon)
    ratio = F.lit(math.sin(delta)) / F.cos(F.radians(la))
    polar = (F.abs(la) + dlat >= 90.0) | (ratio >= 1.0)
    dlon = F.degrees(F.asin(F.least(ratio, F.lit(1.0))))
    x_lo = F.floor((lo - dlon + 180.0) / width)
    x_hi = F.floor((lo + dlon + 180.0) / width)
    full = polar | (x_hi - x_lo + 1 >= nx)
    xs = F.when(full, F.sequence(F.lit(0).cast("bigint"), F.lit(nx - 1).cast("bigint"))) \
          .otherwise(F.transform(F.sequence(x_lo, x_hi), lambda x: F.pmod(x, F.lit(nx))))
    ys = F.sequence(_cell_y(la - dlat, cell), _cell_y(la + dlat, cell))
    return (df.withColumn("_cx", F.explode(F.array_distinct(xs)))
              .withColumn("_cy", F.explode(ys)))


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Whether ``df`` is small enough to broadcast, by one aggregate over its rows.

    Fixed-width columns count 16 bytes a row; text counts its own length.
    """
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(16 * (len(df.columns) - len(texts))))
    rows, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and total <= max_bytes


def distance_join(points: DataFrame, areas: DataFrame, radius_m: float, *,
                  point_lat: str = "lat", point_lon: str = "lon",
                  area_lat: str = "area_lat", area_lon: str = "area_lon",
                  dist_col: str = "dist", measured: DataFrame | None = None) -> DataFrame:
    """Pairs of ``points`` x ``areas`` with rounded distance <= ``radius_m``.

    Column names of the two inputs must be disjoint. The output has all
    columns of both sides (without the helper cell columns) plus ``dist_col``.
    ``measured`` is a cheap frame with the same columns that has at least the
    rows of ``points``, if the caller knows one; its size is measured then.
    """
    p = point_cells(points, point_lat, point_lon, radius_m)
    if fits_broadcast(points if measured is None else measured, POINT_BROADCAST_MAX_ROWS, POINT_BROADCAST_MAX_BYTES):
        p = F.broadcast(p)
    a = cover_cells(areas, area_lat, area_lon, radius_m)
    pairs = p.join(a, ["_cx", "_cy"], "inner")
    dist = F.round(haversine_m(F.col(area_lat), F.col(area_lon),
                               F.col(point_lat), F.col(point_lon)), DISTANCE_DECIMALS)
    return (pairs.withColumn(dist_col, dist)
                 .filter(F.col(dist_col) <= radius_m)
                 .drop("_cx", "_cy"))
