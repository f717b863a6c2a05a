"""Geometry as plain column expressions.

Spark 4.1 ships no usable spatial functions (the ST_* family is disabled), so
points are ``struct<x: double, y: double>`` with x = longitude, y = latitude,
and areas are multipolygons ``array<array<array<point>>>``. Everything here
is built from JVM-side expressions (arithmetic, and higher-order
``aggregate``/``transform`` for ring walks); no Python runs per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius in metres used for great-circle distances,
# and the number of decimals distances are rounded to (millimetres).
EARTH_RADIUS_M = 6371000.0
DISTANCE_DECIMALS = 3


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def point(lon, lat) -> Column:
    """H4: point from coordinates, x = lon, y = lat."""
    return F.struct(_c(lon).cast("double").alias("x"), _c(lat).cast("double").alias("y"))


def haversine_m(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_M) -> Column:
    """H6: great-circle distance in metres (haversine form)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    s_lat = F.sin(F.radians(lat2 - lat1) / 2.0)
    s_lon = F.sin(F.radians(lon2 - lon1) / 2.0)
    a = s_lat * s_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s_lon * s_lon
    return F.lit(2.0 * radius) * F.asin(F.sqrt(a))


# The centroid is one SQL expression (higher-order functions). Written as SQL
# text it is built with a single call instead of hundreds of small ones.
#   o      first vertex (origin for the moments, keeps precision)
#   per ring: doubled signed area a and first moments mx, my by the shoelace
#   sum over edges; the wrap-around edge uses a modulo index, so closed and
#   open rings give the same result
#   per part: the first ring (k = 0) is the shell and adds, later rings are
#   holes and subtract, whatever their winding (sign of a is normalised)
#   centroid = o + (sum mx, sum my) / (3 * sum a); null for zero area
_CENTROID_SQL = """
get(transform(array(get(get(get({g}, 0), 0), 0)), o ->
  get(transform(array(aggregate(
    flatten(transform({g}, part -> transform(part, (r, k) ->
      get(transform(array(
        aggregate(sequence(0, greatest(size(r) - 1, 0)),
                  named_struct('a', 0D, 'mx', 0D, 'my', 0D),
                  (acc, i) -> get(transform(array(named_struct(
                      'x0', get(r, i).x - o.x, 'y0', get(r, i).y - o.y,
                      'x1', get(r, pmod(i + 1, size(r))).x - o.x,
                      'y1', get(r, pmod(i + 1, size(r))).y - o.y)),
                    e -> get(transform(array(e.x0 * e.y1 - e.x1 * e.y0), cr ->
                      named_struct('a', acc.a + cr,
                                   'mx', acc.mx + (e.x0 + e.x1) * cr,
                                   'my', acc.my + (e.y0 + e.y1) * cr)), 0)), 0))),
        m -> get(transform(array(signum(m.a) * CASE WHEN k = 0 THEN 1D ELSE -1D END), sg ->
               named_struct('a', sg * m.a, 'mx', sg * m.mx, 'my', sg * m.my)), 0)), 0)))),
    named_struct('a', 0D, 'mx', 0D, 'my', 0D),
    (tot, m2) -> named_struct('a', tot.a + m2.a, 'mx', tot.mx + m2.mx, 'my', tot.my + m2.my))),
  t -> CASE WHEN t.a != 0D THEN named_struct('x', o.x + t.mx / (t.a * 3D),
                                             'y', o.y + t.my / (t.a * 3D)) END), 0)), 0)
"""


def centroid(geometry: str) -> Column:
    """H5: area-weighted centroid of a multipolygon column (by name).

    Per part, the first ring is the shell (adds) and later rings are holes
    (subtract), whatever their winding; parts add up. Returns a point.
    """
    if not isinstance(geometry, str):
        raise TypeError("centroid() takes a column name")
    return F.expr(_CENTROID_SQL.format(g=f"`{geometry}`"))


def polygon_to_multipolygon(coords) -> Column:
    """GeoJSON Polygon coordinates ``array<array<array<double>>>`` -> multipolygon."""
    c = _c(coords)
    return F.array(F.transform(c, lambda ring: F.transform(
        ring, lambda xy: F.struct(F.get(xy, 0).alias("x"), F.get(xy, 1).alias("y")))))


def multipolygon_coords(coords) -> Column:
    """GeoJSON MultiPolygon coordinates (4-deep double arrays) -> multipolygon."""
    c = _c(coords)
    return F.transform(c, lambda part: F.transform(part, lambda ring: F.transform(
        ring, lambda xy: F.struct(F.get(xy, 0).alias("x"), F.get(xy, 1).alias("y")))))


def from_wkt(text) -> Column:
    """H7: WKT ``POLYGON`` / ``MULTIPOLYGON`` text -> multipolygon; anything else (or EMPTY) -> null.

    The text is rewritten as nested JSON lists, which Spark parses; a third
    coordinate is left out.
    """
    t = F.upper(F.trim(_c(text)))
    number = r"[-+]?[0-9.]+(?:E[-+]?[0-9]+)?"
    lists = F.translate(F.regexp_replace(F.regexp_extract(t, r"^(?:MULTI)?POLYGON\s*Z?\s*(\(.*\))$", 1),
                                         rf"({number})\s+({number})(?:\s+{number})?", "[$1,$2]"), "()", "[]")
    return (F.when(lists == "", F.lit(None)).when(t.startswith("MULTIPOLYGON"), multipolygon_coords(F.from_json(lists, "array<array<array<array<double>>>>")))
             .when(t.startswith("POLYGON"), polygon_to_multipolygon(F.from_json(lists, "array<array<array<double>>>"))))


def bounding_box_filter(lat, lon, center_lat: float, center_lon: float, radius_m: float) -> Column:
    """Cheap, exact-superset prefilter for a radius around a fixed centre.

    Longitudes are in -180..180. A box that crosses the antimeridian is two
    ranges, and one that reaches a pole (or spans the globe) has no longitude
    bound.
    """
    dlat = math.degrees(radius_m / EARTH_RADIUS_M)
    ratio = math.sin(min(radius_m / EARTH_RADIUS_M, math.pi / 2)) / max(math.cos(math.radians(center_lat)), 1e-12)
    polar = ratio >= 1 or abs(center_lat) + dlat >= 90
    dlon = 180.0 if polar else math.degrees(math.asin(ratio))
    dlat, dlon = dlat * 1.000001 + 1e-9, dlon * 1.000001 + 1e-9
    box = _c(lat).between(center_lat - dlat, center_lat + dlat)
    low, high = center_lon - dlon, center_lon + dlon
    if dlon >= 180.0:
        return box
    if low < -180.0:
        return box & ((_c(lon) <= high) | (_c(lon) >= low + 360.0))
    if high > 180.0:
        return box & ((_c(lon) >= low) | (_c(lon) <= high - 360.0))
    return box & _c(lon).between(low, high)


def within_radius(lat, lon, center_lat: float, center_lon: float, radius_m: float) -> Column:
    """Places within ``radius_m`` of a centre (bounding box, then exact)."""
    return (bounding_box_filter(lat, lon, center_lat, center_lon, radius_m)
            & (centre_distance_m(lat, lon, center_lat, center_lon) <= radius_m))


def centre_distance_m(lat, lon, center_lat: float, center_lon: float) -> Column:
    """Rounded distance to a fixed centre."""
    return F.round(haversine_m(F.lit(center_lat), F.lit(center_lon), lat, lon), DISTANCE_DECIMALS)
