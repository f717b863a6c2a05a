"""Registered queries on landed files, streams and the whole job.

Each lands documents derived from the driver tables, runs the loading job on
them and reads its tables back whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.geo import centroid
from ..operators import ingest as I
from ..operators.repair import repair_areas
from ..session import delete_path, scratch_path
from ..sources import fixtures as fx
from ..sources import landed
from ..streaming import incremental as S
from . import moving_marts as M
from . import pipeline as J
from . import products as P
from .catalog import (
    _GLOBAL_SQL,
    ACTIVE_SOURCES,
    FC_ISSUED_SPLIT,
    FC_NOW,
    OBS_LOADED_BEFORE,
    OBS_NOW,
    _global_sources,
    _in,
    register,
)
from .oracle import D, hav, with_ctes

NULL_WMO_ALLOWED = [("stg_observations", "not_null(wmo_station_id)"), ("stg_forecasts", "not_null(wmo_station_id)")]
FC_FAR = "2024-02-08 00:00:00"                # forecasts from here on are replaced as a whole
LATER = "2024-02-06 18:00:00"                 # a restart a day after FC_NOW


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _lines(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).text(path)
    return path


# ------------------------------------------------------ landed files, A4-A7

@register("read_geojson_areas", with_ctes(
    "SELECT postal_code AS plz, round(cx, 9) AS cx, round(cy, 9) AS cy FROM stg_areas"))
def q_read_geojson_areas(spark, sf_dir):
    """Areas landed as MultiPolygon and Polygon features, and features without geometry."""
    raw = _in(spark, sf_dir).raw_postal
    path = scratch_path(spark, "areas-geojson")
    odd = F.substring("plz", -1, 1).cast("int") % 2 == 1
    landed.land_areas_geojson(raw.filter(~odd), path)
    ring = F.to_json(F.transform(F.col("geometry")[0][0], lambda p: F.array(p["x"], p["y"])))
    one = F.concat(F.lit('{"type":"Feature","properties":{"postcode":"'), "plz",
                   F.lit('"},"geometry":{"type":"Polygon","coordinates":['), ring, F.lit("]}}"))
    none = F.concat(F.lit('{"properties":{"postcode":"10'), "plz", F.lit('"},"geometry":null}'))
    _lines(raw.filter(odd).select(one.alias("value")).unionByName(raw.select(none.alias("value"))), path, "append")
    c = centroid("geometry")
    return landed.read_geojson_areas(spark, path, prefixes=P.AREA_PREFIXES).select(
        "plz", F.round(c["x"], 9).alias("cx"), F.round(c["y"], 9).alias("cy"))


_SQUARE = "[[[[1.0,2.0],[1.0,3.0],[2.0,3.0],[1.0,2.0]]]]"
_FEATURES = (  # by nation key modulo 6: the line after the postcode, and the verdict
    (f'"}},"geometry":{{"type":"MultiPolygon","coordinates":{_SQUARE}}}}}', None),
    ('"},"geometry":null}', "no geometry"),
    ('"},"geometry":{"type":"Point","coordinates":[1.0,2.0]}}', "not a polygon"),
    ('"},"geometry":{"type":"Polygon","coordinates":[[["a",2.0]]]}}', "bad coordinates"),
    ('"},"geometry":{"type":"Polyg', "malformed document"),
    (f'"}},"geometry":{{"type":"MultiPolygon","coordinates":{_SQUARE}}}}}', None),
)


@register("read_geojson_rejects", "SELECT reason, value FROM (SELECT CASE n_nationkey % 6 " + " ".join(
    f"WHEN {k} THEN '{reason}'" for k, (_, reason) in enumerate(_FEATURES) if reason) + " END AS reason, " + """
CASE WHEN n_nationkey % 6 IN (0, 5) THEN CAST(n_nationkey AS VARCHAR)
ELSE '{"properties":{"postcode":"' || CAST(n_nationkey AS VARCHAR) || CASE n_nationkey % 6 """ + " ".join(
    f"WHEN {k} THEN '{tail}'" for k, (tail, reason) in enumerate(_FEATURES) if reason) + " END END AS value FROM nation)")
def q_read_geojson_rejects(spark, sf_dir):
    """Every landed feature is a row (null reason, its code) or a reject with reason and line."""
    k = F.col("n_nationkey")
    tail = F.get(F.array(*[F.lit(t) for t, _ in _FEATURES]), (k % 6).cast("int"))
    line = F.concat(F.lit('{"properties":{"postcode":"'), k.cast("string"), tail)
    path = _lines(fx.table(spark, sf_dir, "nation").select(line.alias("value")), scratch_path(spark, "features"))
    rows, rejects = landed.read_geojson(spark, path)
    return rows.select(F.lit(None).cast("string").alias("reason"), F.col("plz").alias("value")).unionByName(
        rejects.select("reason", "value"))


def _customer_shapes(spark, sf_dir) -> DataFrame:
    """``key, geometry``: every customer an area whose points are those of its kind, in hundredths of a degree from its own corner."""
    k = F.col("c_custkey")
    kind = F.get(F.array(*[F.expr("array(" + ", ".join(
        "array(" + ", ".join("array(" + ", ".join(f"named_struct('x', {x}D, 'y', {y}D)" for x, y in ring) + ")" for ring in part) + ")"
        for part in shape) + ")") for shape, _ in _SHAPES]), (k % len(_SHAPES)).cast("int"))
    moved = F.transform(kind, lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: F.struct(
        ((k % 500) / 10.0 + p["x"] / 100.0).alias("x"), ((k % 300) / 10.0 + p["y"] / 100.0).alias("y")))))
    return fx.table(spark, sf_dir, "customer").select(k.cast("string").alias("key"), moved.alias("geometry"))


_BOX = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
#: Shapes and where the centroid of what they cover lies (as SQL, null: they cover nothing).
_SHAPES = (
    ([[_BOX]], ("1", "1")),
    ([[[(0, 0), (4, 4), (4, 0), (0, 1), (0, 0)]]], ("8.8 / 3", "1.6")),                                 # bow-tie: its larger lobe
    ([[[(0, 0), (0, 2), (1, 1), (2, 2), (2, 0), (1, 1), (0, 0)]]], ("1", "1")),                         # two lobes that touch
    ([[[(0, 0), (2, 0), (2, 1), (5, 1), (2, 1), (2, 2), (0, 2), (0, 0)]]], ("1", "1")),                 # spike
    ([[_BOX], [[(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]]], ("1.5", "1.5")),                             # overlapping parts
    ([[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]], [_BOX]], ("2", "2")),                                 # a part within a part
    ([[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(3, 1), (6, 1), (6, 2), (3, 2), (3, 1)]]], ("1.9", "30.5 / 15")),  # hole beyond the shell
    ([[[(0, 0), (2, 0), (1, 0), (0, 0)]]], ("NULL", "NULL")),                                           # no extent
    ([[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]]], ("30.5 / 15", "30.5 / 15")),  # sound, with a hole
)


def _centre_sql(axis: int, step: str) -> str:
    return (f"round({step} / 10.0{D} + (CASE c_custkey % {len(_SHAPES)} "
            + " ".join(f"WHEN {k} THEN {c[axis]}" for k, (_, c) in enumerate(_SHAPES)) + f" END) / 100.0{D}, 6)")


@register("polygon_repair", f"""
SELECT CAST(c_custkey AS VARCHAR) AS key, {_centre_sql(0, "c_custkey % 500")} AS cx, {_centre_sql(1, "c_custkey % 300")} AS cy
FROM customer""")
def q_polygon_repair(spark, sf_dir):
    """Bow-ties, spikes, overlapping and nested parts and stray holes: the centroid of what the repaired area covers."""
    c = centroid("geometry")
    return repair_areas(_customer_shapes(spark, sf_dir)).select("key", F.round(c["x"], 6).alias("cx"), F.round(c["y"], 6).alias("cy"))


@register("read_geojson_collection", f"""
SELECT 'C' || CAST(c_custkey AS VARCHAR) AS plz, {_centre_sql(0, "c_custkey % 500")} AS cx, {_centre_sql(1, "c_custkey % 300")} AS cy
FROM customer WHERE c_custkey % {len(_SHAPES)} IN (0, {len(_SHAPES) - 1})""")
def q_read_geojson_collection(spark, sf_dir):
    """Collection documents of many features, read in as many tasks as their bytes ask for; the type first in one, last in the other."""
    areas = _customer_shapes(spark, sf_dir).filter(F.col("key").cast("long") % len(_SHAPES) % (len(_SHAPES) - 1) == 0) \
        .select(F.concat(F.lit("C"), "key").alias("plz"), "geometry")
    path, odd = scratch_path(spark, "collections"), F.xxhash64("plz") % 2 == 0
    landed.land_areas_collection(areas.filter(odd), f"{path}/first")
    landed.land_areas_collection(areas.filter(~odd), f"{path}/last", type_first=False, separator=" , ")
    c = centroid("geometry")
    return landed.read_geojson_areas(spark, f"{path}/*", layout="collection").select(
        "plz", F.round(c["x"], 6).alias("cx"), F.round(c["y"], 6).alias("cy"))


@register("read_stations_json", with_ctes("""
SELECT id, wmo_station_id, station_name, observation_type, lat, lon, last_record FROM raw_stations"""))
def q_read_stations_json(spark, sf_dir):
    """A4: stations landed as source documents."""
    path = scratch_path(spark, "stations-json")
    landed.land_stations_json(_in(spark, sf_dir).raw_stations, path)
    return landed.read_stations_json(spark, path).select(
        "id", "wmo_station_id", "station_name", "observation_type", "lat", "lon", "last_record")


@register("read_weather_json", with_ctes("""
SELECT station_id, "timestamp", temperature, precipitation, relative_humidity, wind_speed FROM raw_obs"""))
def q_read_weather_json(spark, sf_dir):
    """A5: observations landed as weather documents."""
    path = scratch_path(spark, "weather-json")
    rows = _in(spark, sf_dir).raw_obs.select(
        "station_id", "timestamp", "temperature", "precipitation", "relative_humidity", "wind_speed")
    landed.land_weather_json(rows, path)
    return landed.read_weather_json(spark, path).select(
        "station_id", "timestamp", "temperature", "precipitation", "relative_humidity", "wind_speed")


_ENTRY = '"weather":[{"timestamp":"2024-01-02T03:04:05.250+02:00","temperature":'
_DOCS = (  # by event id modulo 8: the document around the event id, the verdict, what is shown
    ('{"station_id":"S",' + _ENTRY, '}]}', None, None),
    ('{"station_id":"S","weather":[{"timestamp":"2024-13-45","temperature":', '}]}', "bad timestamp",
     ('{"timestamp":"2024-13-45","temperature":"', '"}')),
    ('{"station_id":"S","weather":[{"temperature":', '}]}', "no timestamp", ('{"temperature":"', '"}')),
    ('{' + _ENTRY, '}]}', "no station id", ('{"timestamp":"2024-01-02T03:04:05.250+02:00","temperature":"', '"}')),
    ('{"station_id":"S",' + _ENTRY, '', "malformed document", ('{"station_id":"S",' + _ENTRY, '')),
    ('{"station_id":"S","weather":[null],"x":', '}', "empty entry", ('{"station_id":"S","weather":[null],"x":', '}')),
    ('{"station_id":"S","weather":[],"x":', '}', None, None),
    ('{"station_id":"S","weather":null,"x":', '}', None, None),
)


@register("read_weather_rejects", "SELECT * FROM (" + "\nUNION ALL\n".join(
    [f"SELECT NULL AS reason, 'S' AS value, CAST(event_id AS DOUBLE) AS temperature, TIMESTAMP '2024-01-02 01:04:05.25' AS at "
     "FROM events WHERE event_id % 8 = 0"] +
    [f"SELECT '{reason}' AS reason, '{shown[0]}' || CAST(event_id AS VARCHAR) || '{shown[1]}' AS value, "
     f"CAST(NULL AS DOUBLE) AS temperature, CAST(NULL AS TIMESTAMP) AS at FROM events WHERE event_id % 8 = {k}"
     for k, (_, _, reason, shown) in enumerate(_DOCS) if reason]) + ")")
def q_read_weather_rejects(spark, sf_dir):
    """Every landed entry is a row (with its sub-second time in UTC) or a reject with reason and value."""
    e = F.col("event_id")
    part = lambda n: F.get(F.array(*[F.lit(d[n]) for d in _DOCS]), (e % 8).cast("int"))
    line = F.concat(part(0), e.cast("string"), part(1))
    path = _lines(fx.table(spark, sf_dir, "events").select(line.alias("value")), scratch_path(spark, "weather-lines"))
    rows, rejects = landed.read_weather(spark, path)
    return rows.select(F.lit(None).cast("string").alias("reason"), F.col("station_id").alias("value"), "temperature",
                       F.col("timestamp").alias("at")).unionByName(
        rejects.select("reason", "value", F.lit(None).cast("double").alias("temperature"),
                       F.lit(None).cast("timestamp_ntz").alias("at")))


# ----------------------------------------------------------- binding, A9, H13

@register("bind_types", f"""
SELECT l_orderkey * 10 + l_linenumber AS k,
       TRY_CAST(l_quantity * 0.5{D} AS BIGINT) AS wind_direction,
       TRY_CAST(CASE l_partkey % 4 WHEN 0 THEN CAST(l_partkey AS VARCHAR) || '.5' WHEN 1 THEN '-' || CAST(l_partkey AS VARCHAR) || '.5'
                WHEN 2 THEN CAST(l_partkey AS VARCHAR) || '.0' ELSE 'n/a' END AS BIGINT) AS cloud_cover,
       TRY_CAST(-1.0{D} * l_quantity / 4.0{D} AS BIGINT) AS relative_humidity,
       TRY_CAST(CASE WHEN l_linenumber = 1 THEN 1e30{D} ELSE l_linenumber + 0.25{D} END AS BIGINT) AS visibility
FROM lineitem""")
def q_bind_types(spark, sf_dir):
    """Fractions, halves, text, bad and too large values bound to integer columns."""
    li = fx.table(spark, sf_dir, "lineitem")
    p = F.col("l_partkey").cast("string")
    text = (F.when(F.col("l_partkey") % 4 == 0, F.concat(p, F.lit(".5"))).when(F.col("l_partkey") % 4 == 1, F.concat(F.lit("-"), p, F.lit(".5")))
            .when(F.col("l_partkey") % 4 == 2, F.concat(p, F.lit(".0"))).otherwise(F.lit("n/a")))
    batch = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"),
                      (F.col("l_quantity") * 0.5).cast("double").alias("wind_direction"), text.alias("cloud_cover"),
                      (F.lit(-1.0) * F.col("l_quantity") / 4.0).cast("double").alias("relative_humidity"),
                      F.when(F.col("l_linenumber") == 1, F.lit(1e30)).otherwise(F.col("l_linenumber") + 0.25).alias("visibility"))
    return schemas.bind_by_name(batch, schemas.OBSERVATIONS, keep=("k",)).select(
        "k", "wind_direction", "cloud_cover", "relative_humidity", "visibility")


@register("lists_to_text", """
SELECT l_orderkey * 10 + l_linenumber AS k,
       CASE l_linenumber % 3 WHEN 0 THEN '[' || CAST(l_partkey AS VARCHAR) || ',' || CAST(l_suppkey AS VARCHAR) || ']' WHEN 1 THEN '[]' END
         AS fallback_source_ids
FROM lineitem""")
def q_lists_to_text(spark, sf_dir):
    """Lists (some empty, some null) bound to a text column of the raw table."""
    li, n = fx.table(spark, sf_dir, "lineitem"), F.col("l_linenumber") % 3
    ids = F.when(n == 0, F.array("l_partkey", "l_suppkey")).when(n == 1, F.array().cast("array<bigint>"))
    batch = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), ids.alias("fallback_source_ids"))
    return schemas.bind_by_name(batch, schemas.OBSERVATIONS, keep=("k",)).select("k", "fallback_source_ids")


@register("append_by_name", with_ctes(f"""
SELECT station_id, "timestamp", temperature, wind_speed, relative_humidity, ingested_at FROM raw_obs WHERE event_id % 2 = 0
UNION ALL
SELECT station_id, "timestamp", temperature, NULL, NULL, TIMESTAMP '{OBS_NOW}' FROM raw_obs WHERE event_id % 2 = 1"""))
def q_append_by_name(spark, sf_dir):
    """A batch with other column order, missing and extra columns is appended by name."""
    obs = _in(spark, sf_dir).raw_obs
    path = scratch_path(spark, "appended")
    I.append(schemas.bind_by_name(obs.filter("event_id % 2 = 0"), schemas.OBSERVATIONS), path)
    batch = obs.filter("event_id % 2 = 1").select(F.lit("x").alias("extra"), "temperature", "timestamp", "station_id")
    I.append(schemas.bind_by_name(batch, schemas.OBSERVATIONS, OBS_NOW, "ingested_at"), path)
    return spark.read.schema(schemas.OBSERVATIONS).parquet(path).select(
        "station_id", "timestamp", "temperature", "wind_speed", "relative_humidity", "ingested_at")


# -------------------------------------------------------------- load jobs, L10

@register("load_stations", with_ctes(f"""
SELECT id, wmo_station_id, distance, TIMESTAMP '{OBS_NOW}' AS created_at FROM (
  SELECT id, wmo_station_id, round({hav('52.52' + D, '13.4' + D, 'lat', 'lon')}, 3) AS distance
  FROM (SELECT id, wmo_station_id, lat, lon FROM raw_stations UNION ALL SELECT 'G' || id, wmo_station_id, lat, lon FROM global_src))
WHERE distance <= 50000.0""", {"global_src": _GLOBAL_SQL}))
def q_load_stations(spark, sf_dir):
    """Landed station documents, far ones among them, loaded into the raw table by the job."""
    landing, raw_dir = scratch_path(spark, "stations"), scratch_path(spark, "raw")
    far = schemas.bind_by_name(_global_sources(spark, sf_dir).withColumn("id", F.concat(F.lit("G"), "id")), schemas.STATIONS)
    landed.land_stations_json(_in(spark, sf_dir).raw_stations.unionByName(far), landing)
    J.load_stations(spark, landing, raw_dir, OBS_NOW)
    return schemas.read_raw(spark, raw_dir, "weather_stations").select("id", "wmo_station_id", "distance", "created_at")


@register("load_areas", with_ctes(f"SELECT postal_code AS plz, postal_code AS name, TIMESTAMP '{OBS_NOW}' AS created_at FROM stg_areas"))
def q_load_areas(spark, sf_dir):
    """Landed features loaded into the raw area table by the job."""
    landing, raw_dir = scratch_path(spark, "areas"), scratch_path(spark, "raw")
    landed.land_areas_geojson(_in(spark, sf_dir).raw_postal, landing)
    J.load_areas(spark, landing, raw_dir, OBS_NOW)
    return schemas.read_raw(spark, raw_dir, "postal_codes").select("plz", "name", "created_at")


@register("load_area_collection", with_ctes(f"""
SELECT postal_code AS plz, round(cx, 9) AS cx, round(cy, 9) AS cy, TIMESTAMP '{OBS_NOW}' AS created_at FROM stg_areas"""))
def q_load_area_collection(spark, sf_dir):
    """Areas landed as one collection document and as single lines, side by side, loaded by the job."""
    landing, raw_dir = scratch_path(spark, "areas"), scratch_path(spark, "raw")
    raw, some = _in(spark, sf_dir).raw_postal, F.col("plz") < "12"
    landed.land_areas_collection(raw.filter(some), f"{landing}/collection")
    landed.land_areas_geojson(raw.filter(~some), f"{landing}/lines")
    J.load_areas(spark, f"{landing}/*", raw_dir, OBS_NOW)
    c = centroid("geometry")
    return schemas.read_raw(spark, raw_dir, "postal_codes").select("plz", F.round(c["x"], 9).alias("cx"), F.round(c["y"], 9).alias("cy"), "created_at")


# ---------------------------------------------------------------- streams, I2

_OBS_OUT = ["station_id", "wmo_station_id", "timestamp", "temperature", "ingested_at"]
_OBS_CTES = {
    "active_sources": ACTIVE_SOURCES,
    "stream_all": """SELECT o.station_id, a.wmo_station_id, o."timestamp", o.temperature, o.ingested_at
                     FROM raw_obs o JOIN active_sources a ON o.station_id = a.id""",
    "stream_run1": f"""SELECT * FROM stream_all WHERE ingested_at < TIMESTAMP '{OBS_LOADED_BEFORE}'
                       AND "timestamp" >= TIMESTAMP '{OBS_NOW}' - INTERVAL 30 DAY
                       AND "timestamp" <= TIMESTAMP '{OBS_NOW}'""",
    "stream_run2": f"""SELECT o.* FROM stream_all o
                       LEFT JOIN (SELECT station_id, max("timestamp") AS last_ts FROM stream_run1 GROUP BY station_id) m
                         ON o.station_id = m.station_id
                       WHERE o."timestamp" > coalesce(m.last_ts, TIMESTAMP '{OBS_NOW}' - INTERVAL 30 DAY - INTERVAL 1 SECOND)
                         AND o."timestamp" <= TIMESTAMP '{OBS_NOW}'"""}
_OBS_SQL = with_ctes(f"""
SELECT station_id, wmo_station_id, "timestamp", temperature, TIMESTAMP '{OBS_NOW}' AS ingested_at FROM stream_run1
UNION ALL
SELECT station_id, wmo_station_id, "timestamp", temperature, TIMESTAMP '{OBS_NOW}' FROM stream_run2""", _OBS_CTES)


def _observation_runs(spark, sf_dir, fresh_checkpoint: bool, **limits) -> DataFrame:
    i = _in(spark, sf_dir)
    landing, table, ckpt, other = (scratch_path(spark, n) for n in ("landing", "obs-table", "ckpt", "ckpt"))
    stations = I.active_stations(i.raw_stations, P.ACTIVE_SINCE)
    rows = i.raw_obs.select("station_id", "timestamp", "temperature", "ingested_at")
    split = F.col("ingested_at") < _at(OBS_LOADED_BEFORE)
    landed.land_weather_json(rows.filter(split).drop("ingested_at"), landing)
    S.run_available_now(spark, landing, table, ckpt, stations, OBS_NOW, **limits)
    landed.land_weather_json(rows.drop("ingested_at"), landing, mode="append")
    S.run_available_now(spark, landing, table, other if fresh_checkpoint else ckpt, stations, OBS_NOW)
    return spark.read.parquet(table).select(*_OBS_OUT)


@register("stream_incremental", _OBS_SQL)
def q_stream_incremental(spark, sf_dir):
    """Two landing drops processed by a file stream (AvailableNow)
    whose micro-batches append what is new, with its load time."""
    return _observation_runs(spark, sf_dir, False)


@register("stream_fresh_checkpoint", _OBS_SQL)
def q_stream_fresh_checkpoint(spark, sf_dir):
    """A new stream checkpoint on an existing table: all files are read
    again, nothing loaded is lost or loaded twice."""
    return _observation_runs(spark, sf_dir, True)


_FC_FIELDS = ("source_id", "temperature", "precipitation", "relative_humidity", "wind_speed")
_FC_OUT = ["id", "station_id", "wmo_station_id", "forecast_timestamp", *_FC_FIELDS, "ingested_at"]
_FC_ORDER = "source_id, precipitation, relative_humidity, temperature, wind_speed"
_FC_CTES = {
    "fcs_rows": f"""SELECT f.station_id, s.wmo AS wmo_station_id, f.forecast_timestamp, {", ".join("f." + c for c in _FC_FIELDS)}, f.ingested_at AS issued
                    FROM raw_fc f JOIN (SELECT id, wmo_station_id AS wmo FROM raw_stations WHERE observation_type = 'forecast') s
                      ON f.station_id = s.id
                    WHERE f.forecast_timestamp > TIMESTAMP '{FC_NOW}'
                      AND f.forecast_timestamp <= TIMESTAMP '{FC_NOW}' + INTERVAL 10 DAY""",
    **{name: f"""SELECT * EXCLUDE rn FROM (
                   SELECT *, row_number() OVER (PARTITION BY station_id, forecast_timestamp
                     ORDER BY issued DESC, {", ".join(c + " DESC NULLS LAST" for c in _FC_ORDER.split(", "))}) AS rn
                   FROM fcs_rows WHERE {where}) WHERE rn = 1"""
       for name, where in (("fcs_old", f"issued < TIMESTAMP '{FC_ISSUED_SPLIT}'"), ("fcs_new", f"issued >= TIMESTAMP '{FC_ISSUED_SPLIT}'"),
                           ("fcs_all", "true"))},
}
_NUMBER = "row_number() OVER (ORDER BY issued, station_id, forecast_timestamp)"
_FC_COLUMNS = ", ".join(_FC_OUT[1:-1])
_ONE_RUN_SQL = with_ctes(f"SELECT {_NUMBER} AS id, {_FC_COLUMNS}, TIMESTAMP '{FC_NOW}' AS ingested_at FROM fcs_all", _FC_CTES)


def _land_forecasts(spark, sf_dir, landing: str, condition=None, mode: str = "overwrite") -> None:
    rows = _in(spark, sf_dir).raw_fc.select("station_id", "forecast_timestamp", *_FC_FIELDS, F.col("ingested_at").alias("issued"))
    landed.land_weather_json(rows if condition is None else rows.filter(condition), landing, ts="forecast_timestamp", mode=mode)


def _forecast_stations(spark, sf_dir) -> DataFrame:
    return _in(spark, sf_dir).raw_stations.filter(F.col("observation_type") == "forecast")


def _forecasts(spark, table: str) -> DataFrame:
    return S.read_table_or_empty(spark, table, S.DATED).select(*_FC_OUT)


@register("stream_replace_future", with_ctes(f"""
SELECT {", ".join(_FC_OUT)} FROM (SELECT {_NUMBER} AS id, *, TIMESTAMP '{FC_NOW}' AS ingested_at FROM fcs_old)
WHERE station_id NOT IN (SELECT station_id FROM fcs_new)
UNION ALL
SELECT (SELECT count(*) FROM fcs_old) + {_NUMBER} AS id, {_FC_COLUMNS}, TIMESTAMP '{FC_NOW}' FROM fcs_new""", _FC_CTES))
def q_stream_replace_future(spark, sf_dir):
    """Two forecast runs landed as files (older issues, then
    newer ones) into a table partitioned by forecast date."""
    landing, table, ckpt = (scratch_path(spark, n) for n in ("fc-landing", "fc-table", "fc-ckpt"))
    stations, old = _forecast_stations(spark, sf_dir), F.col("issued") < _at(FC_ISSUED_SPLIT)
    _land_forecasts(spark, sf_dir, landing, old)
    S.run_forecasts_available_now(spark, landing, table, ckpt, stations, FC_NOW)
    _land_forecasts(spark, sf_dir, landing, ~old, "append")
    S.run_forecasts_available_now(spark, landing, table, ckpt, stations, FC_NOW)
    return _forecasts(spark, table)


@register("stream_two_issues", _ONE_RUN_SQL)
def q_stream_two_issues(spark, sf_dir):
    """A10: all issues of a station's hour in one micro-batch: the newest stays."""
    landing, table, ckpt = (scratch_path(spark, n) for n in ("fc-landing", "fc-table", "fc-ckpt"))
    _land_forecasts(spark, sf_dir, landing)
    S.run_forecasts_available_now(spark, landing, table, ckpt, _forecast_stations(spark, sf_dir), FC_NOW)
    return _forecasts(spark, table)


@register("stream_replay", _ONE_RUN_SQL)
def q_stream_replay(spark, sf_dir):
    """A micro-batch that wrote its rows but was not committed is
    replayed a day later; it uses its first time and writes the same rows and ids."""
    landing, table, ckpt = (scratch_path(spark, n) for n in ("fc-landing", "fc-table", "fc-ckpt"))
    _land_forecasts(spark, sf_dir, landing)
    stations = _forecast_stations(spark, sf_dir)
    S.run_forecasts_available_now(spark, landing, table, ckpt, stations, FC_NOW)
    for name in ("0", ".0.crc"):
        delete_path(spark, f"{ckpt}/commits/{name}")
    S.run_forecasts_available_now(spark, landing, table, ckpt, stations, LATER)
    return _forecasts(spark, table)


# ------------------------------------------------------------ whole job, L11

def _run_pipeline(spark, sf_dir) -> J.PipelineResult:
    i = _in(spark, sf_dir)
    return J.run_pipeline(spark, i.raw_stations, i.raw_postal, i.raw_obs, i.raw_fc,
                          scratch_path(spark, "marts"), allow=NULL_WMO_ALLOWED)


_MART_VALUES = ("temperature", "precipitation", "relative_humidity", "wind_speed")


@register("pipeline_run", with_ctes(f"""
SELECT 'hourly_observations' AS mart, postal_code, observation_hour AS hour, {", ".join(_MART_VALUES)} FROM obs_mart
UNION ALL
SELECT 'hourly_forecasts', postal_code, forecast_hour, {", ".join(_MART_VALUES)} FROM fc_mart"""))
def q_pipeline_run(spark, sf_dir):
    """The gated end-to-end job; both marts read by their table
    names. The two staging not-null rules that the fixture data breaks on
    purpose (null WMO ids) are allowed."""
    result = _run_pipeline(spark, sf_dir)
    parts = [spark.table(result.names[name]) for name in J.MARTS]
    obs, fc = (df.select(F.lit(name).alias("mart"), "postal_code", F.col(spec.hour).alias("hour"),
                         *(F.col(v).cast("double").alias(v) for v in _MART_VALUES))
               for df, (name, spec) in zip(parts, J.MARTS.items()))
    return obs.unionByName(fc)


_BOTH_MARTS = f"""
SELECT 'hourly_observations' AS mart, postal_code, observation_hour AS hour, {", ".join(_MART_VALUES)} FROM obs_mart
UNION ALL
SELECT 'hourly_forecasts', postal_code, forecast_hour, {", ".join(_MART_VALUES)} FROM fc_mart"""


def _both_marts(spark, base) -> DataFrame:
    obs, fc = (M.read_mart(spark, base, name).select(F.lit(name).alias("mart"), "postal_code", F.col(spec.hour).alias("hour"),
                                                     *(F.col(v).cast("double").alias(v) for v in _MART_VALUES))
               for name, (spec, _) in M.MARTS.items())
    return obs.unionByName(fc)


@register("moving_marts", with_ctes(_BOTH_MARTS))
def q_moving_marts(spark, sf_dir):
    """Both marts after three runs that each rebuild only the days they touch: a first load,
    later observations with more forecasts of the near days, and the far days' forecasts replaced."""
    i, base = _in(spark, sf_dir), scratch_path(spark, "moving")
    obs, fc = i.raw_obs, i.raw_fc
    early, far = F.col("ingested_at") < _at(OBS_LOADED_BEFORE), F.col("forecast_timestamp") >= _at(FC_FAR)
    issued = F.col("ingested_at") < _at(FC_ISSUED_SPLIT)
    for changes in ({"hourly_observations": M.Change(obs.filter(early)), "hourly_forecasts": M.Change(fc.filter(issued))},
                    {"hourly_observations": M.Change(obs.filter(~early)), "hourly_forecasts": M.Change(fc.filter(~issued & ~far))},
                    {"hourly_forecasts": M.Change(fc.filter(far), FC_FAR[:10])}):
        M.advance(spark, base, i.stg_stations, i.stg_areas, changes)
    return _both_marts(spark, base)


@register("mart_file_order", with_ctes("""
SELECT 'hourly_observations' AS mart, count(*) AS n_rows, CAST(0 AS BIGINT) AS out_of_order FROM obs_mart
UNION ALL
SELECT 'hourly_forecasts', count(*), 0 FROM fc_mart"""))
def q_mart_file_order(spark, sf_dir):
    """each mart's files, in the order of their names, hold consecutive key ranges."""
    result = _run_pipeline(spark, sf_dir)
    out = []
    for name, spec in J.MARTS.items():
        key = F.struct("postal_code", spec.hour)
        files = (spark.read.parquet(result.tables[name]).select(F.col("_metadata.file_name").alias("file"), key.alias("key"))
                 .groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("n")))
        before = F.lag("high").over(Window.orderBy("file"))  # one row per file
        out.append(files.withColumn("_before", before).agg(
            F.lit(name).alias("mart"), F.sum("n").alias("n_rows"), F.count(F.when(F.col("low") <= F.col("_before"), 1)).alias("out_of_order")))
    return out[0].unionByName(out[1])


@register("run_job", with_ctes(f"""
SELECT "table", station_id, n_rows FROM (
  SELECT 'weather_observations' AS "table", station_id, count(*) AS n_rows FROM job_obs GROUP BY ROLLUP (station_id)
  UNION ALL
  SELECT 'weather_forecasts', station_id, count(*) FROM fcs_all GROUP BY ROLLUP (station_id)
  UNION ALL
  SELECT 'rejects/' || s, NULL, count(*) FROM nation, unnest(['stations', 'areas', 'observations', 'forecasts']) AS t(s) GROUP BY s
  UNION ALL
  SELECT 'rejected ' || s, '{{"x":' || CAST(n_nationkey AS VARCHAR), 1
  FROM nation, unnest(['stations', 'areas', 'observations', 'forecasts']) AS t(s))""", {
    **_FC_CTES, "active_sources": ACTIVE_SOURCES,
    "job_obs": f"""SELECT o.station_id FROM raw_obs o JOIN active_sources a ON o.station_id = a.id
                   WHERE o."timestamp" >= TIMESTAMP '{FC_NOW}' - INTERVAL 30 DAY AND o."timestamp" <= TIMESTAMP '{FC_NOW}'"""}))
def q_run_job(spark, sf_dir):
    """Landed files of all four kinds, bad lines among them, to marts in one run; its ingest summary and the rejects read back."""
    i = _in(spark, sf_dir)
    landing, raw_dir, out, ckpt = (scratch_path(spark, n) for n in ("job-landing", "job-raw", "job-marts", "job-ckpt"))
    landed.land_stations_json(i.raw_stations, f"{landing}/stations")
    landed.land_areas_geojson(i.raw_postal, f"{landing}/areas")
    sources = ("stations", "areas", "observations", "forecasts")
    bad = fx.table(spark, sf_dir, "nation").select(F.concat(F.lit('{"x":'), F.col("n_nationkey").cast("string")).alias("value"))
    landed.land_weather_json(i.raw_obs.select("station_id", "timestamp", "temperature", "precipitation", "relative_humidity", "wind_speed"),
                             f"{landing}/observations")
    _land_forecasts(spark, sf_dir, f"{landing}/forecasts")
    for source in sources:
        _lines(bad, f"{landing}/{source}", "append")
    _, summary = J.run_job(spark, landing, raw_dir, out, ckpt, FC_NOW, allow=NULL_WMO_ALLOWED)
    for source in sources:
        kept = spark.read.parquet(f"{raw_dir}/rejects/{source}")
        summary = summary.unionByName(kept.select(F.lit(f"rejected {source}").alias("table"), F.col("value").alias("station_id"),
                                                  F.lit(1).cast("long").alias("n_rows")))
    return summary
