"""Registered queries: one per operator / product, each with a SQL oracle.

``QUERIES[name] = (spark_fn, oracle_sql or None)``. ``spark_fn(spark,
sf_dir)`` builds the answer from the driver tables at ``sf_dir`` over the
whole tables; the oracle is DuckDB SQL over the same tables (views named
like the tables). Output columns carry the same names on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import centroid, from_wkt
from ..operators import checks as K
from ..operators import ingest as I
from ..operators import publish
from ..operators.dedup import canonical_first, latest_wins
from ..operators.sequence import previous_in_set
from ..operators.spatial_join import distance_join
from ..session import together
from ..sources import fixtures as fx
from . import products as P
from .oracle import D, hav, with_ctes

FC_ORDER = ("ingested_at", "id", "source_id", "tie")

# Scenario constants of the loading queries (fixed instants of a test run).
OBS_LOADED_BEFORE = "2024-01-16 00:00:00"     # observations already in the table
OBS_NOW = "2024-01-25 00:00:00"               # time of the incremental run
FC_ISSUED_SPLIT = "1996-01-01 00:00:00"       # older issues = table, newer = new run
FC_NOW = "2024-02-05 12:00:00"                # time of the forecast run


class Inputs:
    """Lazily built frames for one scale.

    Frames named in ``materialise`` (those a query reads more than once:
    staged facts, station map) are written once as Parquet
    into the shared ``spark.checkpoint.dir`` on first use: later reads start
    from the written table (with column pruning), lineage is cut and a lost
    executor does not force the upstream dedup and joins to run again.

    With ``near`` the facts are those of stations near an area only: what lies
    behind the station map is the same, and the newest-row step has less to sort.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialise=(), near: bool = False):
        self.spark, self.sf_dir = spark, sf_dir
        self.materialise = tuple(materialise)
        self.near = near

    def _m(self, df: DataFrame, name: str) -> DataFrame:
        return _materialised(df) if name in self.materialise else df

    @cached_property
    def raw_stations(self): return fx.raw_stations(self.spark, self.sf_dir)

    @cached_property
    def raw_postal(self): return fx.raw_postal(self.spark, self.sf_dir)

    @cached_property
    def raw_obs(self): return fx.raw_obs(self.spark, self.sf_dir)

    @cached_property
    def raw_fc(self): return fx.raw_fc(self.spark, self.sf_dir)

    @cached_property
    def areas(self): return P.load_areas(self.raw_postal)

    @cached_property
    def stg_stations(self): return P.stg_stations(self.raw_stations)

    @cached_property
    def stg_areas(self): return P.stg_postal_codes(self.areas)

    @cached_property
    def near_ids(self): return _materialised(P.near_station_ids(self.stg_stations, self.stg_areas))

    def _facts(self, raw: DataFrame) -> DataFrame:
        return P.of_stations(raw, self.near_ids) if self.near else raw

    @cached_property
    def stg_obs(self): return self._m(P.stg_facts(self._facts(self.raw_obs), P.OBSERVATIONS), "stg_obs")

    @cached_property
    def stg_fc(self): return self._m(P.stg_facts(self._facts(self.raw_fc), P.FORECASTS), "stg_fc")

    def _active(self, name: str) -> DataFrame:
        """Active ids of one fact table, written if the staged facts themselves are not."""
        ids = P.has_temperature(getattr(self, name)).distinct()
        return ids if name in self.materialise else _materialised(ids)

    @cached_property
    def station_map(self):
        if "station_map" not in self.materialise:
            return P.station_area_map(self.stg_stations, self.stg_areas, self.stg_obs, self.stg_fc)
        if self.near:
            self.near_ids  # before two threads ask for it
        # The two fact tables are staged at the same time.
        obs, fc = together(lambda: self._active("stg_obs"), lambda: self._active("stg_fc"))
        return _materialised(P.station_area_map(self.stg_stations, self.stg_areas, active_ids=obs.union(fc).distinct()))

    @cached_property
    def cleaned_obs_wr(self):
        return P.cleaned_with_rank(self.stg_obs, self.station_map, P.OBSERVATIONS)

    @cached_property
    def cleaned_fc_wr(self):
        return P.cleaned_with_rank(self.stg_fc, self.station_map, P.FORECASTS)

    def hours(self, spec: P.FactSpec) -> DataFrame:
        return P.hour_spine(self.stg_obs if spec is P.OBSERVATIONS else self.stg_fc, self.station_map, spec)

    def mart(self, spec: P.FactSpec) -> DataFrame:
        return P.hourly_by_area(self.stg_obs if spec is P.OBSERVATIONS else self.stg_fc, self.station_map, self.stg_areas, spec)


# Frames read more than once. The staged facts feed both the station map
# (active stations) and the cleaning join; the two branches carry different
# pushed-down filters, so Spark cannot reuse one scan for both: without the
# written table the raw fact table would be scanned and deduplicated twice.
OBS_MART_INPUTS = ("stg_obs", "station_map")      # stg_fc is read once (active stations)
FC_MART_INPUTS = ("stg_fc", "station_map")        # stg_obs is read once
MART_INPUTS = ("stg_obs", "stg_fc", "station_map")


def _in(spark, sf_dir, materialise=(), near: bool = False) -> Inputs:
    return Inputs(spark, sf_dir, materialise, near)


def _xy(df: DataFrame, col: str = "geometry", x: str = "geom_x", y: str = "geom_y") -> DataFrame:
    return df.withColumn(x, F.col(col)["x"]).withColumn(y, F.col(col)["y"]).drop(col)


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


# ----------------------------------------------------------- staging, L1-L4

@register("stg_stations", with_ctes(
    "SELECT station_id, station_name, wmo_station_id, dwd_station_id, geom_x, geom_y FROM stg_stations"))
def q_stg_stations(spark, sf_dir):
    return _xy(_in(spark, sf_dir).stg_stations)


@register("stg_observations", with_ctes("SELECT * FROM stg_observations"))
def q_stg_observations(spark, sf_dir):
    return _in(spark, sf_dir).stg_obs


@register("stg_forecasts", with_ctes("SELECT * FROM stg_forecasts"))
def q_stg_forecasts(spark, sf_dir):
    return _in(spark, sf_dir).stg_fc


@register("stg_postal_codes", with_ctes(f"""
SELECT postal_code, 7 AS n_vertices,
       round(x0, 9) AS min_x, round(x0 + 0.005{D} * 4, 9) AS max_x,
       round(y0, 9) AS min_y, round(y0 + 0.005{D} * 3, 9) AS max_y
FROM stg_areas"""))
def q_stg_postal_codes(spark, sf_dir):
    pts = F.flatten(F.flatten("geometry"))
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return _in(spark, sf_dir).stg_areas.select(
        "postal_code", F.size(pts).alias("n_vertices"),
        F.round(F.array_min(xs), 9).alias("min_x"), F.round(F.array_max(xs), 9).alias("max_x"),
        F.round(F.array_min(ys), 9).alias("min_y"), F.round(F.array_max(ys), 9).alias("max_y"))


@register("prefix_filter", with_ctes("SELECT postal_code AS plz FROM stg_areas"))
def q_prefix_filter(spark, sf_dir):
    return _in(spark, sf_dir).areas.select("plz")


@register("latest_wins", with_ctes("""
SELECT station_id, forecast_timestamp, id, ingested_at, temperature
FROM (SELECT *, row_number() OVER (PARTITION BY station_id, forecast_timestamp
              ORDER BY ingested_at DESC NULLS LAST, id DESC NULLS LAST,
                       source_id DESC NULLS LAST, tie DESC NULLS LAST) AS rn FROM raw_fc)
WHERE rn = 1"""))
def q_latest_wins(spark, sf_dir):
    fc = _in(spark, sf_dir).raw_fc
    return latest_wins(fc, ["station_id", "forecast_timestamp"], FC_ORDER).select(
        "station_id", "forecast_timestamp", "id", "ingested_at", "temperature")


@register("canonical_point", with_ctes("""
SELECT id, wmo_station_id,
       first_value(lon) OVER w AS geom_x, first_value(lat) OVER w AS geom_y
FROM raw_stations WHERE wmo_station_id IS NOT NULL
WINDOW w AS (PARTITION BY wmo_station_id ORDER BY id)"""))
def q_canonical_point(spark, sf_dir):
    from ..functions.geo import point

    s = _in(spark, sf_dir).raw_stations.filter(F.col("wmo_station_id").isNotNull())
    return _xy(canonical_first(s, "wmo_station_id", "id", point("lon", "lat"), "geometry")
               .select("id", "wmo_station_id", "geometry"))


# ------------------------------------------------------- geometry, H5 / B12

@register("polygon_centroid", with_ctes("SELECT plz, round(cx, 9) AS cx, round(cy, 9) AS cy FROM raw_postal"))
def q_polygon_centroid(spark, sf_dir):
    c = centroid("geometry")
    return _in(spark, sf_dir).raw_postal.select(
        "plz", F.round(c["x"], 9).alias("cx"), F.round(c["y"], 9).alias("cy"))


@register("wkt_shapes", with_ctes("SELECT plz, round(cx, 9) AS cx, round(cy, 9) AS cy FROM raw_postal"))
def q_wkt_shapes(spark, sf_dir):
    """H7: areas as WKT text (POLYGON and MULTIPOLYGON) read back into shapes."""
    ring = F.concat(F.lit("("), F.concat_ws(", ", F.transform(
        F.col("geometry")[0][0], lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))), F.lit(")"))
    one = F.substring("plz", -1, 1).cast("int") % 2 == 1
    text = F.when(one, F.concat(F.lit("POLYGON ("), ring, F.lit(")"))).otherwise(F.concat(F.lit("MULTIPOLYGON (("), ring, F.lit("))")))
    c = centroid("geometry")
    return _in(spark, sf_dir).raw_postal.select("plz", from_wkt(text).alias("geometry")).select(
        "plz", F.round(c["x"], 9).alias("cx"), F.round(c["y"], 9).alias("cy"))


@register("radius_filter", with_ctes(f"""
SELECT id, distance FROM (
  SELECT id, round({hav('52.52' + D, '13.4' + D, 'lat', 'lon')}, 3) AS distance FROM raw_stations)
WHERE distance <= 50000.0"""))
def q_radius_filter(spark, sf_dir):
    return I.stations_in_radius(_in(spark, sf_dir).raw_stations).select("id", "distance")


# ------------------------------------------------------- station map, L5

@register("active_station_union", with_ctes("SELECT wmo_station_id FROM active_ids"))
def q_active_station_union(spark, sf_dir):
    i = _in(spark, sf_dir)
    return P.active_station_ids(i.stg_obs, i.stg_fc)


@register("station_semi_join", with_ctes("SELECT wmo_station_id, lat, lon FROM station_pts"))
def q_station_semi_join(spark, sf_dir):
    i = _in(spark, sf_dir)
    return P.station_points(i.stg_stations, P.active_station_ids(i.stg_obs, i.stg_fc))


CUSTOMER_AREAS = f"""
SELECT 'C' || CAST(c_custkey AS VARCHAR) AS postal_code,
       13.4{D} + ((c_custkey * 29) % 1501 - 750) / 2500.0{D} + ((c_custkey // 1500) % 40) * 2.0{D} AS cx,
       52.52{D} + ((c_custkey * 31) % 1499 - 749) / 3000.0{D} - (c_custkey // 60000) * 1.5{D} AS cy
FROM customer"""


SUPPLIER_STATIONS = f"""
SELECT printf('%06d', s_suppkey) AS id, CASE WHEN s_suppkey % 20 <> 19 THEN printf('W%05d', k) END AS wmo_station_id,
       52.52{D} + ((kk * 53) % 97 - 48) / 400.0{D} - (s_suppkey // 4000) * 1.5{D} AS lat,
       13.4{D} + ((kk * 37) % 101 - 50) / 250.0{D} + (s_suppkey % 2) / 100000.0{D}
         + ((s_suppkey // 100) % 40) * 2.0{D} AS lon,
       s_suppkey % 10 <> 7 AND k % 9 <> 4 AS is_active
FROM (SELECT s_suppkey, s_suppkey // 2 AS k,
             s_suppkey // 2 - CASE WHEN (s_suppkey // 2) % 11 = 3 THEN 1 ELSE 0 END AS kk FROM supplier)"""
BOX_STATIONS = """
SELECT id AS station_id, first_value(lon) OVER w AS geom_x, first_value(lat) OVER w AS geom_y
FROM supplier_stations WHERE wmo_station_id IS NOT NULL AND is_active
WINDOW w AS (PARTITION BY wmo_station_id ORDER BY id)"""


@register("distance_join_grid", with_ctes(f"""
SELECT station_id, postal_code, dist FROM (
  SELECT s.station_id, a.postal_code, round({hav('a.cy', 'a.cx', 's.geom_y', 's.geom_x')}, 3) AS dist
  FROM box_stations s CROSS JOIN customer_areas a)
WHERE dist <= 15000.0""", {"customer_areas": CUSTOMER_AREAS, "supplier_stations": SUPPLIER_STATIONS, "box_stations": BOX_STATIONS}))
def q_distance_join_grid(spark, sf_dir):
    """C1 at scale: staged station sources x customer areas, both in boxes of the same density at every scale."""
    stations = P.stg_stations(fx.bench_stations(spark, sf_dir))
    pts = stations.select("station_id", F.col("geometry")["y"].alias("lat"),
                                F.col("geometry")["x"].alias("lon"))
    areas = fx.bench_areas(spark, sf_dir).select(
        "postal_code", F.col("centroid")["y"].alias("area_lat"), F.col("centroid")["x"].alias("area_lon"))
    return distance_join(pts, areas, P.STATION_RADIUS_M).select("station_id", "postal_code", "dist")


@register("distance_join_areas", with_ctes(f"""
SELECT station_id, postal_code, dist FROM (
  SELECT s.station_id, a.postal_code, round({hav('a.cy', 'a.cx', 's.geom_y', 's.geom_x')}, 3) AS dist
  FROM stg_stations s CROSS JOIN stg_areas a)
WHERE dist <= 15000.0"""))
def q_distance_join_areas(spark, sf_dir):
    """C1 on polygon areas: staged station sources x area centroids."""
    i = _in(spark, sf_dir)
    pts = i.stg_stations.select("station_id", F.col("geometry")["y"].alias("lat"),
                                F.col("geometry")["x"].alias("lon"))
    return distance_join(pts, P.area_centroids(i.stg_areas), P.STATION_RADIUS_M) \
        .select("station_id", "postal_code", "dist")


@register("station_rank", with_ctes("SELECT * FROM ranked"))
def q_station_rank(spark, sf_dir):
    i = _in(spark, sf_dir)
    stations = P.station_points(i.stg_stations, P.active_station_ids(i.stg_obs, i.stg_fc))
    pairs = distance_join(stations, P.area_centroids(i.stg_areas), P.STATION_RADIUS_M,
                          measured=P.station_points(i.stg_stations))
    return P.rank_all_stations(_materialised(pairs.select("wmo_station_id", "postal_code", "dist")))


@register("station_area_map", with_ctes("SELECT * FROM station_map"))
def q_station_area_map(spark, sf_dir):
    return _in(spark, sf_dir, near=True).station_map


# ---------------------------------------------------------- cleaning, L6/L7

@register("cleaned_observations", with_ctes("""
SELECT wmo_station_id, postal_code, "timestamp", observation_hour,
       temperature, precipitation, relative_humidity, wind_speed FROM cleaned_obs"""))
def q_cleaned_observations(spark, sf_dir):
    return _in(spark, sf_dir, ("stg_obs",), near=True).cleaned_obs_wr.drop("station_rank")


@register("cleaned_forecasts", with_ctes("""
SELECT wmo_station_id, postal_code, forecast_timestamp, forecast_hour,
       temperature, precipitation, relative_humidity, wind_speed FROM cleaned_fc"""))
def q_cleaned_forecasts(spark, sf_dir):
    return _in(spark, sf_dir, ("stg_fc",), near=True).cleaned_fc_wr.drop("station_rank")


@register("range_or_null_filter", with_ctes("""
SELECT "timestamp", wmo_station_id, temperature, relative_humidity FROM stg_observations
WHERE (temperature BETWEEN -50.0 AND 60.0 OR temperature IS NULL)
  AND (relative_humidity BETWEEN 0 AND 100 OR relative_humidity IS NULL)"""))
def q_range_or_null_filter(spark, sf_dir):
    ok = P.in_range_or_null("temperature", *P.TEMPERATURE_RANGE) & \
        P.in_range_or_null("relative_humidity", *P.HUMIDITY_RANGE)
    return _in(spark, sf_dir).stg_obs.filter(ok).select(
        "timestamp", "wmo_station_id", "temperature", "relative_humidity")


# -------------------------------------------------------------- marts, L8/L9

def _materialised(df: DataFrame) -> DataFrame:
    """Cut lineage of a frame read several times: a Parquet table written once
    in the shared ``spark.checkpoint.dir`` (survives executor loss)."""
    from ..session import materialise

    return materialise(df, "stage")


@register("hour_spine", with_ctes("SELECT * FROM obs_hours"))
def q_hour_spine(spark, sf_dir):
    return _in(spark, sf_dir, OBS_MART_INPUTS, near=True).hours(P.OBSERVATIONS)


@register("area_hour_spine", with_ctes("SELECT postal_code, forecast_hour FROM fc_spine"))
def q_area_hour_spine(spark, sf_dir):
    i = _in(spark, sf_dir, materialise=FC_MART_INPUTS, near=True)
    return P.area_hour_spine(i.stg_areas, i.hours(P.FORECASTS))


@register("best_station_per_hour", with_ctes("SELECT * FROM obs_best"))
def q_best_station_per_hour(spark, sf_dir):
    return P.best_station_per_hour(_in(spark, sf_dir, ("stg_obs",), near=True).cleaned_obs_wr, P.OBSERVATIONS)


@register("lag_values", with_ctes("""
SELECT s.postal_code, s.forecast_hour, p.forecast_hour AS prev_forecast_hour, c.b.temperature AS prev_temperature
FROM fc_spine s LEFT JOIN fc_numbered p ON p.k = s.k - 1
LEFT JOIN fc_choice c ON c.postal_code = s.postal_code AND c.k = s.k - 1"""))
def q_lag_values(spark, sf_dir):
    """E6 alone: previous row's (unfilled) temperature on the forecast spine."""
    i = _in(spark, sf_dir, materialise=FC_MART_INPUTS, near=True)
    hours = _materialised(i.hours(P.FORECASTS))
    grid = P.area_hour_spine(i.stg_areas, hours)
    prev = previous_in_set(hours, "forecast_hour", "prev_forecast_hour")
    best = P.best_station_per_hour(i.cleaned_fc_wr, P.FORECASTS).select(
        "postal_code", F.col("forecast_hour").alias("prev_forecast_hour"),
        F.col("temperature").alias("prev_temperature"))
    return (grid.join(prev, "forecast_hour", "left")
                .join(best, ["postal_code", "prev_forecast_hour"], "left")
                .select("postal_code", "forecast_hour", "prev_forecast_hour", "prev_temperature"))


@register("hourly_observations", with_ctes("SELECT * FROM obs_mart"))
def q_hourly_observations(spark, sf_dir):
    return _in(spark, sf_dir, materialise=OBS_MART_INPUTS, near=True).mart(P.OBSERVATIONS)


@register("hourly_forecasts", with_ctes("SELECT * FROM fc_mart"))
def q_hourly_forecasts(spark, sf_dir):
    return _in(spark, sf_dir, materialise=FC_MART_INPUTS, near=True).mart(P.FORECASTS)


# --------------------------------------------------------- loading, I1/A8-A12

@register("high_water_marks", with_ctes(
    'SELECT station_id, max("timestamp") AS last_ts FROM raw_obs GROUP BY station_id'))
def q_high_water_marks(spark, sf_dir):
    return I.high_water_marks(_in(spark, sf_dir).raw_obs)


ACTIVE_SOURCES = """
SELECT id, wmo_station_id FROM raw_stations
WHERE wmo_station_id IS NOT NULL AND last_record >= TIMESTAMP '2025-09-01 00:00:00'"""


@register("incremental_append", with_ctes(f"""
SELECT o.event_id, o.station_id, a.wmo_station_id, o."timestamp", o.temperature
FROM raw_obs o
JOIN active_sources a ON o.station_id = a.id
LEFT JOIN obs_marks m ON o.station_id = m.station_id
WHERE CASE WHEN m.last_ts IS NOT NULL THEN o."timestamp" > m.last_ts
           ELSE o."timestamp" >= TIMESTAMP '{OBS_NOW}' - INTERVAL 30 DAY END
  AND o."timestamp" <= TIMESTAMP '{OBS_NOW}'""", {
    "active_sources": ACTIVE_SOURCES,
    "obs_marks": f"""SELECT station_id, max("timestamp") AS last_ts FROM raw_obs
                     WHERE ingested_at < TIMESTAMP '{OBS_LOADED_BEFORE}' GROUP BY station_id"""}))
def q_incremental_append(spark, sf_dir):
    """A re-delivery of every observation against a table loaded up to
    mid-month; only rows newer than each station's mark (or inside the
    30-day backfill for new stations) and not after 'now' are appended."""
    i = _in(spark, sf_dir)
    existing = i.raw_obs.filter(F.col("ingested_at") < F.lit(OBS_LOADED_BEFORE).cast("timestamp_ntz"))
    batch = I.attach_station(i.raw_obs, I.active_stations(i.raw_stations, P.ACTIVE_SINCE))
    return I.incremental_rows(batch, existing, OBS_NOW).select(
        "event_id", "station_id", "wmo_station_id", "timestamp", "temperature")


FC_ID_ORDER = ["station_id", "forecast_timestamp", "id", "source_id", "tie", "temperature",
               "precipitation", "relative_humidity", "wind_speed"]
_FC_ID_ORDER_SQL = ", ".join(f"{c} ASC NULLS FIRST" for c in FC_ID_ORDER)
_FC_OUT = "station_id, forecast_timestamp, source_id, temperature, precipitation, relative_humidity, wind_speed"


@register("replace_future", with_ctes(f"""
SELECT id, {_FC_OUT}, ingested_at FROM fc_kept
UNION ALL
SELECT (SELECT coalesce(max(id), 0) FROM fc_existing)
         + row_number() OVER (ORDER BY {_FC_ID_ORDER_SQL}) AS id,
       {_FC_OUT}, TIMESTAMP '{FC_NOW}' AS ingested_at
FROM fc_batch""", {
    "fc_existing": f"SELECT * FROM raw_fc WHERE ingested_at < TIMESTAMP '{FC_ISSUED_SPLIT}'",
    "fc_batch": f"""SELECT * FROM raw_fc WHERE ingested_at >= TIMESTAMP '{FC_ISSUED_SPLIT}'
                    AND forecast_timestamp > TIMESTAMP '{FC_NOW}'
                    AND forecast_timestamp <= TIMESTAMP '{FC_NOW}' + INTERVAL 10 DAY""",
    "fc_kept": f"""SELECT * FROM fc_existing
                   WHERE NOT (forecast_timestamp > TIMESTAMP '{FC_NOW}'
                              AND station_id IN (SELECT station_id FROM fc_batch))"""}))
def q_replace_future(spark, sf_dir):
    """A10: the forecast table (older issues) after loading the newer run."""
    fc = _in(spark, sf_dir).raw_fc
    split = F.lit(FC_ISSUED_SPLIT).cast("timestamp_ntz")
    existing = fc.filter(F.col("ingested_at") < split)
    batch = I.forecast_window(fc.filter(F.col("ingested_at") >= split), FC_NOW)    # B10 + B11
    out = I.replace_future(existing, batch, FC_NOW, id_order=FC_ID_ORDER)
    return out.select("id", *[c.strip() for c in _FC_OUT.split(",")], "ingested_at")


SURROGATE_ORDER = ["station_id", "forecast_timestamp", "source_id", "tie", "temperature", "id"]


@register("surrogate_ids", with_ctes(f"""
SELECT row_number() OVER (ORDER BY {", ".join(c + " ASC NULLS FIRST" for c in SURROGATE_ORDER)}) AS id,
       station_id, forecast_timestamp, source_id, tie, temperature
FROM raw_fc"""))
def q_surrogate_ids(spark, sf_dir):
    """Dense ids 1..N over all forecasts in a total order."""
    fc = _in(spark, sf_dir).raw_fc
    return I.assign_ids(fc, SURROGATE_ORDER).select(
        "id", "station_id", "forecast_timestamp", "source_id", "tie", "temperature")


@register("full_refresh", with_ctes("""
SELECT id, wmo_station_id, station_name, observation_type, lat, lon, last_record FROM raw_stations"""))
def q_full_refresh(spark, sf_dir):
    """A8 + B14: load forecast sources, fully refresh with all sources, then
    try a refresh with an empty batch (ignored); read the table back."""
    from ..session import scratch_path

    i = _in(spark, sf_dir)
    path = scratch_path(spark, "stations")
    I.full_refresh(i.raw_stations.filter(F.col("observation_type") == "forecast"), path)
    I.full_refresh(i.raw_stations, path)
    I.full_refresh(i.raw_stations.filter(F.lit(False)), path)      # an empty batch is refused
    return publish.read(spark, path, i.raw_stations.schema).select(
        "id", "wmo_station_id", "station_name", "observation_type", "lat", "lon", "last_record")


@register("ingest_counts", with_ctes(
    "SELECT station_id, count(*) AS n_rows FROM raw_obs GROUP BY ROLLUP (station_id)"))
def q_ingest_counts(spark, sf_dir):
    return I.ingest_counts(_in(spark, sf_dir).raw_obs)


def _routing_sql(src: str) -> str:
    """Nearest place of all by the least (distance, id) struct, without any limit."""
    return with_ctes(f"""
SELECT s.id AS station_id, coalesce(any_value(s.wmo_station_id), min(p.b).wmo) AS route_key,
       CASE WHEN any_value(s.wmo_station_id) IS NOT NULL THEN 0.0{D} ELSE min(p.b).dist END AS route_dist
FROM route_src s LEFT JOIN route_pairs p ON p.id = s.id
GROUP BY s.id""", {
        "route_src": src,
        "route_cand": "SELECT DISTINCT wmo_station_id, lat, lon FROM raw_stations WHERE wmo_station_id IS NOT NULL",
        "route_pairs": f"""
SELECT s.id, struct_pack(dist := round({hav('s.lat', 's.lon', 'c.lat', 'c.lon')}, 3), wmo := c.wmo_station_id) AS b
FROM route_src s, route_cand c WHERE s.wmo_station_id IS NULL"""})


@register("nearest_station_routing", _routing_sql("SELECT * FROM raw_stations WHERE observation_type = 'forecast'"))
def q_nearest_station_routing(spark, sf_dir):
    """Forecast request key per forecast source."""
    s = _in(spark, sf_dir).raw_stations
    return I.route_keys(s.filter(F.col("observation_type") == "forecast"), s)


# Sources spread over the globe, with poles and the antimeridian; two of three have no WMO id.
_GLOBAL_LAT = f"CASE WHEN s_suppkey % 7 = 0 THEN 89.95{D} WHEN s_suppkey % 7 = 1 THEN -89.5{D} ELSE ((s_suppkey * 47) % 179) - 89.0{D} END"
_GLOBAL_LON = f"CASE WHEN s_suppkey % 5 = 0 THEN -179.95{D} WHEN s_suppkey % 5 = 1 THEN 179.9{D} ELSE ((s_suppkey * 73) % 359) - 179.0{D} END"


def _global_sources(spark, sf_dir) -> DataFrame:
    k = F.col("s_suppkey")
    return fx.table(spark, sf_dir, "supplier").select(
        F.lpad(k.cast("string"), 6, "0").alias("id"),
        F.when(k % 3 == 0, F.concat(F.lit("G"), k.cast("string"))).alias("wmo_station_id"),
        F.when(k % 7 == 0, 89.95).when(k % 7 == 1, -89.5).otherwise((k * 47) % 179 - 89.0).alias("lat"),
        F.when(k % 5 == 0, -179.95).when(k % 5 == 1, 179.9).otherwise((k * 73) % 359 - 179.0).alias("lon"))


_GLOBAL_SQL = f"""
SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS id,
       CASE WHEN s_suppkey % 3 = 0 THEN 'G' || CAST(s_suppkey AS VARCHAR) END AS wmo_station_id,
       {_GLOBAL_LAT} AS lat, {_GLOBAL_LON} AS lon FROM supplier"""


@register("nearest_station_routing_global", _routing_sql(_GLOBAL_SQL))
def q_nearest_station_routing_global(spark, sf_dir):
    """B13 for sources anywhere on the globe, most of them far from every place."""
    return I.route_keys(_global_sources(spark, sf_dir), _in(spark, sf_dir).raw_stations)


CENTRES = ((0.0, 179.9, 3_000_000.0), (89.9, 13.4, 500_000.0), (-60.0, -179.0, 2_000_000.0), (10.0, 20.0, 1_500_000.0))


@register("radius_filter_global", with_ctes("\nUNION ALL\n".join(f"""
SELECT {n} AS centre, id, round({hav(f'{la}{D}', f'{lo}{D}', 'lat', 'lon')}, 3) AS distance FROM global_src
WHERE round({hav(f'{la}{D}', f'{lo}{D}', 'lat', 'lon')}, 3) <= {r}""" for n, (la, lo, r) in enumerate(CENTRES)), {"global_src": _GLOBAL_SQL}))
def q_radius_filter_global(spark, sf_dir):
    """B12 around centres at the antimeridian, near a pole, and elsewhere."""
    src = _global_sources(spark, sf_dir)
    parts = [I.stations_in_radius(src, (la, lo), r).select(F.lit(n).alias("centre"), "id", "distance")
             for n, (la, lo, r) in enumerate(CENTRES)]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- checks, K

@register("check_not_null", with_ctes("SELECT * FROM stg_observations WHERE wmo_station_id IS NULL"))
def q_check_not_null(spark, sf_dir):
    return K.violations(_in(spark, sf_dir).stg_obs, K.not_null("wmo_station_id"))


@register("check_unique", with_ctes(
    "SELECT id, count(*) AS n_rows FROM raw_fc WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1"))
def q_check_unique(spark, sf_dir):
    return K.violations(_in(spark, sf_dir).raw_fc, K.unique("id"))


@register("check_unique_combo", with_ctes("""
SELECT wmo_station_id, "timestamp", count(*) AS n_rows FROM raw_obs
GROUP BY wmo_station_id, "timestamp" HAVING count(*) > 1"""))
def q_check_unique_combo(spark, sf_dir):
    return K.violations(_in(spark, sf_dir).raw_obs, K.unique_combination("wmo_station_id", "timestamp"))


@register("check_range", with_ctes(
    "SELECT event_id, temperature FROM raw_obs WHERE NOT (temperature >= -60.0 AND temperature <= 60.0)"))
def q_check_range(spark, sf_dir):
    return K.violations(_in(spark, sf_dir).raw_obs, K.accepted_range("temperature", -60.0, 60.0)) \
        .select("event_id", "temperature")


def suite_frames(i: Inputs, obs_mart: DataFrame, fc_mart: DataFrame) -> dict[str, DataFrame]:
    return {
        "stg_observations": i.stg_obs, "stg_forecasts": i.stg_fc, "stg_stations": i.stg_stations,
        "stg_postal_codes": i.stg_areas, "station_area_map": i.station_map,
        "cleaned_observations": i.cleaned_obs_wr, "cleaned_forecasts": i.cleaned_fc_wr,
        "hourly_observations": obs_mart, "hourly_forecasts": fc_mart,
    }


_SQL_MODEL = {
    "stg_observations": "stg_observations", "stg_forecasts": "stg_forecasts",
    "stg_stations": "stg_stations", "stg_postal_codes": "stg_areas", "station_area_map": "station_map",
    "cleaned_observations": "cleaned_obs", "cleaned_forecasts": "cleaned_fc",
    "hourly_observations": "obs_mart", "hourly_forecasts": "fc_mart",
}


def _rule_sql(model: str, rule: K.Rule) -> str:
    table = _SQL_MODEL[model]
    cols = ["geom_x" if c == "geometry" else c for c in rule.columns]
    head = f"SELECT '{model}' AS model, '{rule.label}' AS rule, "
    if rule.kind == "not_null":
        return head + f"count(*) AS violations FROM {table} WHERE {cols[0]} IS NULL"
    if rule.kind == "accepted_range":
        conds = []
        if rule.min_value is not None:
            conds.append(f"{cols[0]} >= {rule.min_value}")
        if rule.max_value is not None:
            conds.append(f"{cols[0]} <= {rule.max_value}")
        return head + f"count(*) AS violations FROM {table} WHERE NOT ({' AND '.join(conds)})"
    where = f" WHERE {cols[0]} IS NOT NULL" if rule.kind == "unique" else ""
    g = ", ".join(cols)
    return head + f"count(*) AS violations FROM (SELECT {g} FROM {table}{where} GROUP BY {g} HAVING count(*) > 1)"


@register("check_report", with_ctes("\nUNION ALL\n".join(
    _rule_sql(m, r) for m, rules in K.REFERENCE_SUITE.items() for r in rules)))
def q_check_report(spark, sf_dir):
    """K6: violation counts of the reference's 31 declared tests."""
    i = _in(spark, sf_dir, materialise=MART_INPUTS)
    i.station_map  # noqa: B018  both marts start from it
    frames = suite_frames(i, *together(lambda: i.mart(P.OBSERVATIONS), lambda: i.mart(P.FORECASTS)))
    return K.report([(m, frames[m], rules) for m, rules in K.REFERENCE_SUITE.items()])


# The queries on landed files, streams and the whole job register themselves too.
from . import catalog_loading  # noqa: E402, F401
