"""The data products users query (L1-L9), as plain DataFrame functions.

Each function takes DataFrames and returns a lazy DataFrame; nothing is
collected. Observation and forecast branches share one implementation driven
by a ``FactSpec`` (they differ only in names and tie-break columns).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import centroid, point
from ..functions.timeutil import hour_of, ts_literal
from ..operators.dedup import canonical_first, first_per_group, latest_wins
from ..operators.fill import SPINE_BROADCAST_MAX_ROWS, fill_from_previous, spine
from ..operators.sequence import dense_rank_within, previous_in_set
from ..operators.spatial_join import distance_join

METRICS = ("temperature", "precipitation", "relative_humidity", "wind_speed")

# Fixed values of the reference pipeline (its settings and SQL literals).
ACTIVE_SINCE = "2025-09-01 00:00:00"          # station activity cutoff
AREA_PREFIXES = ("10", "12", "13")            # area codes kept on load
STATION_RADIUS_M = 15000.0                    # area -> station search radius
MAX_STATION_RANK = 10                         # ranks kept per area
TEMPERATURE_RANGE = (-50.0, 60.0)             # cleaning rule, inclusive
HUMIDITY_RANGE = (0.0, 100.0)                 # cleaning rule, inclusive


@dataclass(frozen=True)
class FactSpec:
    name: str
    ts: str                      # time column of the staged rows
    hour: str                    # hour column of the cleaned rows and the mart
    staged: tuple                # columns of the staging view
    newest_first: tuple          # "newest row wins": total over all staged columns


OBSERVATIONS = FactSpec(
    name="observations", ts="timestamp", hour="observation_hour",
    staged=("timestamp", "station_id", "wmo_station_id", "temperature", "precipitation",
            "relative_humidity", "wind_speed", "wind_direction", "ingested_at"),
    newest_first=("ingested_at", "station_id", "source_id", "temperature", "precipitation",
                  "relative_humidity", "wind_speed", "wind_direction"),
)

FORECASTS = FactSpec(
    name="forecasts", ts="forecast_timestamp", hour="forecast_hour",
    staged=("forecast_timestamp", "station_id", "wmo_station_id", "temperature", "precipitation",
            "relative_humidity", "wind_speed", "wind_direction", "condition", "ingested_at"),
    newest_first=("ingested_at", "id", "station_id", "source_id", "temperature", "precipitation",
                  "relative_humidity", "wind_speed", "wind_direction", "condition"),
)


# ---------------------------------------------------------------- staging --

def stg_stations(raw_stations: DataFrame, active_since: str = ACTIVE_SINCE) -> DataFrame:
    """L1: active stations with a WMO id; one canonical point per WMO id.

    The filter runs before the window (moving it after would change which
    row is first).
    """
    active = raw_stations.filter(F.col("wmo_station_id").isNotNull()
                                 & (F.col("last_record") >= ts_literal(active_since)))
    canon = canonical_first(active, "wmo_station_id", "id", point("lon", "lat"), "geometry")
    return canon.select(F.col("id").alias("station_id"), "station_name", "wmo_station_id",
                        "dwd_station_id", "geometry")


def stg_facts(raw: DataFrame, spec: FactSpec, newest_first: tuple | None = None) -> DataFrame:
    """L2/L3: newest row per (WMO id, time); null WMO ids group together."""
    order = newest_first or spec.newest_first
    newest = latest_wins(raw, ["wmo_station_id", spec.ts], order)
    return newest.select(*spec.staged)


def stg_postal_codes(areas: DataFrame) -> DataFrame:
    """L4: area code and shape."""
    return areas.select(F.col("plz").alias("postal_code"), "geometry")


def prefix_filter(col: str | Column, prefixes=AREA_PREFIXES) -> Column:
    """Code starts with one of the prefixes."""
    c = F.col(col) if isinstance(col, str) else col
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | c.startswith(p)
    return cond


def load_areas(raw_areas: DataFrame, prefixes=AREA_PREFIXES) -> DataFrame:
    """Areas as loaded: prefix filter (B8) and shape present."""
    return raw_areas.filter(prefix_filter("plz", prefixes) & F.col("geometry").isNotNull())


# ------------------------------------------------------------ station map --

def active_station_ids(stg_obs: DataFrame, stg_fc: DataFrame) -> DataFrame:
    """G1: WMO ids with any non-null temperature in either fact table."""
    return has_temperature(stg_obs).union(has_temperature(stg_fc)).distinct()


def has_temperature(stg: DataFrame) -> DataFrame:
    """WMO ids of one fact table with a non-null temperature (repeated)."""
    return stg.filter(F.col("temperature").isNotNull()).select("wmo_station_id")


def _axes(axis_order: str) -> tuple[str, str]:
    """Which coordinates of a point are (latitude, longitude)."""
    if axis_order not in ("xy", "yx"):
        raise ValueError("axis_order must be 'xy' or 'yx'")
    return ("y", "x") if axis_order == "xy" else ("x", "y")


def area_centroids(stg_areas: DataFrame, axis_order: str = "xy") -> DataFrame:
    """H5 hoisted: one centroid per area, computed once before the join."""
    c, (lat, lon) = centroid("geometry"), _axes(axis_order)
    return stg_areas.select("postal_code", c[lat].alias("area_lat"), c[lon].alias("area_lon"))


def station_points(stg_stations_df: DataFrame, active_ids: DataFrame | None = None, axis_order: str = "xy") -> DataFrame:
    """C2 + D1: one point per WMO id that has data."""
    lat, lon = _axes(axis_order)
    s = stg_stations_df.filter(F.col("wmo_station_id").isNotNull())
    if active_ids is not None:
        s = s.join(active_ids, "wmo_station_id", "left_semi")
    return s.select("wmo_station_id", F.col("geometry")[lat].alias("lat"),
                    F.col("geometry")[lon].alias("lon")).distinct()


def near_station_ids(stg_stations_df: DataFrame, stg_areas: DataFrame, radius_m: float = STATION_RADIUS_M,
                     axis_order: str = "xy") -> DataFrame:
    """WMO ids with a place within ``radius_m`` of an area, whether they have data or not.

    No other id can get into the station map. Stations and areas are small beside
    the facts, so this is known first and takes raw rows away before the
    newest-row step sorts them (see ``of_stations``).
    """
    stations = station_points(stg_stations_df, None, axis_order)
    pairs = distance_join(stations, area_centroids(stg_areas, axis_order), radius_m, measured=stations)
    return pairs.select("wmo_station_id").distinct()


def of_stations(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """The raw rows of these WMO ids. All rows of an id stay or go together, so the newest row per id and time is the same."""
    return raw.join(ids, "wmo_station_id", "left_semi").select(*raw.columns)


def rank_stations(pairs: DataFrame, max_rank: int = MAX_STATION_RANK) -> DataFrame:
    """E4 + F1: dense rank by distance per area, keep ranks <= max_rank (ties kept)."""
    from pyspark.sql import Window

    w = Window.partitionBy("postal_code").orderBy(F.col("dist").asc())
    return (pairs.withColumn("station_rank", F.dense_rank().over(w))
                 .filter(F.col("station_rank") <= max_rank))


def rank_all_stations(pairs: DataFrame) -> DataFrame:
    """E4 alone: every pair with its dense rank by distance per area.

    Without a limit no rows can be dropped before the shuffle, so areas are not
    windows here: a dense one is ranked by many tasks. ``pairs`` is read twice;
    ties (equal distances) are one pair in the ranking and joined back.
    """
    ranks = dense_rank_within(pairs, "postal_code", "dist", "station_rank")
    return pairs.join(ranks, ["postal_code", "dist"]).select("wmo_station_id", "postal_code", "dist", "station_rank")


def station_area_map(stg_stations_df: DataFrame, stg_areas: DataFrame, stg_obs: DataFrame | None = None,
                     stg_fc: DataFrame | None = None, radius_m: float = STATION_RADIUS_M,
                     max_rank: int = MAX_STATION_RANK, axis_order: str = "xy", active_ids: DataFrame | None = None) -> DataFrame:
    """Each area's nearest stations with data, within ``radius_m``.

    The station points (one row per WMO place that has data) are among the
    staged stations; that small table is measured, and its size is the proven
    bound that decides whether the points are broadcast. ``axis_order='yx'``
    takes the first coordinate of a point as latitude, as the reference's
    distance function does with its points. ``active_ids`` may be given in place
    of the facts.
    """
    if active_ids is None:
        active_ids = active_station_ids(stg_obs, stg_fc)
    stations = station_points(stg_stations_df, active_ids, axis_order)
    bound = station_points(stg_stations_df, None, axis_order)
    pairs = distance_join(stations, area_centroids(stg_areas, axis_order), radius_m, measured=bound)
    return rank_stations(pairs.select("wmo_station_id", "postal_code", "dist"), max_rank) \
        .select("wmo_station_id", "postal_code", "dist", "station_rank")


# --------------------------------------------------------------- cleaning --

def in_range_or_null(col: str, lo: float, hi: float) -> Column:
    """Value inside [lo, hi] or null (NaN fails)."""
    return F.col(col).between(lo, hi) | F.col(col).isNull()


def cleaned_with_rank(stg: DataFrame, station_map: DataFrame, spec: FactSpec,
                      temperature_range=TEMPERATURE_RANGE, humidity_range=HUMIDITY_RANGE) -> DataFrame:
    """Staged rows of mapped stations, range-cleaned, one row per area.

    The reference's ``select distinct`` is not needed: staged rows are unique
    per (WMO id, time) and the map per (area, WMO id), so the join output is
    already unique per (area, WMO id, time); the unique-combination check
    (K3) guards this.
    """
    ok = in_range_or_null("temperature", *temperature_range) & \
        in_range_or_null("relative_humidity", *humidity_range)
    m = station_map.select("wmo_station_id", "postal_code", "station_rank")
    return (stg.filter(ok).join(m, "wmo_station_id", "inner")
               .select("wmo_station_id", "postal_code", spec.ts,
                       hour_of(spec.ts).alias(spec.hour), *METRICS, "station_rank"))


def cleaned(stg: DataFrame, station_map: DataFrame, spec: FactSpec) -> DataFrame:
    """L6/L7."""
    return cleaned_with_rank(stg, station_map, spec).drop("station_rank")


# ------------------------------------------------------------------ marts --

def best_station_per_hour(cleaned_wr: DataFrame, spec: FactSpec) -> DataFrame:
    """E5: per area and hour, the nearest station that has a temperature.

    Ties in rank are broken by WMO id so the choice is deterministic.
    """
    cand = cleaned_wr.filter(F.col("temperature").isNotNull())
    best = first_per_group(cand, ["postal_code", spec.hour],
                           [F.col("station_rank").asc(), F.col("wmo_station_id").asc()])
    return best.select("postal_code", spec.hour, *METRICS)


def mapped_rows(stg: DataFrame, station_map: DataFrame, spec: FactSpec, temperature_range=TEMPERATURE_RANGE,
                humidity_range=HUMIDITY_RANGE) -> DataFrame:
    """Staged rows that appear among the cleaned rows, each once (no fan-out to areas)."""
    ok = in_range_or_null("temperature", *temperature_range) & \
        in_range_or_null("relative_humidity", *humidity_range)
    return stg.filter(ok).join(station_map.select("wmo_station_id"), "wmo_station_id", "left_semi")


def hour_spine(stg: DataFrame, station_map: DataFrame, spec: FactSpec) -> DataFrame:
    """Distinct hours seen in the cleaned rows (not a calendar)."""
    return mapped_rows(stg, station_map, spec).select(hour_of(spec.ts).alias(spec.hour)).distinct()


def area_hour_spine(stg_areas: DataFrame, hours: DataFrame) -> DataFrame:
    return spine(stg_areas.select("postal_code").distinct(), hours)


def hourly_by_area(stg: DataFrame, station_map: DataFrame, stg_areas: DataFrame, spec: FactSpec) -> DataFrame:
    """One row per area and hour with a one-step previous-hour fill.

    The cleaned rows (one per staged row and area) are never written: the best
    station per area and hour is a partial limit on the join's output. The hour
    set is taken from the staged rows and written, as it is counted and read
    twice; it has one row per hour of the period, and within the bound it is
    broadcast to build the spine and as the previous-hour map.
    """
    from ..session import materialise

    hours = materialise(hour_spine(stg, station_map, spec), "hours")
    n_hours = hours.count()
    small = n_hours <= SPINE_BROADCAST_MAX_ROWS
    grid = spine(stg_areas.select("postal_code").distinct(), hours, n_times=n_hours)
    # range partitions for numbering the hour set: sized from its known count
    parts = max(1, min(int(stg.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_hours // 50_000 + 1))
    prev = previous_in_set(hours, spec.hour, "_prev", num_partitions=parts)
    best = best_station_per_hour(cleaned_with_rank(stg, station_map, spec), spec)
    return fill_from_previous(grid, best, "postal_code", spec.hour, METRICS, prev, broadcast_prev=small)
