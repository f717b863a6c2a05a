"""Loading operators.

The reference loops over stations in Python, asks an API per station and
inserts row batches one by one. Here every step is one set-based job over
all stations: marks are one grouped aggregate, the per-station window is a
join, replace-future is an anti join. Functions are pure
``(existing, batch, now) -> DataFrame``; the write helpers at the bottom
materialise results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import publish
from ..functions.timeutil import days_before, ts_literal
from .nearest import nearest_place
from .sequence import numbered_in_place, range_part

# Fixed values of the reference's loading settings.
BACKFILL_DAYS = 30            # history fetched for a station without a mark
FORECAST_HORIZON_DAYS = 10    # forecast window ahead of 'now'
DISCOVERY_RADIUS_M = 50000.0  # station search radius around the centre
DISCOVERY_CENTRE = (52.52, 13.40)   # (lat, lon)


def _now(now) -> Column:
    return now if isinstance(now, Column) else ts_literal(now)


# ------------------------------------------------------------- marks, I1 --

def high_water_marks(existing: DataFrame, key: str = "station_id", ts: str = "timestamp") -> DataFrame:
    """Newest loaded time per source (one grouped aggregate for all)."""
    return existing.groupBy(key).agg(F.max(ts).alias("last_ts"))


def attach_station(batch: DataFrame, stations: DataFrame, key: str = "station_id") -> DataFrame:
    """Stamp the station's ids on each row; rows of unknown stations drop."""
    s = stations.select(F.col("id").alias(key), F.col("wmo_station_id").alias("_st_wmo"))
    return (batch.join(s, key, "inner")
                 .withColumn("wmo_station_id", F.col("_st_wmo")).drop("_st_wmo"))


def active_stations(raw_stations: DataFrame, active_since: str) -> DataFrame:
    """Stations observations are fetched for."""
    return raw_stations.filter(F.col("wmo_station_id").isNotNull()
                               & (F.col("last_record") >= ts_literal(active_since)))


def incremental_rows(batch: DataFrame, existing: DataFrame | None, now, key: str = "station_id",
                     ts: str = "timestamp", backfill_days: int = BACKFILL_DAYS,
                     marks: DataFrame | None = None) -> DataFrame:
    """I1 (C9, B9): rows of ``batch`` that are new for their station.

    With a mark: ``mark < ts <= now``. Without: ``now - backfill <= ts <= now``
    (the request window's start is inclusive). A row equal to the mark is
    already loaded and dropped. ``marks`` (key, last_ts) can be given
    directly (a maintained marks table, one row per station) instead of
    being aggregated from ``existing``.
    """
    n = _now(now)
    if marks is None:
        marks = high_water_marks(existing, key, ts)
    j = batch.join(marks.select(key, "last_ts"), key, "left")
    new = F.when(F.col("last_ts").isNotNull(), F.col(ts) > F.col("last_ts")) \
           .otherwise(F.col(ts) >= days_before(n, backfill_days))
    return j.filter(new & (F.col(ts) <= n)).drop("last_ts")


def advance_marks(marks: DataFrame, new_rows: DataFrame, key: str = "station_id",
                  ts: str = "timestamp") -> DataFrame:
    """D2 kept incrementally: previous marks combined with the newest time of
    the rows just loaded (one row per station, partial aggregation)."""
    return (marks.select(key, "last_ts")
                 .unionByName(new_rows.select(key, F.col(ts).alias("last_ts")))
                 .groupBy(key).agg(F.max("last_ts").alias("last_ts")))


# ----------------------------------------------------- forecasts, A10/A11 --

def assign_ids(batch: DataFrame, order: Sequence[str], start_after: Column | int = 0,
               id_col: str = "id") -> DataFrame:
    """Dense surrogate ids ``start_after + 1 ...`` in a total ``order``.

    The numbering is spread over range partitions (no single-task window), and
    no rows are written for it; ``start_after`` may be a scalar column such as
    ``max(id)`` of the table. ``batch`` is read twice, first its order columns
    only, so it must give the same rows again.
    """
    numbered = numbered_in_place(batch, order, "_seq")
    base = start_after if isinstance(start_after, Column) else F.lit(start_after)
    return numbered.withColumn(id_col, (base + F.col("_seq")).cast("bigint")).drop("_seq")


def forecast_window(batch: DataFrame, now, ts: str = "forecast_timestamp",
                    horizon_days: int = FORECAST_HORIZON_DAYS) -> DataFrame:
    """B10 + B11: only the future, and no further than the horizon."""
    n = _now(now)
    return batch.filter((F.col(ts) > n) & (F.col(ts) <= n + F.make_dt_interval(F.lit(horizon_days))))


def replace_future(existing: DataFrame, batch: DataFrame, now, key: str = "station_id",
                   ts: str = "forecast_timestamp", id_col: str = "id",
                   id_order: Sequence[str] | None = None, load_time_col: str = "ingested_at",
                   ids_after: Column | int | None = None) -> DataFrame:
    """A10 (C8, A11, A12): the forecast table after loading ``batch`` at ``now``.

    Rows of ``existing`` for stations present in the batch and later than
    ``now`` are replaced; earlier rows and other stations stay. Batch rows
    get fresh ids after the table's current maximum (or after ``ids_after``
    when ``existing`` is only part of the table) and one load time.
    """
    n = _now(now)
    fresh = batch.filter(F.col(ts) > n)
    stations = fresh.select(key).distinct()
    kept = existing.alias("e").join(
        stations.alias("s"), (F.col(f"e.{key}") == F.col(f"s.{key}")) & (F.col(f"e.{ts}") > n),
        "left_anti")
    if ids_after is None:
        ids_after = F.coalesce(existing.agg(F.max(id_col)).scalar(), F.lit(0))   # scalar subquery
    order = list(id_order or [key, ts])
    new_rows = (assign_ids(fresh, order, ids_after, id_col)
                .withColumn(load_time_col, n))
    return kept.unionByName(new_rows.select(*existing.columns))


# ------------------------------------------------------------ counts, D3 --

def ingest_counts(rows: DataFrame, key: str = "station_id") -> DataFrame:
    """D3: rows per station plus a total row (``key`` null) in one pass."""
    return rows.rollup(key).agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------- routing, B12/B13 --

def stations_in_radius(stations: DataFrame, centre=DISCOVERY_CENTRE,
                       radius_m: float = DISCOVERY_RADIUS_M) -> DataFrame:
    """Stations within ``radius_m`` of the centre, with their distance."""
    from ..functions.geo import centre_distance_m, within_radius

    lat0, lon0 = centre
    return (stations.filter(within_radius("lat", "lon", lat0, lon0, radius_m))
                    .withColumn("distance", centre_distance_m("lat", "lon", lat0, lon0)))


def route_keys(sources: DataFrame, candidates: DataFrame) -> DataFrame:
    """Request key per source: its WMO id, else the nearest WMO place, however far.

    ``candidates`` are sources that have a WMO id. See ``nearest`` for the
    search. A source without coordinates, or with no candidate anywhere, gets a
    null key (the reference raises for it).
    """
    direct = sources.filter(F.col("wmo_station_id").isNotNull()).select(
        F.col("id").alias("station_id"), F.col("wmo_station_id").alias("route_key"),
        F.lit(0.0).alias("route_dist"))
    lost = sources.filter(F.col("wmo_station_id").isNull()).select(
        F.col("id").alias("station_id"), F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"))
    places = candidates.select(F.col("wmo_station_id").alias("route_key"), "lat", "lon")
    return direct.unionByName(nearest_place(lost, places))


# ------------------------------------------------------------ sinks, A8/A9 --

def full_refresh(df: DataFrame, path: str) -> bool:
    """A8 + B14: replace the table with ``df`` in one step (see ``publish``); an empty batch changes nothing.

    ``df`` may be read from the table itself. Returns whether the table was replaced.
    """
    if df.isEmpty():
        return False
    publish.replace(df, path)
    return True


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Add rows (already bound to the table schema)."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def range_bounds(keys: DataFrame, key: str, parts: int) -> list:
    """At most ``parts`` lower bounds that cut the distinct ``key`` values evenly (one row per part is collected)."""
    ranged = keys.select(key).distinct().repartitionByRange(parts, key).withColumn("_p", F.spark_partition_id())
    return sorted(r["low"] for r in ranged.groupBy("_p").agg(F.min(key).alias("low")).collect())


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], bounds: Sequence, fmt: str = "parquet",
                 table: str | None = None) -> None:
    """F2 at the sink: rows go to the part of the first key's range, sorted inside,
    so the files read back in key order without a single-task global sort.

    ``bounds`` are the ranges' lower bounds (see ``range_bounds``): known from a
    dimension table, they need no sampling run of ``df``, which is written once.
    With ``table`` the files are also a catalog table of that name.
    """
    bounds = list(bounds) or [""]
    out = (df.repartitionById(len(bounds), range_part(keys[0], bounds).cast("int")).sortWithinPartitions(*keys)
             .write.mode("overwrite").format(fmt))
    if table:
        out.option("path", path).saveAsTable(table)
    else:
        out.save(path)
