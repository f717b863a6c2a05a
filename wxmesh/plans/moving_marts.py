"""Hourly marts kept up to date by the day (L2, L3, L5, L8, L9 under I2).

``advance`` takes what a recurring run loaded and leaves the marts as a full
rebuild from all raw rows would, without reading history:

1. The staged rows (newest row per WMO id and time) are a table by day. New
   raw rows are folded into their days; a replaced stretch of forecasts is
   staged again from its day on.
2. Which stations are active is kept by day too (the WMO ids with a
   temperature), so the station map needs no fact rows at all.
3. The hours of the touched days are found again. A touched day's values reach
   one hour further, into the first hour of the next day that has any; so that
   day is rebuilt as well, and the last hour before each rebuilt day is read.
4. The rebuilt days of the mart change in one step; the others stay as files.

If the station map or the set of areas is not what the marts were built with,
every day is rebuilt, from the staged rows. Days that were touched are noted in
``pending`` before anything changes and taken from it at the end, so a run that
died is caught up by the next one, whatever that one loads.

``catch_up`` finds the changes itself: it remembers which folders of the raw
tables the marts were built from and takes those that are new.

Days are folder names (``none`` for rows without a time), as many as the
calendar has; they alone pass through the driver.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.timeutil import hour_of
from ..operators import checks as K
from ..operators import publish
from ..operators.dedup import latest_wins
from ..operators.fill import SPINE_BROADCAST_MAX_ROWS, fill_from_previous, spine
from ..operators.sequence import previous_in_set
from ..session import materialise, scratch
from . import products as P

DAY, NO_DAY = "day", "none"
_DAY = T.StructField(DAY, T.StringType())
_ID = T.StructField("wmo_station_id", T.StringType())

#: mart -> its facts and the raw schema their staged rows are kept with
MARTS = {"hourly_observations": (P.OBSERVATIONS, schemas.OBSERVATIONS),
         "hourly_forecasts": (P.FORECASTS, schemas.FORECASTS)}

STAGED = {name: T.StructType([*raw.fields, _DAY]) for name, (_, raw) in MARTS.items()}
ACTIVE = T.StructType([_ID, _DAY])
MAP = T.StructType([_ID, T.StructField("postal_code", T.StringType()), T.StructField("dist", T.DoubleType()),
                    T.StructField("station_rank", T.IntegerType())])
AREAS = T.StructType([T.StructField("postal_code", T.StringType())])


@dataclass(frozen=True)
class Change:
    """Raw rows that a run loaded.

    With ``since`` (a day, ``YYYY-MM-DD``) they are all the rows there are from
    that day on and take the place of what was staged from there; earlier rows
    are ignored. Without it they come on top of what is there.
    """
    rows: DataFrame
    since: str | None = None


@dataclass
class Advanced:
    """What one run did, by mart: the days it wrote and the days of staged rows it read for that."""
    rebuilt: dict[str, list[str]] = field(default_factory=dict)
    read: dict[str, list[str]] = field(default_factory=dict)
    everything: bool = False                                  # the map or the areas had changed


def day_of(ts: str | Column) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(NO_DAY))


def hours_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(MARTS[name][0].hour, T.TimestampNTZType()), _DAY])


def mart_schema(name: str) -> T.StructType:
    spec, raw = MARTS[name]
    return T.StructType([AREAS["postal_code"], T.StructField(spec.hour, T.TimestampNTZType()),
                         *(T.StructField(m, raw[m].dataType) for m in P.METRICS), _DAY])


def read_mart(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The mart as it is published now."""
    return publish.read(spark, f"{base.rstrip('/')}/{name}", mart_schema(name)).drop(DAY)


def _put(df: DataFrame, path: str, days: Iterable[str], order: tuple = ()) -> None:
    """Replace these days; rows of a day go together, and adaptive execution splits a large day."""
    df = df.hint("rebalance", DAY)
    publish.replace_values(df.sortWithinPartitions(DAY, *order) if order else df, path, DAY, set(days))


def _listed(spark: SparkSession, path: str) -> list[str]:
    return publish.current(spark, path) or []


def _restage(spark: SparkSession, base: str, name: str, change: Change, pending: str) -> None:
    """Fold a change into the staged rows of its days."""
    (spec, raw), path = MARTS[name], f"{base}/staged_{name}"
    rows = change.rows.select(*raw.fieldNames()).withColumn(DAY, day_of(spec.ts))
    if change.since is not None:
        rows = rows.filter(F.col(DAY) >= change.since)
    rows = materialise(rows, "change")
    days = {r[DAY] for r in rows.select(DAY).distinct().collect()}      # at most the calendar
    if change.since is None:
        rows = rows.unionByName(publish.read_values(spark, path, STAGED[name], DAY, days))
    else:
        days |= {d for d in publish.values_of(spark, path, DAY) if d >= change.since}
    if days:
        publish.switch(spark, pending, sorted(days | set(_listed(spark, pending))))
        _put(latest_wins(rows, ["wmo_station_id", spec.ts], spec.newest_first), path, days, ("wmo_station_id", spec.ts))


def _note_active(spark: SparkSession, base: str, name: str, days: list[str]) -> None:
    staged = publish.read_values(spark, f"{base}/staged_{name}", STAGED[name], DAY, days)
    ids = staged.filter(F.col("temperature").isNotNull()).select("wmo_station_id", DAY).distinct()
    _put(ids, f"{base}/active_{name}", days)


def _differ(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables without repeated rows differ (equal values, nulls alike)."""
    sided = a.withColumn("_a", F.lit(1)).unionByName(b.withColumn("_a", F.lit(0)))
    return not sided.groupBy(*a.columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n <> 2").isEmpty()


def _neighbours(days: Iterable[str], all_days: list[str]) -> tuple[list[str], list[str]]:
    """The days to rebuild (touched ones and the next day with hours after each) and the days before them that are read."""
    dated = [d for d in all_days if d != NO_DAY]
    rebuilt = set(days)
    for d in days:
        after = bisect_right(dated, d)
        if d != NO_DAY and after < len(dated):
            rebuilt.add(dated[after])
    before = {dated[i - 1] for i in (bisect_left(dated, d) for d in rebuilt if d != NO_DAY) if i > 0}
    return sorted(rebuilt), sorted(before - rebuilt)


def _rebuild(spark: SparkSession, base: str, name: str, station_map: DataFrame, areas: DataFrame, days: list[str],
             done: Advanced, check: Callable[[dict[str, DataFrame]], None]) -> None:
    spec, _ = MARTS[name]
    staged_path, hours_path = f"{base}/staged_{name}", f"{base}/hours_{name}"
    touched = publish.read_values(spark, staged_path, STAGED[name], DAY, days)
    check({f"stg_{spec.name}": touched.select(*spec.staged), f"cleaned_{spec.name}": P.cleaned(touched, station_map, spec)})
    hours = P.hour_spine(touched, station_map, spec)
    _put(hours.withColumn(DAY, day_of(spec.hour)), hours_path, days)

    rebuilt, before = _neighbours(days, publish.values_of(spark, hours_path, DAY))
    near = materialise(publish.read_values(spark, hours_path, hours_schema(name), DAY, [*rebuilt, *before]), "hours")
    n_near = near.count()
    small = n_near <= SPINE_BROADCAST_MAX_ROWS
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_near // 50_000 + 1))
    inside = F.col(DAY).isin(rebuilt)
    prev = previous_in_set(near.select(spec.hour), spec.hour, "_prev", num_partitions=parts)
    prev = materialise(prev.filter(day_of(spec.hour).isin(rebuilt)), "previous")
    # of the days before, only the hour that the next one is filled from
    wanted = prev.select(F.explode(F.array(spec.hour, "_prev")).alias("_h")).filter("_h is not null").distinct()
    staged = publish.read_values(spark, staged_path, STAGED[name], DAY, [*rebuilt, *before])
    staged = staged.join(F.broadcast(wanted) if small else wanted, hour_of(spec.ts) == F.col("_h"), "left_semi")

    grid = spine(areas, near.filter(inside).select(spec.hour), n_times=n_near)
    best = P.best_station_per_hour(P.cleaned_with_rank(staged, station_map, spec), spec)
    mart = materialise(fill_from_previous(grid, best, "postal_code", spec.hour, P.METRICS, prev, broadcast_prev=small), "mart")
    check({name: mart})
    _put(mart.withColumn(DAY, day_of(spec.hour)), f"{base}/{name}", rebuilt, ("postal_code", spec.hour))
    done.rebuilt[name], done.read[name] = rebuilt, sorted([*rebuilt, *before])


def advance(spark: SparkSession, base: str, stg_stations: DataFrame, stg_areas: DataFrame,
            changes: dict[str, Change], check: Callable[[dict[str, DataFrame]], None] = lambda frames: None) -> Advanced:
    """Bring the marts under ``base`` up to date with ``changes`` (by mart name); see the module's text.

    ``check`` is given the touched days of the staged and cleaned rows, the
    station map and the rebuilt days of a mart, by model name, before they are
    used or published; what it raises stops the run, and the next one takes the
    same days again. (The keys of the uniqueness rules hold the time, so days
    can be checked by themselves.) An empty change, or none, rebuilds nothing unless stations or areas have
    changed. Repeating a change gives the same tables. One run at a time.
    """
    base, done = base.rstrip("/"), Advanced()
    pending = {name: f"{base}/pending_{name}" for name in MARTS}
    with scratch(spark):
        for name, change in changes.items():
            _restage(spark, base, name, change, pending[name])
        touched = {name: _listed(spark, path) for name, path in pending.items()}
        for name, days in touched.items():
            if days:
                _note_active(spark, base, name, days)
        ids = [publish.read(spark, f"{base}/active_{name}", ACTIVE).select("wmo_station_id") for name in MARTS]
        areas = materialise(stg_areas.select("postal_code").distinct(), "areas")
        station_map = materialise(P.station_area_map(stg_stations, stg_areas, active_ids=ids[0].union(ids[1]).distinct()), "map")
        check({"station_area_map": station_map})
        done.everything = (_differ(areas, publish.read(spark, f"{base}/areas", AREAS))
                           or _differ(station_map, publish.read(spark, f"{base}/station_area_map", MAP)))
        for name in MARTS:
            known = [publish.values_of(spark, f"{base}/{table}", DAY) for table in (f"staged_{name}", name)] if done.everything else []
            days = sorted(set(touched[name]).union(*known))
            if days:
                _rebuild(spark, base, name, station_map, areas, days, done, check)
        if done.everything:
            publish.replace(station_map, f"{base}/station_area_map")
            publish.replace(areas, f"{base}/areas")
        for name, path in pending.items():
            if touched[name]:
                publish.switch(spark, path, [])
    return done


# ------------------------------------------------- what the raw tables changed

def _folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that hold a raw table's rows: one a micro-batch, or one a forecast date and its last write."""
    published = publish.current(spark, path)
    if published is not None:
        return sorted(published)
    return sorted(f"{run}/{batch}" for run in publish.children(spark, path) if run.startswith("run_id=")
                  for batch in publish.children(spark, f"{path}/{run}"))


def changes_since(spark: SparkSession, raw_dir: str, base: str) -> tuple[dict[str, Change], dict[str, list[str]]]:
    """What the raw fact tables hold that the marts under ``base`` don't, and the folders to remember once they do.

    Observations only ever gain micro-batches; of forecasts all dates from the
    first one that was written again are staged anew. What is not seen yet
    because a run died after its load is found too. The first time, everything.
    """
    changes, now = {}, {}
    for name, (_, raw) in MARTS.items():
        table = "weather_observations" if name == "hourly_observations" else "weather_forecasts"
        path, seen = f"{raw_dir.rstrip('/')}/{table}", publish.current(spark, f"{base.rstrip('/')}/seen_{name}")
        now[name] = _folders(spark, path)
        changed = sorted(set(now[name]) ^ set(seen or []))
        if seen is None:
            changes[name] = Change(publish.read(spark, path, raw), since="")
        elif changed and table == "weather_observations":
            fresh = [f"{path}/{f}" for f in changed if f in set(now[name])]
            if fresh:
                changes[name] = Change(spark.read.schema(raw).parquet(*fresh))
        elif changed:
            since = changed[0].split("/")[0].partition("=")[2]
            dated = publish.values_of(spark, path, "forecast_date")
            changes[name] = Change(publish.read_values(spark, path, raw, "forecast_date", [d for d in dated if d >= since]), since)
    return changes, now


def catch_up(spark: SparkSession, raw_dir: str, base: str, allow: Iterable[tuple[str, str]] = (), gate: bool = True) -> Advanced:
    """The marts under ``base`` brought up to date with the raw tables, with the declared checks as gates."""
    allow = tuple(allow)

    def check(frames: dict[str, DataFrame]) -> None:
        if gate:
            K.gate([(model, df, K.REFERENCE_SUITE[model]) for model, df in frames.items()], allow)

    changes, now = changes_since(spark, raw_dir, base)
    stations = P.stg_stations(schemas.read_raw(spark, raw_dir, "weather_stations"))
    areas = P.stg_postal_codes(P.load_areas(schemas.read_raw(spark, raw_dir, "postal_codes")))
    check({"stg_stations": stations, "stg_postal_codes": areas})
    done = advance(spark, base, stations, areas, changes, check)
    for name, folders in now.items():
        publish.switch(spark, f"{base.rstrip('/')}/seen_{name}", folders)
    return done
