"""The whole job in dependency order, with data-check gates.

landed files -> raw tables -> staging -> station map -> cleaned facts -> hourly
marts. Staging and intermediates are temporary views named like the models
(each a plan over the raw tables, as the reference's views are); marts are
catalog tables whose files are in (area, hour) order. Inside one run the staged
facts and the station map, which several models read, are written once; what
the run wrote for itself is removed at its end. After each layer the declared
checks of that layer run; a failing rule stops the job before anything that
depends on it is written. Rules listed in ``allow`` are reported but do not
stop the job.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import checks as K
from ..operators import ingest as I
from ..operators.repair import repair_areas
from ..session import materialise, scratch, together
from ..sources import landed
from . import products as P


@dataclass
class PipelineResult:
    tables: dict[str, str]                                  # mart -> path
    names: dict[str, str] = field(default_factory=dict)     # mart -> catalog table
    reports: list[DataFrame] = field(default_factory=list)


MARTS = {"hourly_observations": P.OBSERVATIONS, "hourly_forecasts": P.FORECASTS}


def register_views(raw: dict[str, DataFrame], obs_order: tuple | None = None, fc_order: tuple | None = None) -> None:
    """Staging and intermediate models as temporary views over the raw frames."""
    stations = P.stg_stations(raw["weather_stations"])
    areas = P.stg_postal_codes(P.load_areas(raw["postal_codes"]))
    obs = P.stg_facts(raw["weather_observations"], P.OBSERVATIONS, obs_order)
    fc = P.stg_facts(raw["weather_forecasts"], P.FORECASTS, fc_order)
    for name, df in (("stg_stations", stations), ("stg_postal_codes", areas), ("stg_observations", obs), ("stg_forecasts", fc)):
        df.createOrReplaceTempView(name)
    station_map = P.station_area_map(stations, areas, obs, fc)
    station_map.createOrReplaceTempView("station_area_map")
    P.cleaned(obs, station_map, P.OBSERVATIONS).createOrReplaceTempView("cleaned_observations")
    P.cleaned(fc, station_map, P.FORECASTS).createOrReplaceTempView("cleaned_forecasts")


def run_pipeline(spark: SparkSession, raw_stations: DataFrame, raw_areas: DataFrame,
                 raw_obs: DataFrame, raw_fc: DataFrame, out_dir: str, *,
                 obs_order: tuple | None = None, fc_order: tuple | None = None,
                 allow: Iterable[tuple[str, str]] = (), gate: bool = True, database: str = "analytics") -> PipelineResult:
    suite = K.REFERENCE_SUITE
    allow = tuple(allow)
    result = PipelineResult(tables={})
    base = out_dir.rstrip("/")

    def check(frames: dict[str, DataFrame]) -> None:
        if gate:
            result.reports.append(K.gate([(m, df, suite[m]) for m, df in frames.items()], allow))

    register_views({"weather_stations": raw_stations, "postal_codes": raw_areas, "weather_observations": raw_obs,
                    "weather_forecasts": raw_fc}, obs_order, fc_order)
    with scratch(spark):
        stg_stations = spark.table("stg_stations")
        stg_areas = spark.table("stg_postal_codes")
        staged = together(lambda: materialise(spark.table("stg_observations"), "stg-observations"),
                          lambda: materialise(spark.table("stg_forecasts"), "stg-forecasts"))
        stg = dict(zip(MARTS, staged))
        check({"stg_observations": stg["hourly_observations"], "stg_forecasts": stg["hourly_forecasts"],
               "stg_stations": stg_stations, "stg_postal_codes": stg_areas})

        station_map = materialise(P.station_area_map(stg_stations, stg_areas, *stg.values()), "station-map")
        check({"station_area_map": station_map})
        check({f"cleaned_{spec.name}": P.cleaned(stg[name], station_map, spec) for name, spec in MARTS.items()})

        schemas.create_namespaces(spark, base)
        bounds = I.range_bounds(stg_areas, "postal_code", int(spark.conf.get("spark.sql.shuffle.partitions")))
        for name, spec in MARTS.items():
            path, table = f"{base}/{name}", f"{database}.{name}"
            mart = P.hourly_by_area(stg[name], station_map, stg_areas, spec)
            I.write_sorted(mart, path, ["postal_code", spec.hour], bounds, table=table)
            result.tables[name], result.names[name] = path, table
            check({name: spark.table(table)})
    return result


# ------------------------------------------------------------- load jobs, L10

def _kept_rejects(rejects: DataFrame, raw_dir: str, source: str) -> DataFrame:
    """The rejects of a full load, written beside the raw tables in place of the last load's, and read back."""
    path = f"{raw_dir.rstrip('/')}/rejects/{source}"
    rejects.write.mode("overwrite").parquet(path)
    return rejects.sparkSession.read.schema(landed.REJECTS).parquet(path)


def load_stations(spark: SparkSession, landing: str, raw_dir: str, now, centre=I.DISCOVERY_CENTRE,
                  radius_m: float = I.DISCOVERY_RADIUS_M) -> DataFrame:
    """Landed station documents -> the raw station table, fully refreshed (A4, A8, B12, B14); returns the rejects."""
    rows, rejects = landed.read_stations(spark, landing, now)
    found = I.stations_in_radius(rows, centre, radius_m).withColumn("location", P.point("lon", "lat"))
    I.full_refresh(schemas.bind_by_name(found, schemas.STATIONS), f"{raw_dir.rstrip('/')}/weather_stations")
    return _kept_rejects(rejects, raw_dir, "stations")


def load_areas(spark: SparkSession, landing: str, raw_dir: str, now, prefixes=P.AREA_PREFIXES,
               layout: str = "any") -> DataFrame:
    """Landed GeoJSON features -> the raw area table, repaired and fully refreshed (A6, A7, A8, B8); returns the rejects.

    ``layout`` as in ``landed.read_geojson``: features per line and whole collections may both be landed.
    """
    rows, rejects = landed.read_geojson(spark, landing, prefixes, layout, now)
    I.full_refresh(repair_areas(rows), f"{raw_dir.rstrip('/')}/postal_codes")
    return _kept_rejects(rejects, raw_dir, "areas")


def run_job(spark: SparkSession, landing: str, raw_dir: str, out_dir: str, checkpoint: str, now, *,
            allow: Iterable[tuple[str, str]] = (), gate: bool = True, layout: str = "any",
            **limits) -> tuple[PipelineResult, DataFrame]:
    """``landing/{stations,areas,observations,forecasts}`` -> raw tables -> marts.

    Bad records go to ``raw_dir/rejects/{stations,areas,observations,forecasts}``. Returns the marts and the ingest
    summary (D3): the rows that this run's micro-batches loaded, by table and station, with a total row per
    table (null station), and the number of rejects of this run by source.
    """
    from ..streaming import incremental as S

    landing, raw_dir = landing.rstrip("/"), raw_dir.rstrip("/")
    rejects = {"stations": load_stations(spark, f"{landing}/stations", raw_dir, now),
               "areas": load_areas(spark, f"{landing}/areas", raw_dir, now, layout=layout)}
    stations = schemas.read_raw(spark, raw_dir, "weather_stations")
    batches = {
        "observations": S.run_available_now(
            spark, f"{landing}/observations", f"{raw_dir}/weather_observations", f"{checkpoint}/observations",
            I.active_stations(stations, P.ACTIVE_SINCE), now, f"{raw_dir}/rejects/observations", **limits),
        "forecasts": S.run_forecasts_available_now(
            spark, f"{landing}/forecasts", f"{raw_dir}/weather_forecasts", f"{checkpoint}/forecasts",
            stations.filter(F.col("observation_type") == "forecast"), now,
            rejects_path=f"{raw_dir}/rejects/forecasts", **limits)}
    raw = {name: S.read_table_or_empty(spark, f"{raw_dir}/{name}", schema) for name, schema in schemas.RAW.items()}
    result = run_pipeline(spark, raw["weather_stations"], raw["postal_codes"], raw["weather_observations"],
                          raw["weather_forecasts"], out_dir, allow=allow, gate=gate)
    parts = []
    for source, done in batches.items():
        counts = S.loaded(spark, f"{raw_dir}/weather_{source}", done).rollup("station_id").agg(F.sum("n_rows").alias("n_rows"))
        parts.append(counts.select(F.lit(f"weather_{source}").alias("table"), "station_id", F.coalesce("n_rows", F.lit(0)).alias("n_rows")))
        rejects[source] = S.of_batches(S.read_table_or_empty(spark, f"{raw_dir}/rejects/{source}", S.REJECTS_SCHEMA), done)
    for source, bad in rejects.items():
        parts.append(bad.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(f"rejects/{source}").alias("table"), F.lit(None).cast("string").alias("station_id"), "n_rows"))
    return result, reduce(DataFrame.unionByName, parts)
