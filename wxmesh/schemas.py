"""Declared schemas of the raw tables (A1) and table namespaces (A2).

Incoming batches are bound to these *by name*; values are converted with
``try_cast`` so a bad value becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S, D, L, TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampNTZType()

# A point is (x = lon, y = lat); an area is a multipolygon:
# parts -> rings (first ring = shell, later rings = holes) -> points.
POINT = T.StructType([T.StructField("x", D), T.StructField("y", D)])
MULTIPOLYGON = T.ArrayType(T.ArrayType(T.ArrayType(POINT)))


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


AREAS = _schema(("plz", S), ("geometry", MULTIPOLYGON), ("name", S), ("created_at", TS))

STATIONS = _schema(
    ("id", S), ("dwd_station_id", S), ("wmo_station_id", S), ("station_name", S),
    ("observation_type", S), ("lat", D), ("lon", D), ("height", D), ("location", POINT),
    ("first_record", TS), ("last_record", TS), ("distance", D), ("created_at", TS),
)

OBSERVATIONS = _schema(
    ("timestamp", TS), ("station_id", S), ("wmo_station_id", S), ("source_id", L),
    ("precipitation", D), ("pressure_msl", D), ("sunshine", D), ("temperature", D),
    ("wind_direction", L), ("wind_speed", D), ("cloud_cover", L), ("dew_point", D),
    ("relative_humidity", L), ("visibility", L), ("wind_gust_direction", L),
    ("wind_gust_speed", D), ("condition", S), ("precipitation_probability", L),
    ("precipitation_probability_6h", L), ("solar", D), ("icon", S),
    ("fallback_source_ids", S), ("ingested_at", TS),
)

FORECASTS = _schema(
    ("id", L), ("station_id", S), ("wmo_station_id", S), ("forecast_timestamp", TS),
    ("source_id", L), ("cloud_cover", D), ("condition", S), ("dew_point", D), ("icon", S),
    ("precipitation", D), ("pressure_msl", D), ("relative_humidity", D), ("sunshine", D),
    ("temperature", D), ("visibility", D), ("wind_direction", D), ("wind_speed", D),
    ("wind_gust_direction", D), ("wind_gust_speed", D), ("ingested_at", TS),
)

# The raw tables' names, columns and types.
RAW = {
    "postal_codes": AREAS,
    "weather_stations": STATIONS,
    "weather_observations": OBSERVATIONS,
    "weather_forecasts": FORECASTS,
}

NAMESPACES = ("raw", "staging", "analytics")


def create_namespaces(spark: SparkSession, location: str | None = None) -> list[str]:
    """A2: one catalog database per layer, under ``location`` if given."""
    for ns in NAMESPACES:
        where = f" LOCATION '{location.rstrip('/')}/{ns}.db'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns}{where}")
    return list(NAMESPACES)


def read_raw(spark: SparkSession, base_path: str, name: str) -> DataFrame:
    """A3: a named raw source, as it is published now, read with its declared schema (no inference)."""
    from .operators.publish import read

    return read(spark, f"{base_path.rstrip('/')}/{name}", RAW[name])


def _stamp(load_time) -> str:
    """A load time (text or datetime, UTC) as a SQL literal."""
    text = load_time if isinstance(load_time, str) else load_time.isoformat(sep=" ")
    return f"TIMESTAMP_NTZ '{text}'"


def bind_by_name(df: DataFrame, schema: T.StructType, load_time=None,
                 load_time_column: str | None = None, keep: tuple = ()) -> DataFrame:
    """Bind a batch to a declared schema by column name.

    Missing columns become typed nulls, extra columns are dropped, values are
    converted with ``try_cast``. Fractions given for an integer column are
    rounded as the reference's engine casts them: numbers half to even, text
    half away from zero. ``load_time_column`` is stamped with ``load_time`` (one
    value for the whole batch) where the batch has no value.
    Columns named in ``keep`` are carried along unchanged after the schema.
    """
    src = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for f in schema.fields:
        name, target = f"`{f.name}`", f.dataType.simpleString()
        if f.name in src:
            st = src[f.name]
            if f.name == load_time_column and load_time is not None:
                exprs.append(f"coalesce(try_cast({name} AS {target}), {_stamp(load_time)}) AS {name}")
            elif st == f.dataType:
                exprs.append(f"{name} AS {name}")
            elif isinstance(f.dataType, T.StringType) and isinstance(st, (T.ArrayType, T.StructType, T.MapType)):
                exprs.append(f"to_json({name}) AS {name}")
            elif isinstance(f.dataType, (T.LongType, T.IntegerType)) and not isinstance(
                    st, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
                whole = (f"round(try_cast({name} AS decimal(38, 10)))" if isinstance(st, T.StringType)
                         else f"bround(try_cast({name} AS double))")
                exprs.append(f"try_cast({whole} AS {target}) AS {name}")
            else:
                exprs.append(f"try_cast({name} AS {target}) AS {name}")
        elif f.name == load_time_column and load_time is not None:
            exprs.append(f"{_stamp(load_time)} AS {name}")
        else:
            exprs.append(f"CAST(NULL AS {target}) AS {name}")
    exprs.extend(f"`{k}`" for k in keep)
    return df.selectExpr(*exprs)
