"""Raw frames derived from the driver tables (see FIXTURES.md, section 3).

The reference ships no sample data; these derivations turn the driver's
TPC-H-like tables into stations, areas, observations and forecasts with the
same schemas as the raw tables. Every frame is a plain projection of one
driver table, so it scales with the table and keeps Parquet pushdown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.geo import point
from ..functions.timeutil import hour_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _wmo(key: Column) -> Column:
    """Null for every 20th source, else 'W' + 5-digit place id (two sources per place)."""
    return F.when(key % 20 != 19, F.concat(F.lit("W"), _pad(F.floor(key / 2), 5)))


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def raw_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    key = F.col("s_suppkey")
    k = F.floor(key / 2)
    kk = k - F.when(k % 11 == 3, 1).otherwise(0)
    df = s.select(
        _pad(key, 6).alias("id"),
        _wmo(key).alias("wmo_station_id"),
        F.col("s_name").alias("station_name"),
        F.when(key % 2 == 0, F.lit("historical")).otherwise(F.lit("forecast")).alias("observation_type"),
        (F.lit(52.52) + ((kk * 53) % 97 - 48) / 400.0).alias("lat"),
        (F.lit(13.4) + ((kk * 37) % 101 - 50) / 250.0 + (key % 2) / 100000.0).alias("lon"),
        F.when((key % 10 == 7) | (k % 9 == 4), _ts("2023-05-03 00:00:00"))
         .otherwise(_ts("2025-12-01 00:00:00")).alias("last_record"),
    )
    return schemas.bind_by_name(df, schemas.STATIONS)


def _l_shape(x0: Column, y0: Column, step: float = 0.005) -> Column:
    corners = [(0, 0), (4, 0), (4, 1), (1, 1), (1, 3), (0, 3), (0, 0)]
    ring = F.array(*[point(x0 + step * dx, y0 + step * dy) for dx, dy in corners])
    return F.array(F.array(ring))


def raw_postal(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    prefix = (F.when(n % 6 == 5, F.lit("14"))
              .when(n % 3 == 0, F.lit("10")).when(n % 3 == 1, F.lit("12")).otherwise(F.lit("13")))
    x0 = F.lit(13.4) + ((n * 29) % 51 - 25) / 100.0 + F.when(n == 24, 2.0).otherwise(0.0)
    y0 = F.lit(52.52) + ((n * 31) % 41 - 20) / 100.0
    plz = F.concat(prefix, _pad(n, 3))
    df = table(spark, sf_dir, "nation").select(
        plz.alias("plz"), _l_shape(x0, y0).alias("geometry"), plz.alias("name"))
    return schemas.bind_by_name(df, schemas.AREAS)


def raw_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations; ``event_id`` is kept as an extra tie-break column."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    eid, uid = F.col("event_id"), F.col("user_id")
    df = e.select(
        hour_of("ts").alias("timestamp"),
        _pad(uid, 6).alias("station_id"),
        _wmo(uid).alias("wmo_station_id"),
        F.when(eid % 7 != 0, F.col("value") * 0.125).alias("precipitation"),
        F.when(F.col("event_type") != "error", F.col("value") - 20.0).alias("temperature"),
        (eid % 40 * 0.25).alias("wind_speed"),
        F.when(eid % 23 != 0, (eid * 13) % 104).alias("relative_humidity"),
        F.col("ts").alias("ingested_at"),
        eid.alias("event_id"),
    )
    return schemas.bind_by_name(df, schemas.OBSERVATIONS, keep=("event_id",))


def raw_fc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts; ``tie`` is kept as an extra tie-break column."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    h = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 240
    temp = (F.when(F.col("l_partkey") % 50 == 0, F.lit(99.0))
            .when((h % 24).isin(3, 4), F.lit(None).cast("double"))
            .when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 2), F.lit(None).cast("double"))
            .otherwise(F.col("l_quantity") * 1.5 - 20.0))
    df = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        _pad(F.col("l_suppkey"), 6).alias("station_id"),
        _wmo(F.col("l_suppkey")).alias("wmo_station_id"),
        (_ts("2024-02-01 00:00:00") + F.make_dt_interval(F.lit(0), h.cast("int"))).alias("forecast_timestamp"),
        F.col("l_partkey").alias("source_id"),
        (F.col("l_discount") * 10.0).alias("precipitation"),
        (F.col("l_linenumber") * 15.0 - 2.0).alias("relative_humidity"),
        temp.alias("temperature"),
        (F.col("l_quantity") * 0.5).alias("wind_speed"),
        F.col("l_shipdate").alias("ingested_at"),
        F.col("l_extendedprice").alias("tie"),
    )
    return schemas.bind_by_name(df, schemas.FORECASTS, keep=("tie",))


def bench_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many point areas from ``customer`` (distance-join scale tests).

    Every 1,500 customers fill one box of about 100 km; more customers mean more
    boxes, so the density of areas is the same at every scale.
    """
    c = F.col("c_custkey")
    box = F.floor(c / 1500)
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), c.cast("string")).alias("postal_code"),
        point(F.lit(13.4) + ((c * 29) % 1501 - 750) / 2500.0 + (box % 40) * 2.0,
              F.lit(52.52) + ((c * 31) % 1499 - 749) / 3000.0 - F.floor(box / 40) * 1.5).alias("centroid"),
    )


def bench_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations in the boxes of ``bench_areas``, 100 sources to a box, like 1,500 areas.

    They lie as in ``raw_stations``, shifted by box. Ids are padded, never cut, so
    every place is one of its own at any scale.
    """
    key = F.col("s_suppkey")
    k, box = F.floor(key / 2), F.floor(key / 100)
    kk = k - F.when(k % 11 == 3, 1).otherwise(0)
    df = table(spark, sf_dir, "supplier").select(
        F.format_string("%06d", key).alias("id"),
        F.when(key % 20 != 19, F.format_string("W%05d", k)).alias("wmo_station_id"),
        F.col("s_name").alias("station_name"),
        (F.lit(52.52) + ((kk * 53) % 97 - 48) / 400.0 - F.floor(box / 40) * 1.5).alias("lat"),
        (F.lit(13.4) + ((kk * 37) % 101 - 50) / 250.0 + (key % 2) / 100000.0 + (box % 40) * 2.0).alias("lon"),
        F.when((key % 10 == 7) | (k % 9 == 4), _ts("2023-05-03 00:00:00"))
         .otherwise(_ts("2025-12-01 00:00:00")).alias("last_record"),
    )
    return schemas.bind_by_name(df, schemas.STATIONS)
