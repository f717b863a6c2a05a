"""Recurring incremental loads as Structured Streaming jobs.

The reference re-runs a batch every 15 minutes and keeps per-station
high-water marks in the table. Here a file stream over the landing folder
feeds micro-batches to ``foreachBatch``, which applies the same rules (I1, A10)
against the target table. Triggered with ``availableNow`` it processes whatever
has landed and stops, so any scheduler can start it; the stream checkpoint
remembers which files were consumed. A backlog is cut into micro-batches by
``maxFilesPerTrigger`` / ``maxBytesPerTrigger``; there is no limit on the time.

Restarts and replays. A micro-batch is known by its run (the id Spark keeps in
the stream's checkpoint) and its batch number. A side table keeps, per
micro-batch, the time ``now`` it was first started with, and a replay uses that
time again; whatever else a micro-batch writes it writes to partitions of its
own or computes from state that other micro-batches left. So a replay, also one
with a later ``now``, rewrites the same rows, and a new checkpoint on an
existing table adds to it. Side tables keep the latest micro-batches only.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.timeutil import ts_literal
from ..operators import publish
from ..operators.ingest import (
    advance_marks,
    assign_ids,
    attach_station,
    forecast_window,
    high_water_marks,
    incremental_rows,
)
from ..operators.dedup import latest_wins
from ..session import delete_path, materialise, scratch
from ..sources.landed import VERDICT, judged_weather, weather_rows, weather_verdicts, with_origin, _rejects

#: When a landed entry was issued.
ISSUE = ("_issued",)
SIDE_BATCHES_KEPT = 3


def read_table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, as it is published now, read with its declared schema (partition values
    such as zero-padded ids keep their string type), or an empty frame."""
    return publish.read(spark, path, schema)


KEY = [T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())]
TIMES_SCHEMA = T.StructType([T.StructField("now", T.TimestampNTZType()), *KEY])
MARKS_SCHEMA = T.StructType([T.StructField("station_id", T.StringType()), T.StructField("last_ts", T.TimestampNTZType()), *KEY])
LOADED_SCHEMA = T.StructType([T.StructField("station_id", T.StringType()), T.StructField("n_rows", T.LongType()), *KEY])
IDS_SCHEMA = T.StructType([T.StructField("max_id", T.LongType()), *KEY])


REJECTS_SCHEMA = T.StructType([*(T.StructField(n, T.StringType()) for n in ("reason", "value", "file")), *KEY])


class Batch:
    """One micro-batch: its key, its fixed time, and its side tables next to the target table."""

    def __init__(self, spark: SparkSession, table_path: str, run_id: str, batch_id: int, now):
        self.spark, self.run_id, self.batch_id = spark, run_id, batch_id
        self.base = table_path.rstrip("/")
        own = (F.col("run_id") == run_id) & (F.col("batch_id") == batch_id)
        known = self.side("times", TIMES_SCHEMA).filter(own).agg(F.min("now")).first()[0]
        if known is None:
            self.now = now
            self.write(spark.range(1).select(ts_literal(now).alias("now")), f"{self.base}_times")
        else:
            self.now = known

    def side(self, name: str, schema: T.StructType) -> DataFrame:
        return read_table_or_empty(self.spark, f"{self.base}_{name}", schema)

    def others(self, name: str, schema: T.StructType) -> DataFrame:
        """The side table without what this micro-batch itself left there before a restart."""
        return self.side(name, schema).filter((F.col("run_id") != self.run_id) | (F.col("batch_id") < self.batch_id))

    def write(self, df: DataFrame, path: str) -> None:
        """Replace this micro-batch's partition of the table at ``path``."""
        (df.withColumn("run_id", F.lit(self.run_id)).withColumn("batch_id", F.lit(self.batch_id).cast("bigint"))
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("run_id", "batch_id").parquet(path))

    def prune(self, *names: str) -> None:
        """Side rows are cumulative: those of older micro-batches of this run are not needed any more."""
        old = self.batch_id - SIDE_BATCHES_KEPT
        for name in names:
            if old >= 0:
                delete_path(self.spark, f"{self.base}_{name}/run_id={self.run_id}/batch_id={old}")


def landed_rows(text: DataFrame, schema: T.StructType, loadable, rejects_path: str | None, load_time=None,
                keep: tuple = ()) -> tuple[DataFrame, DataFrame | None]:
    """The good entries of a micro-batch as rows of ``schema``, and the rejects if they are kept. Text is parsed once.

    Rows alone are one plan over the text, for the caller to write once. Where rejects are
    kept too, both are written in one pass: of a good entry its bound values, if ``loadable``
    (a condition that every row to load fulfils), of a bad one its reason and what is shown of it.
    """
    judged = judged_weather(text)
    if not rejects_path:
        return weather_rows(judged, schema, load_time, keep), None
    bad = F.col("_reason").isNotNull()
    entries = materialise(weather_verdicts(judged, schema, load_time, keep).filter(bad | loadable), "entries")
    return entries.filter(~bad).drop(*VERDICT), _rejects(entries)


def incremental_batch_writer(table_path: str, stations: DataFrame, now, run_id, rejects_path: str | None = None):
    """The ``foreachBatch`` function: I1 against the table, one partition per micro-batch.

    The high-water marks are not aggregated from the (ever growing) table: a
    side table holds the cumulative newest time per station after each
    micro-batch. Only where no marks exist yet (a table filled by a batch load)
    are they taken from the table. Every row gets the micro-batch's load time.
    ``run_id`` is a function, as the id is known once the stream runs.
    """
    def process(text: DataFrame, batch_id: int) -> None:
        spark = text.sparkSession
        with scratch(spark):
            batch = Batch(spark, table_path, run_id(), batch_id, now)
            marks = batch.others("marks", MARKS_SCHEMA).groupBy("station_id").agg(F.max("last_ts").alias("last_ts"))
            if marks.isEmpty():
                table = read_table_or_empty(spark, table_path, T.StructType([*schemas.OBSERVATIONS.fields, *KEY]))
                mine = (F.coalesce("run_id", F.lit("")) == batch.run_id) & (F.col("batch_id") == batch_id)
                marks = high_water_marks(table.filter(~F.coalesce(mine, F.lit(False))))
            marks = materialise(marks, "marks")
            at, n = F.col("timestamp"), ts_literal(batch.now)
            rows, rejects = landed_rows(text, schemas.OBSERVATIONS, at <= n, rejects_path, load_time=batch.now)
            rows = attach_station(rows, stations)
            new = materialise(schemas.bind_by_name(incremental_rows(rows, None, batch.now, marks=marks),
                                                   schemas.OBSERVATIONS), "obs-batch")
            batch.write(new, table_path)
            if rejects is not None:
                batch.write(rejects, rejects_path)
            batch.write(advance_marks(marks, new), f"{batch.base}_marks")
            batch.write(station_counts(new), f"{batch.base}_loaded")
            batch.prune("marks", "times")

    return process


def station_counts(rows: DataFrame) -> DataFrame:
    """D3: what one micro-batch loaded, kept beside the table under the micro-batch's key."""
    return rows.groupBy("station_id").agg(F.count(F.lit(1)).alias("n_rows"))


def of_batches(rows: DataFrame, batches: list[tuple[str, int]]) -> DataFrame:
    """The rows of a keyed table that the given micro-batches wrote."""
    keys = rows.sparkSession.createDataFrame(batches, "run_id string, batch_id long")
    return rows.join(F.broadcast(keys), ["run_id", "batch_id"], "left_semi")  # one row per micro-batch of this call


def loaded(spark: SparkSession, table_path: str, batches: list[tuple[str, int]]) -> DataFrame:
    """D3: ``station_id, n_rows`` that the given micro-batches loaded, also if one was a replay."""
    counts = of_batches(read_table_or_empty(spark, f"{table_path.rstrip('/')}_loaded", LOADED_SCHEMA), batches)
    return counts.groupBy("station_id").agg(F.sum("n_rows").alias("n_rows"))


def run_available_now(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                      stations: DataFrame, now, rejects_path: str | None = None, **limits) -> list[tuple[str, int]]:
    """Process every landed file not seen before, then stop; returns the keys of the micro-batches.

    ``limits``: ``max_files`` and ``max_bytes`` of a micro-batch.
    """
    return _run(spark, landing, checkpoint, lambda run_id: incremental_batch_writer(
        table_path, stations, now, run_id, rejects_path), **limits)


def _run(spark: SparkSession, landing: str, checkpoint: str, writer, max_files: int | None = None,
         max_bytes: int | None = None) -> list[tuple[str, int]]:
    reader = spark.readStream.format("text")
    for name, value in (("maxFilesPerTrigger", max_files), ("maxBytesPerTrigger", max_bytes)):
        if value is not None:
            reader = reader.option(name, value)
    started, known = threading.Event(), []

    def run_id() -> str:
        started.wait()
        return known[0]

    process, done = writer(run_id), []

    def noted(text: DataFrame, batch_id: int) -> None:
        process(text, batch_id)
        done.append((run_id(), batch_id))

    query = (with_origin(reader.load(landing)).writeStream.foreachBatch(noted)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    known.append(query.id)
    started.set()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return done


# --------------------------------------------------------------- forecasts --

FORECAST_ORDER = ("_issued", "station_id", "forecast_timestamp", *(
    c for c in schemas.FORECASTS.fieldNames() if c not in ("id", "station_id", "forecast_timestamp", "ingested_at")))
DATED = T.StructType([*schemas.FORECASTS.fields, T.StructField("forecast_date", T.DateType())])


def forecast_batch_writer(table_path: str, stations: DataFrame, now, run_id, id_order=FORECAST_ORDER,
                          rejects_path: str | None = None):
    """The ``foreachBatch`` function for forecasts: replace-future (A10).

    Of several issues of a station's hour in one micro-batch the newest (by its
    issue time, then its values) stays. The table is partitioned by the
    forecast's date; past hours can never change, so a micro-batch reads and
    rewrites only the dates from ``now`` on, which the horizon bounds, whatever
    the history; they change places in one step (see ``publish``). The largest id so far is kept in a side table.
    """
    def process(text: DataFrame, batch_id: int) -> None:
        spark = text.sparkSession
        with scratch(spark):
            batch = Batch(spark, table_path, run_id(), batch_id, now)
            at, n = F.col("forecast_timestamp"), ts_literal(batch.now)
            rows, rejects = landed_rows(text, schemas.FORECASTS, at > n, rejects_path, keep=ISSUE)
            rows = attach_station(rows, stations)
            rows = latest_wins(forecast_window(rows, batch.now), ["station_id", "forecast_timestamp"],
                               [*ISSUE, *(c for c in FORECAST_ORDER if c not in (*ISSUE, "station_id", "forecast_timestamp"))])
            fresh = materialise(rows, "fc-batch")
            table = read_table_or_empty(spark, table_path, DATED)
            ahead = table.filter(F.col("forecast_date") >= n.cast("date"))
            seen = batch.others("ids", IDS_SCHEMA)
            if seen.isEmpty():  # a table filled by a batch load has ids, but no side table yet
                seen = table.filter(F.coalesce(F.col("ingested_at") != n, F.lit(True))).agg(F.max("id").alias("max_id"))
            last = seen.agg(F.coalesce(F.max("max_id"), F.lit(0))).first()[0]
            touched = fresh.select("station_id").distinct()
            kept = ahead.alias("e").join(
                touched.alias("s"), (F.col("e.station_id") == F.col("s.station_id")) & (F.col("e.forecast_timestamp") > n), "left_anti")
            numbered = assign_ids(fresh, id_order, last).withColumn("ingested_at", n) \
                .select(*schemas.FORECASTS.fieldNames()).withColumn("forecast_date", F.col("forecast_timestamp").cast("date"))
            publish.replace_partitions(kept.select(*DATED.fieldNames()).unionByName(numbered), table_path, "forecast_date",
                                       str(spark.range(1).select(n.cast("date").cast("string")).first()[0]))
            if rejects is not None:
                batch.write(rejects, rejects_path)
            top = fresh.agg((F.count(F.lit(1)) + F.lit(last)).cast("bigint").alias("max_id"))
            batch.write(top, f"{batch.base}_ids")
            batch.write(station_counts(fresh), f"{batch.base}_loaded")
            batch.prune("ids", "times")

    return process


def run_forecasts_available_now(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                                stations: DataFrame, now, id_order=FORECAST_ORDER, rejects_path: str | None = None,
                                **limits) -> list[tuple[str, int]]:
    """Forecast runs: every landed file not seen before, then stop (``limits`` and result as above)."""
    return _run(spark, landing, checkpoint, lambda run_id: forecast_batch_writer(
        table_path, stations, now, run_id, id_order, rejects_path), **limits)
