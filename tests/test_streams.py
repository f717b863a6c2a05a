"""Loading streams: load times, restarts, replays, new checkpoints, several issues, rejects, backlogs."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from wxmesh import schemas
from wxmesh.operators import ingest as I
from wxmesh.session import materialise, release_scratch, scratch, scratch_path
from wxmesh.sources import landed
from wxmesh.streaming import incremental as S

NOW = dt.datetime(2024, 1, 25, 12)


def at(hour, day=25):
    return f"2024-01-{day:02d}T{hour:02d}:00:00+00:00"


def land(folder, name, *docs, when=None):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        for d in docs:
            f.write((d if isinstance(d, str) else json.dumps(d)) + "\n")
    if when:
        os.utime(f"{folder}/{name}", (when, when))


def doc(station, *entries, **more):
    return {"station_id": station, **more, "weather": [{"timestamp": t, "temperature": v} for t, v in entries]}


@pytest.fixture
def stations(spark):
    return spark.createDataFrame([("S1", "W1"), ("S2", "W2")], "id string, wmo_station_id string")


@pytest.fixture
def folders(tmp_dir):
    return tuple(f"{tmp_dir}/{n}" for n in ("landing", "table", "ckpt"))


def observed(spark, table):
    rows = spark.read.parquet(table).collect()
    assert set(schemas.OBSERVATIONS.fieldNames()) <= set(spark.read.parquet(table).columns)
    return sorted((r["station_id"], r["timestamp"], r["temperature"], r["ingested_at"]) for r in rows)


def forecasts(spark, table):
    return sorted((r["station_id"], r["forecast_timestamp"].strftime("%d %H"), r["temperature"], r["id"], r["ingested_at"])
                  for r in spark.read.schema(S.DATED).parquet(table).collect())


def uncommit(ckpt, batch=0):
    for name in (f"{batch}", f".{batch}.crc"):
        if os.path.exists(f"{ckpt}/commits/{name}"):
            os.remove(f"{ckpt}/commits/{name}")


def test_observations_replay_restart_and_new_checkpoint(spark, stations, folders, tmp_dir):
    landing, table, ckpt = folders
    land(landing, "a.json", doc("S1", (at(1), 1.0), (at(2), 2.0)), doc("nowhere", (at(1), 9.0)))
    S.run_available_now(spark, landing, table, ckpt, stations, NOW)
    first = observed(spark, table)
    assert [(r[0], r[2], r[3]) for r in first] == [("S1", 1.0, NOW), ("S1", 2.0, NOW)]
    uncommit(ckpt)
    S.run_available_now(spark, landing, table, ckpt, stations, NOW + dt.timedelta(days=1))
    assert observed(spark, table) == first                       # replayed with its own time
    later = NOW + dt.timedelta(hours=1)
    land(landing, "b.json", doc("S1", (at(2), 7.0), (at(3), 3.0)), doc("S2", (at(1), 4.0)))
    S.run_available_now(spark, landing, table, f"{tmp_dir}/other", stations, later)
    assert [(r[0], r[2], r[3]) for r in observed(spark, table)] == [
        ("S1", 1.0, NOW), ("S1", 2.0, NOW), ("S1", 3.0, later), ("S2", 4.0, later)]


def test_marks_of_a_batch_loaded_table(spark, stations, folders):
    landing, table, ckpt = folders
    loaded = spark.createDataFrame([("S1", "2024-01-25 02:00:00", 2.0)], "station_id string, timestamp string, temperature double")
    (schemas.bind_by_name(loaded, schemas.OBSERVATIONS, "2024-01-25 03:00:00", "ingested_at")
     .withColumn("run_id", F.lit("batch")).withColumn("batch_id", F.lit(0)).write.partitionBy("run_id", "batch_id").parquet(table))
    land(landing, "a.json", doc("S1", (at(1), 1.0), (at(2), 2.0), (at(3), 3.0)))
    S.run_available_now(spark, landing, table, ckpt, stations, NOW)
    assert [r[2] for r in observed(spark, table)] == [2.0, 3.0]


def test_backlog_is_cut_into_micro_batches_and_side_tables_stay_small(spark, stations, folders):
    landing, table, ckpt = folders
    for k in range(7):
        land(landing, f"{k}.json", doc("S1", (at(k), float(k))), when=1_700_000_000 + k)
    S.run_available_now(spark, landing, table, ckpt, stations, NOW, max_files=1)
    assert [r[2] for r in observed(spark, table)] == [float(k) for k in range(7)]
    runs = os.listdir(f"{table}_marks")
    kept = [d for d in os.listdir(f"{table}_marks/{[r for r in runs if r.startswith('run_id')][0]}") if d.startswith("batch")]
    assert len(kept) == S.SIDE_BATCHES_KEPT
    assert len(os.listdir(f"{ckpt}/commits")) >= 7


def test_rejects_of_a_stream(spark, stations, folders, tmp_dir):
    landing, table, ckpt = folders
    land(landing, "a.json", doc("S1", (at(1), 1.0), ("soon", 2.0)), '{"station_id": "S1", "weather": [', "")
    S.run_available_now(spark, landing, table, ckpt, stations, NOW, rejects_path=f"{tmp_dir}/rejects")
    assert len(observed(spark, table)) == 1
    got = spark.read.parquet(f"{tmp_dir}/rejects").collect()
    assert sorted(r["reason"] for r in got) == ["bad timestamp", "malformed document"]
    assert all(r["file"].endswith("a.json") for r in got)


def test_newest_issue_wins_in_one_micro_batch(spark, stations, folders):
    landing, table, ckpt = folders
    land(landing, "z.json", doc("S1", (at(14), 9.0), (at(15), 1.0)), when=1_700_000_000)
    land(landing, "a.json", doc("S1", (at(14), 5.0)), when=1_700_000_900)
    land(landing, "b.json", doc("S2", (at(14), 6.0), issued="2024-01-25T11:00:00Z"), when=1_700_009_999)
    land(landing, "c.json", doc("S2", (at(14), 3.0), issued="2024-01-25T11:30:00Z"), when=1_700_000_000)
    S.run_forecasts_available_now(spark, landing, table, ckpt, stations, NOW)
    assert [(s, t, v) for s, t, v, _, _ in forecasts(spark, table)] == [
        ("S1", "25 14", 5.0), ("S1", "25 15", 1.0), ("S2", "25 14", 3.0)]
    assert sorted(i for *_, i, _ in forecasts(spark, table)) == [1, 2, 3]


def test_forecast_replay_with_a_later_now_keeps_rows_and_ids(spark, stations, folders):
    landing, table, ckpt = folders
    land(landing, "a.json", doc("S1", (at(13), 1.0), (at(18), 2.0), (at(3, 26), 3.0)))
    S.run_forecasts_available_now(spark, landing, table, ckpt, stations, NOW)
    first = forecasts(spark, table)
    assert [i for *_, i, _ in first] == [1, 2, 3] and {r[4] for r in first} == {NOW}
    uncommit(ckpt)
    S.run_forecasts_available_now(spark, landing, table, ckpt, stations, NOW + dt.timedelta(hours=4))
    assert forecasts(spark, table) == first


def test_forecast_run_rewrites_only_dates_from_now_on(spark, stations, folders):
    landing, table, ckpt = folders
    land(landing, "a.json", doc("S1", (at(13), 1.0), (at(3, 26), 2.0), (at(3, 27), 3.0), (at(3, 28), 4.0)), doc("S2", (at(5, 26), 8.0)))
    S.run_forecasts_available_now(spark, landing, table, ckpt, stations, NOW)
    files = {d: sorted(os.listdir(f"{table}/{d}")) for d in os.listdir(table) if d.startswith("forecast_date")}
    assert sorted(files) == [f"forecast_date=2024-01-{d}" for d in (25, 26, 27, 28)]
    next_day = NOW + dt.timedelta(days=1)
    land(landing, "b.json", doc("S1", (at(15, 26), 20.0), (at(3, 27), 30.0)))
    S.run_forecasts_available_now(spark, landing, table, ckpt, stations, next_day)
    assert sorted(os.listdir(f"{table}/forecast_date=2024-01-25")) == files["forecast_date=2024-01-25"]   # untouched
    assert not os.path.exists(f"{table}/forecast_date=2024-01-28")                                        # its only row was replaced
    assert [(s, t, v) for s, t, v, _, _ in forecasts(spark, table)] == [
        ("S1", "25 13", 1.0), ("S1", "26 03", 2.0), ("S1", "26 15", 20.0), ("S1", "27 03", 30.0), ("S2", "26 05", 8.0)]
    assert sorted(i for *_, i, _ in forecasts(spark, table)) == [1, 2, 5, 6, 7]


def test_plan_of_a_forecast_run_reads_no_past_date(spark, stations, folders):
    landing, table, ckpt = folders
    land(landing, "a.json", doc("S1", (at(13), 1.0), (at(3, 27), 3.0)))
    S.run_forecasts_available_now(spark, landing, table, ckpt, stations, NOW)
    ahead = S.read_table_or_empty(spark, table, S.DATED).filter(F.col("forecast_date") >= F.lit("2024-01-26").cast("date"))
    plan = ahead._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(forecast_date" in plan and [r["temperature"] for r in ahead.collect()] == [3.0]


def test_scratch_is_removed_and_a_cluster_needs_a_shared_folder(spark):
    from wxmesh import session

    with scratch(spark) as own:
        materialise(spark.range(3), "t")
        (path,) = own.paths
        assert os.path.exists(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))
    kept = scratch_path(spark, "kept")
    spark.range(1).write.parquet(kept)
    release_scratch(spark)
    assert not os.path.exists(kept.removeprefix("file:"))
    assert session.is_local("local") and session.is_local("local[4]")
    assert not session.is_local("local-cluster[2,1,1024]") and not session.is_local("spark://host:7077")


def test_a_run_leaves_nothing_in_the_shared_folder(spark, tmp_dir):
    from wxmesh.plans.pipeline import run_pipeline
    from wxmesh.session import checkpoint_dir
    from wxmesh.sources import fixtures as fx

    sf = "/root/testdata/sf0.001"
    folder = checkpoint_dir(spark).removeprefix("file:")
    tables = lambda: {d for d in os.listdir(folder) if "-" in d and os.path.isdir(f"{folder}/{d}") and len(d) < 40}
    before = tables()
    result = run_pipeline(spark, fx.raw_stations(spark, sf), fx.raw_postal(spark, sf), fx.raw_obs(spark, sf), fx.raw_fc(spark, sf),
                          f"{tmp_dir}/marts", allow=[("stg_observations", "not_null(wmo_station_id)"), ("stg_forecasts", "not_null(wmo_station_id)")])
    assert tables() == before
    assert spark.table("analytics.hourly_observations").count() == 6720
    assert spark.table("stg_observations").count() > 0 and spark.table("cleaned_forecasts").count() > 0
    assert set(result.names.values()) == {"analytics.hourly_observations", "analytics.hourly_forecasts"}


def test_a_replay_is_counted_as_what_it_loads(spark, stations, folders):
    landing, table, ckpt = folders
    land(landing, "a.json", doc("S1", (at(1), 1.0), (at(2), 2.0)), doc("S2", (at(3), 3.0)), "broken")
    first = S.run_available_now(spark, landing, table, ckpt, stations, NOW)
    counts = lambda done: {r["station_id"]: r["n_rows"] for r in S.loaded(spark, table, done).collect()}
    assert counts(first) == {"S1": 2, "S2": 1}
    for name in ("0", ".0.crc"):
        os.remove(f"{ckpt}/commits/{name}")
    replayed = S.run_available_now(spark, landing, table, ckpt, stations, NOW + dt.timedelta(days=1))
    assert replayed == first and counts(replayed) == {"S1": 2, "S2": 1}
    land(landing, "b.json", doc("S1", (at(4), 4.0)))
    second = S.run_available_now(spark, landing, table, ckpt, stations, NOW)
    assert counts(second) == {"S1": 1} and counts(first + second) == {"S1": 3, "S2": 1}
    assert S.run_available_now(spark, landing, table, ckpt, stations, NOW) == [] and counts([]) == {}


def test_landed_weather_is_parsed_once(spark, tmp_dir):
    """A condition on a document, a join on its station or the step for rejects must not parse its text again."""
    lines = ['{"station_id":"A","weather":[{"timestamp":"2024-01-01T00:00:00Z","temperature":"1.5"},null,{"timestamp":"x"}]}',
             '{"station_id":"A","weather":[]}', '{"station_id":"A","weather":null}', '{"station_id":"A"}', '{"weather":[{}]}', '{"station_id":"A', "7"]
    with open(f"{tmp_dir}/a.json", "w") as f:
        f.write("\n".join(lines))
    judged = landed.judged_weather(landed.lines(spark, tmp_dir))
    stations = spark.createDataFrame([("A", "W")], "id string, wmo_station_id string")
    rows = I.attach_station(landed.weather_rows(judged), stations).filter("timestamp <= timestamp_ntz'2025-01-01 00:00:00'")
    both = landed.weather_verdicts(judged).filter("_reason IS NOT NULL OR timestamp <= timestamp_ntz'2025-01-01 00:00:00'")
    for df in (rows, both):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert [(r["station_id"], r["wmo_station_id"], r["temperature"]) for r in rows.collect()] == [("A", "W", 1.5)]
    got = [(r["_reason"], r["_shown"], r["temperature"]) for r in both.collect()]
    assert sorted(got, key=str) == sorted([
        (None, None, 1.5), ("empty entry", lines[0], None), ("bad timestamp", '{"timestamp":"x"}', None), ("no station id", "{}", None),
        ("malformed document", lines[5], None), ("malformed document", lines[6], None)], key=str)
