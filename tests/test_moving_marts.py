"""Marts kept up to date by the day equal a full rebuild, and read and write only the days they must."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from test_streams import at, doc, land
from wxmesh import schemas
from wxmesh.operators import checks as K
from wxmesh.operators import publish
from wxmesh.plans import moving_marts as M
from wxmesh.plans import products as P
from wxmesh.streaming import incremental as S

OBS, FC = "hourly_observations", "hourly_forecasts"
T0 = dt.datetime(2026, 3, 1)


def stations(spark, *ids):
    rows = [(f"s{i}", i, 52.5, 13.4 + n / 1000, dt.datetime(2026, 1, 1)) for n, i in enumerate(ids)]
    return P.stg_stations(schemas.bind_by_name(spark.createDataFrame(
        rows, "id string, wmo_station_id string, lat double, lon double, last_record timestamp_ntz"), schemas.STATIONS))


def areas(spark, *codes):
    ring = [(13.4, 52.5), (13.41, 52.5), (13.41, 52.51), (13.4, 52.5)]
    return P.stg_postal_codes(spark.createDataFrame([(c, [[ring]], c, None) for c in codes], schemas.AREAS))


def observed(spark, *rows):
    """(WMO id, hours after T0 or None, temperature, load minute)"""
    rows = [(w, None if h is None else T0 + dt.timedelta(hours=h), t, 50, T0 + dt.timedelta(days=90, minutes=m)) for w, h, t, m in rows]
    return schemas.bind_by_name(spark.createDataFrame(
        rows, "wmo_station_id string, timestamp timestamp_ntz, temperature double, relative_humidity int, ingested_at timestamp_ntz"),
        schemas.OBSERVATIONS)


def forecast(spark, *rows):
    return schemas.bind_by_name(observed(spark, *rows).withColumnRenamed("timestamp", "forecast_timestamp"), schemas.FORECASTS)


def lines(df):
    return sorted(df.collect(), key=str)


def rebuilt(spark, st, ar, obs, fc):
    """Both marts from all raw rows."""
    so, sf = P.stg_facts(obs, P.OBSERVATIONS), P.stg_facts(fc, P.FORECASTS)
    smap = P.station_area_map(st, ar, so, sf)
    return {OBS: lines(P.hourly_by_area(so, smap, ar, P.OBSERVATIONS)), FC: lines(P.hourly_by_area(sf, smap, ar, P.FORECASTS))}


def same(spark, base, st, ar, obs, fc):
    want = rebuilt(spark, st, ar, obs, fc)
    for name in (OBS, FC):
        assert lines(M.read_mart(spark, base, name)) == want[name], name


def day(n):
    return str((T0 + dt.timedelta(days=n)).date())


HISTORY = [("A", h, float(h), 0) for h in (0, 1, 23, 24, 30, 47, 96, 97, 120, 200)] + [("B", h, None, 0) for h in (0, 23, 97)] \
    + [("B", 1, 5.0, 0), (None, 24, 9.0, 0), ("A", None, 3.0, 0)]


def test_only_touched_days_and_their_neighbours(spark, tmp_dir):
    base, st, ar = f"{tmp_dir}/m", stations(spark, "A", "B"), areas(spark, "10a", "12b")
    obs, fc = observed(spark, *HISTORY), forecast(spark, *HISTORY)
    first = M.advance(spark, base, st, ar, {OBS: M.Change(obs), FC: M.Change(fc)})
    assert first.everything
    same(spark, base, st, ar, obs, fc)
    files = lambda name: set(publish.current(spark, f"{base}/{name}"))
    before = files(OBS), files(FC)

    # day 1: its last hour, without a value, fills nothing any more; the next day with hours is day 4
    late = observed(spark, ("A", 47, None, 5), ("B", 46, 7.0, 5))
    done = M.advance(spark, base, st, ar, {OBS: M.Change(late)})
    assert not done.everything and done.rebuilt == {OBS: [day(1), day(4)]}
    assert done.read == {OBS: [day(0), day(1), day(4)]}
    obs = obs.unionByName(late)
    same(spark, base, st, ar, obs, fc)
    changed = {f.split("/")[0] for f in before[0] ^ files(OBS)}
    assert changed == {f"day={day(1)}", f"day={day(4)}"} and files(FC) == before[1]

    # the same again with an older row, and a new day beyond all others
    more = late.unionByName(observed(spark, ("A", 47, 1000.0, -5), ("A", 300, 4.0, 6)))
    M.advance(spark, base, st, ar, {OBS: M.Change(more)})
    same(spark, base, st, ar, obs.unionByName(more), fc)
    assert M.advance(spark, base, st, ar, {OBS: M.Change(late.limit(0))}).rebuilt == {}
    assert M.advance(spark, base, st, ar, {}).rebuilt == {}


def test_replaced_forecasts_leave_days_behind_and_empty_ones_go(spark, tmp_dir):
    base, st, ar = f"{tmp_dir}/m", stations(spark, "A", "B"), areas(spark, "10a")
    obs, fc = observed(spark, ("A", 1, 1.0, 0), ("B", 1, 1.0, 0)), forecast(spark, *HISTORY[:-1])
    M.advance(spark, base, st, ar, {OBS: M.Change(obs), FC: M.Change(fc)})
    fresh = forecast(spark, ("A", 100, 1.5, 9), ("B", 5, 99.0, 9))     # the second lies before the replaced days
    done = M.advance(spark, base, st, ar, {FC: M.Change(fresh, day(4))})
    assert done.rebuilt == {FC: [day(4), day(5), day(8)]}
    kept = fc.filter(F.col("forecast_timestamp") < T0 + dt.timedelta(days=4)).unionByName(fresh.filter("temperature = 1.5"))
    same(spark, base, st, ar, obs, kept)
    assert publish.values_of(spark, f"{base}/{FC}", "day") == [day(0), day(1), day(4)]


def test_a_new_map_rebuilds_all_days_from_the_staged_rows(spark, tmp_dir):
    base, st, ar = f"{tmp_dir}/m", stations(spark, "A", "B"), areas(spark, "10a")
    obs, fc = observed(spark, *HISTORY[:6]), forecast(spark, ("A", 2, 1.0, 0))
    M.advance(spark, base, st, ar, {OBS: M.Change(obs), FC: M.Change(fc)})
    ar2 = areas(spark, "10a", "13c", "13c")
    assert M.advance(spark, base, st, ar2, {}).everything
    same(spark, base, st, ar2, obs, fc)
    news = observed(spark, ("B", 200, 8.0, 1), ("B", 1, 8.0, 1))       # B has data from now on
    assert M.advance(spark, base, st, ar2, {OBS: M.Change(news)}).everything
    same(spark, base, st, ar2, obs.unionByName(news), fc)
    gone = observed(spark, ("B", 200, None, 2), ("B", 1, None, 2))     # and loses it again
    assert M.advance(spark, base, st, ar2, {OBS: M.Change(gone)}).everything
    same(spark, base, st, ar2, obs.unionByName(news).unionByName(gone), fc)


@pytest.mark.parametrize("switches", [1, 4])
def test_a_run_that_dies_is_caught_up(spark, tmp_dir, monkeypatch, switches):
    base, st, ar = f"{tmp_dir}/m", stations(spark, "A", "B"), areas(spark, "10a")
    obs, fc = observed(spark, *HISTORY[:8]), forecast(spark, ("A", 2, 1.0, 0), ("B", 2, 1.0, 0))
    M.advance(spark, base, st, ar, {OBS: M.Change(obs), FC: M.Change(fc)})
    real, left = publish.switch, [switches]

    def dies(*args):
        left[0] -= 1
        if left[0] < 0:
            raise OSError("killed")
        real(*args)

    more = observed(spark, ("A", 25, 2.5, 4))
    monkeypatch.setattr(publish, "switch", dies)
    with pytest.raises(OSError):
        M.advance(spark, base, st, ar, {OBS: M.Change(more)})
    monkeypatch.setattr(publish, "switch", real)
    if switches > 1:  # the rows are staged: the next run needs them no more
        M.advance(spark, base, st, ar, {})
    else:
        M.advance(spark, base, st, ar, {OBS: M.Change(more)})
    same(spark, base, st, ar, obs.unionByName(more), fc)


def test_empty_tables(spark, tmp_dir):
    base, none = f"{tmp_dir}/m", observed(spark, ("A", 1, 1.0, 0)).limit(0)
    done = M.advance(spark, base, stations(spark, "A"), areas(spark, "10a"), {OBS: M.Change(none)})
    assert done.rebuilt == {} and lines(M.read_mart(spark, base, OBS)) == []


def test_catching_up_with_the_streams(spark, tmp_dir, monkeypatch):
    """Two loads with a dead run between; only the second one's days are staged again; a failing check stops the run."""
    raw, base = f"{tmp_dir}/raw", f"{tmp_dir}/marts"
    known = spark.createDataFrame([("S1", "W1"), ("S2", "W2")], "id string, wmo_station_id string")
    places = spark.createDataFrame([("S1", "W1", 52.5, 13.4, dt.datetime(2026, 1, 1)), ("S2", "W2", 52.51, 13.4, dt.datetime(2026, 1, 1))],
                                   "id string, wmo_station_id string, lat double, lon double, last_record timestamp_ntz")
    schemas.bind_by_name(places, schemas.STATIONS).withColumn("station_name", F.col("id")).withColumn("dwd_station_id", F.col("id")) \
        .withColumn("location", P.point("lon", "lat")).write.parquet(f"{raw}/weather_stations")
    areas(spark, "10a").select(F.col("postal_code").alias("plz"), "geometry").write.parquet(f"{raw}/postal_codes")
    load = lambda kind, run, now: run(spark, f"{tmp_dir}/{kind}", f"{raw}/weather_{kind}", f"{tmp_dir}/ckpt-{kind}", known, now)

    def loads(now):
        load("observations", S.run_available_now, now)
        load("forecasts", S.run_forecasts_available_now, now)

    def check():
        read = lambda name, t: publish.read(spark, f"{raw}/{name}", t)
        same(spark, base, P.stg_stations(schemas.read_raw(spark, raw, "weather_stations")), areas(spark, "10a"),
             read("weather_observations", schemas.OBSERVATIONS), read("weather_forecasts", schemas.FORECASTS))

    land(f"{tmp_dir}/observations", "a.json", doc("S1", (at(1, 20), 1.0), (at(23, 20), 2.0), (at(0, 22), None)), doc("S2", (at(1, 20), 4.0)))
    land(f"{tmp_dir}/forecasts", "a.json", doc("S1", (at(13), 1.0), (at(3, 26), 2.0), (at(3, 28), 4.0)), doc("S2", (at(5, 26), 8.0)))
    loads(dt.datetime(2024, 1, 25, 12))
    M.catch_up(spark, raw, base)
    check()
    land(f"{tmp_dir}/observations", "b.json", doc("S1", (at(4, 24), 7.0)))
    loads(dt.datetime(2024, 1, 25, 13))                              # this load's marts were never built
    land(f"{tmp_dir}/forecasts", "b.json", doc("S1", (at(3, 27), 30.0)))
    land(f"{tmp_dir}/observations", "c.json", doc("S1", (at(5, 24), 9.0)))
    loads(dt.datetime(2024, 1, 26, 1))
    done = M.catch_up(spark, raw, base)
    check()
    assert not done.everything and done.rebuilt[OBS] == ["2024-01-24"] and done.rebuilt[FC][0] == "2024-01-26"
    assert M.catch_up(spark, raw, base).rebuilt == {}
    land(f"{tmp_dir}/observations", "d.json", doc("S1", (at(6, 24), 11.0)), doc("S2", (at(6, 24), 12.0)))
    loads(dt.datetime(2024, 1, 26, 2))
    before = lines(M.read_mart(spark, base, OBS))
    with monkeypatch.context() as m:
        m.setitem(K.REFERENCE_SUITE, OBS, [*K.REFERENCE_SUITE[OBS], K.accepted_range("temperature", 0, 10)])
        with pytest.raises(K.CheckFailed):
            M.catch_up(spark, raw, base)
    assert lines(M.read_mart(spark, base, OBS)) == before
    M.catch_up(spark, raw, base)
    check()
