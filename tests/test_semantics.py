"""Hand-written frames for the semantics that need exact control."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from wxmesh import schemas
from wxmesh.functions.geo import centroid
from wxmesh.operators import ingest as I
from wxmesh.plans import products as P


def H(h, day=1):
    return dt.datetime(2024, 1, day, h)


def square(x0, y0, size):
    return [(x0, y0), (x0 + size, y0), (x0 + size, y0 + size), (x0, y0 + size), (x0, y0)]


def areas_frame(spark, rows):
    """rows: (plz, [[ring, ...], ...]) with rings as lists of (x, y)."""
    data = [(plz, [[[{"x": x, "y": y} for x, y in ring] for ring in part] for part in geom])
            for plz, geom in rows]
    df = spark.createDataFrame(data, "plz string, geometry array<array<array<struct<x:double,y:double>>>>")
    return schemas.bind_by_name(df, schemas.AREAS)


def stations_frame(spark, rows):
    """rows: (id, wmo, lat, lon)."""
    data = [(i, w, lat, lon, dt.datetime(2025, 12, 1)) for i, w, lat, lon in rows]
    df = spark.createDataFrame(data, "id string, wmo_station_id string, lat double, lon double, "
                                     "last_record timestamp_ntz")
    return schemas.bind_by_name(df, schemas.STATIONS)


def obs_frame(spark, rows):
    """rows: (station_id, wmo, ts, temperature, precipitation, ingested_at)."""
    df = spark.createDataFrame(rows, "station_id string, wmo_station_id string, timestamp timestamp_ntz, "
                                     "temperature double, precipitation double, ingested_at timestamp_ntz")
    return schemas.bind_by_name(df, schemas.OBSERVATIONS)


def empty_fc(spark):
    return spark.createDataFrame([], schemas.FORECASTS)


def run_obs_mart(spark, stations, areas, obs):
    stg_s = P.stg_stations(stations)
    stg_a = P.stg_postal_codes(P.load_areas(areas))
    stg_o = P.stg_facts(obs, P.OBSERVATIONS)
    stg_f = P.stg_facts(empty_fc(spark), P.FORECASTS)
    m = P.station_area_map(stg_s, stg_a, stg_o, stg_f)
    mart = P.hourly_by_area(stg_o, m, stg_a, P.OBSERVATIONS)
    return m, {(r["postal_code"], r["observation_hour"]): r for r in mart.collect()}


@pytest.fixture
def one_area_two_stations(spark):
    stations = stations_frame(spark, [("S1", "W1", 52.5200, 13.4000), ("S2", "W2", 52.5300, 13.4000)])
    areas = areas_frame(spark, [("10115", [[square(13.3995, 52.5195, 0.001)]]),
                                ("10999", [[square(15.0, 52.52, 0.001)]])])
    ing = H(0, day=2)
    obs = obs_frame(spark, [
        ("S1", "W1", H(0), 1.0, 0.1, ing),
        ("S1", "W1", H(1), 2.0, None, ing),
        ("S2", "W2", H(1), 20.0, 0.9, ing),
        ("S1", "W1", H(2), None, None, ing),
        ("S1", "W1", H(3), 3.0, 0.3, ing),
        ("S1", "W1", H(5), None, None, ing),   # hour 4 is missing everywhere
        ("S1", "W1", H(6), None, None, ing),
    ])
    return stations, areas, obs


def test_fill_is_one_step_and_station_consistent(spark, one_area_two_stations):
    m, mart = run_obs_mart(spark, *one_area_two_stations)
    a = {h: (mart[("10115", H(h))]["temperature"], mart[("10115", H(h))]["precipitation"])
         for h in (0, 1, 2, 3, 5, 6)}
    assert a[0] == (1.0, 0.1)
    assert a[1] == (2.0, 0.1)        # nearest has temperature; precipitation from lag, not station 2
    assert a[2] == (2.0, None)       # first missing hour filled from the previous row
    assert a[3] == (3.0, 0.3)
    assert a[5] == (3.0, 0.3)        # hour 4 absent everywhere: the previous spine row is hour 3
    assert a[6] == (None, None)      # second missing hour in a row stays empty
    assert ("10115", H(4)) not in mart


def test_every_area_gets_every_hour(spark, one_area_two_stations):
    m, mart = run_obs_mart(spark, *one_area_two_stations)
    far = [v for k, v in mart.items() if k[0] == "10999"]
    assert len(far) == 6 and all(r["temperature"] is None for r in far)
    ranks = {r["wmo_station_id"]: r["station_rank"] for r in m.collect()}
    assert ranks == {"W1": 1, "W2": 2}


def test_null_wmo_collapses_and_never_maps(spark):
    ing = H(0, day=2)
    obs = obs_frame(spark, [("S7", None, H(1), 5.0, 0.0, ing), ("S8", None, H(1), 6.0, 0.0, ing)])
    stg = P.stg_facts(obs, P.OBSERVATIONS)
    assert stg.count() == 1
    stations = stations_frame(spark, [("S7", None, 52.52, 13.40), ("S8", None, 52.52, 13.40)])
    areas = areas_frame(spark, [("10115", [[square(13.3995, 52.5195, 0.001)]])])
    m = P.station_area_map(P.stg_stations(stations), P.stg_postal_codes(areas), stg,
                           P.stg_facts(empty_fc(spark), P.FORECASTS))
    assert m.count() == 0


def test_newest_row_wins(spark):
    obs = obs_frame(spark, [("S1", "W1", H(1), 1.0, 0.0, H(2)), ("S1", "W1", H(1), 9.0, 0.0, H(3))])
    rows = P.stg_facts(obs, P.OBSERVATIONS).collect()
    assert [r["temperature"] for r in rows] == [9.0]


def test_centroid_holes_parts_and_winding(spark):
    sq = square(0.0, 0.0, 4.0)
    hole = square(1.0, 1.0, 1.0)
    cases = {
        "hole_ccw": ([[sq, hole]], (30.5 / 15, 30.5 / 15)),
        "hole_cw": ([[sq, list(reversed(hole))]], (30.5 / 15, 30.5 / 15)),
        "shell_cw": ([[list(reversed(sq)), hole]], (30.5 / 15, 30.5 / 15)),
        "two_parts": ([[square(0, 0, 2)], [square(4, 0, 1)]], (1.7, 0.9)),
        "l_shape": ([[[(0, 0), (4, 0), (4, 1), (1, 1), (1, 3), (0, 3), (0, 0)]]], (1.5, 1.0)),
        "open_ring": ([[[(0, 0), (2, 0), (2, 2), (0, 2)]]], (1.0, 1.0)),
    }
    df = areas_frame(spark, [(k, [[[(float(x), float(y)) for x, y in ring] for ring in part]
                                  for part in g]) for k, (g, _) in cases.items()])
    got = {r["plz"]: r["c"] for r in df.select("plz", centroid("geometry").alias("c")).collect()}
    for k, (_, (cx, cy)) in cases.items():
        assert got[k]["x"] == pytest.approx(cx, abs=1e-12), k
        assert got[k]["y"] == pytest.approx(cy, abs=1e-12), k


def test_replace_future(spark):
    now = H(12)
    existing = spark.createDataFrame([
        (1, "S1", H(11), 1.0, H(0)), (2, "S1", H(13), 2.0, H(0)), (3, "S1", H(14), 3.0, H(0)),
        (4, "S2", H(13), 4.0, H(0)),
    ], "id bigint, station_id string, forecast_timestamp timestamp_ntz, temperature double, "
       "ingested_at timestamp_ntz")
    batch = spark.createDataFrame([
        (None, "S1", H(10), 9.0, None), (None, "S1", H(13), 5.0, None), (None, "S1", H(15), 6.0, None),
    ], existing.schema)
    out = {(r["station_id"], r["forecast_timestamp"]): r
           for r in I.replace_future(existing, batch, now).collect()}
    assert out[("S1", H(11))]["temperature"] == 1.0              # past row kept
    assert out[("S1", H(13))]["temperature"] == 5.0              # future row replaced
    assert ("S1", H(14)) not in out                              # future row of the station removed
    assert out[("S2", H(13))]["temperature"] == 4.0              # other station untouched
    assert ("S1", H(10)) not in out                              # batch rows in the past ignored
    assert {out[("S1", H(13))]["id"], out[("S1", H(15))]["id"]} == {5, 6}
    assert out[("S1", H(15))]["ingested_at"] == now


def test_high_water_marks(spark):
    now = H(12, day=31)
    existing = obs_frame(spark, [("S1", "W1", H(5, day=30), 1.0, 0.0, H(0, day=30))])
    batch = obs_frame(spark, [
        ("S1", "W1", H(5, day=30), 1.0, 0.0, None),      # equal to the mark: dropped
        ("S1", "W1", H(6, day=30), 2.0, 0.0, None),      # newer: kept
        ("S1", "W1", H(13, day=31), 3.0, 0.0, None),     # after now: dropped
        ("S2", "W2", dt.datetime(2023, 12, 31, 11), 4.0, 0.0, None),   # older than 30 days
        ("S2", "W2", dt.datetime(2024, 1, 2, 12), 5.0, 0.0, None),     # inside the backfill
    ])
    kept = sorted(r["temperature"] for r in I.incremental_rows(batch, existing, now).collect())
    assert kept == [2.0, 5.0]


def test_full_refresh_ignores_empty_batch(spark, tmp_dir):
    from wxmesh.operators import publish

    df = spark.range(3).withColumnRenamed("id", "x")
    assert I.full_refresh(df, tmp_dir)
    assert not I.full_refresh(df.filter(F.lit(False)), tmp_dir)
    assert publish.read(spark, tmp_dir, df.schema).count() == 3


def test_weather_json_edge_cases(spark, tmp_dir):
    from wxmesh.sources.landed import read_weather_json

    os.makedirs(tmp_dir, exist_ok=True)
    docs = [
        {"station_id": "S1", "weather": []},
        {"station_id": "S2", "weather": None},
        {"station_id": "S3", "weather": [{"timestamp": "2024-01-01T02:00:00+02:00", "temperature": 5,
                                          "relative_humidity": "72.0", "fallback_source_ids": {"a": 1}}]},
    ]
    with open(os.path.join(tmp_dir, "part-0.json"), "w") as f:
        f.write("\n".join(json.dumps(d) for d in docs))
    rows = read_weather_json(spark, tmp_dir).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["timestamp"] == dt.datetime(2024, 1, 1, 0, 0)
    assert r["temperature"] == 5.0 and r["relative_humidity"] == 72
    assert r["wind_speed"] is None
    assert json.loads(r["fallback_source_ids"]) == {"a": 1}


def test_geojson_and_station_readers(spark, tmp_dir):
    from wxmesh.sources.landed import read_geojson_areas, read_stations_json

    os.makedirs(tmp_dir, exist_ok=True)
    feats = [
        {"type": "Feature", "properties": {"postcode": "10115"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}},
        {"type": "Feature", "properties": {"postcode": "12000"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]],
                                                              [[[4, 0], [5, 0], [5, 1], [4, 1], [4, 0]]]]}},
        {"type": "Feature", "properties": {"postcode": "13000"}, "geometry": None},
        {"type": "Feature", "properties": {"postcode": "80331"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
    ]
    with open(os.path.join(tmp_dir, "areas.json"), "w") as f:
        f.write("\n".join(json.dumps(x) for x in feats))
    areas = read_geojson_areas(spark, tmp_dir, prefixes=P.AREA_PREFIXES)
    got = {r["plz"]: r["c"] for r in areas.select("plz", centroid("geometry").alias("c")).collect()}
    assert set(got) == {"10115", "12000"}
    assert got["12000"]["x"] == pytest.approx(1.7) and got["12000"]["y"] == pytest.approx(0.9)

    sdir = tmp_dir + "-stations"
    os.makedirs(sdir, exist_ok=True)
    with open(os.path.join(sdir, "s.json"), "w") as f:
        json.dump({"sources": [{"id": 123, "wmo_station_id": "10384", "lat": 52.47, "lon": 13.4,
                                "last_record": "2025-12-01T00:00:00+00:00", "observation_type": "historical"}]}, f)
    st = read_stations_json(spark, sdir).collect()
    assert st[0]["id"] == "123" and st[0]["last_record"] == dt.datetime(2025, 12, 1)


def test_append_binds_by_name_and_reads_with_declared_schema(spark, tmp_dir):
    base = tmp_dir + "/raw"
    batch = spark.createDataFrame(
        [("S1", "W1", dt.datetime(2024, 1, 1, 1), "72.0", [1, 2], "extra")],
        "station_id string, wmo_station_id string, timestamp timestamp_ntz, relative_humidity string, "
        "fallback_source_ids array<int>, junk string")
    bound = schemas.bind_by_name(batch, schemas.OBSERVATIONS, load_time="2024-01-02 00:00:00",
                                 load_time_column="ingested_at")
    I.append(bound, base + "/weather_observations")
    I.append(bound, base + "/weather_observations")
    rows = schemas.read_raw(spark, base, "weather_observations").collect()
    assert len(rows) == 2
    r = rows[0]
    assert r["relative_humidity"] == 72 and r["temperature"] is None
    assert json.loads(r["fallback_source_ids"]) == [1, 2]
    assert r["ingested_at"] == dt.datetime(2024, 1, 2)
    assert "junk" not in r.asDict()


def test_sorted_sink_reads_back_in_key_order(spark, tmp_dir):
    import random

    vals = [(random.Random(i).choice("abc"), i) for i in range(500)]
    df = spark.createDataFrame(vals, "k string, h int")
    bounds = I.range_bounds(df, "k", 4)
    assert bounds[0] == "a" and bounds == sorted(set(bounds))
    I.write_sorted(df, tmp_dir + "/sorted", ["k", "h"], bounds)
    back = [(r["k"], r["h"]) for r in spark.read.parquet(tmp_dir + "/sorted").collect()]
    assert sorted(back) == sorted(vals)
    files = spark.read.parquet(tmp_dir + "/sorted").select(F.input_file_name().alias("f"), "k", "h")
    per_file = {}
    for r in files.collect():
        per_file.setdefault(r["f"], []).append((r["k"], r["h"]))
    for rows in per_file.values():
        assert rows == sorted(rows)
    ends = [(rows[0], rows[-1]) for _, rows in sorted(per_file.items())]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:])) and len(ends) == len(bounds)


def test_command_line_pipeline(spark, tmp_dir):
    """``python -m wxmesh pipeline`` over raw tables stored with their declared schemas."""
    from wxmesh.__main__ import main
    from wxmesh.sources import fixtures as fx

    sf = "/root/testdata/sf0.001"
    raw = tmp_dir + "/raw"
    for name, df in (("weather_stations", fx.raw_stations(spark, sf)), ("postal_codes", fx.raw_postal(spark, sf)),
                     ("weather_observations", fx.raw_obs(spark, sf)), ("weather_forecasts", fx.raw_fc(spark, sf))):
        schemas.bind_by_name(df, schemas.RAW[name]).write.parquet(f"{raw}/{name}")
    out = tmp_dir + "/marts"
    assert main(["pipeline", "--raw", raw, "--out", out,
                 "--allow", "stg_observations:not_null(wmo_station_id)",
                 "--allow", "stg_forecasts:not_null(wmo_station_id)"]) == 0
    assert spark.read.parquet(out + "/hourly_observations").count() == 6720
    assert spark.read.parquet(out + "/hourly_forecasts").count() == 5040


def test_route_keys_direct_nearest_and_unrouted(spark):
    """WMO id if present, else the nearest place with one, else null."""
    sources = stations_frame(spark, [("A", "W1", 52.52, 13.40), ("B", None, 52.53, 13.40),
                                     ("C", None, 10.0, 10.0), ("E", None, None, 13.0), ("F", None, -52.5, -166.6)])
    cands = stations_frame(spark, [("A", "W1", 52.52, 13.40), ("D", "W2", 52.60, 13.40)])
    got = {r["station_id"]: (r["route_key"], r["route_dist"])
           for r in I.route_keys(sources, cands).collect()}
    assert got["A"] == ("W1", 0.0)
    assert got["B"][0] == "W1" and 1000 < got["B"][1] < 1200
    assert got["C"][0] == "W1" and 4_700_000 < got["C"][1] < 4_750_000      # however far
    assert got["F"][0] in ("W1", "W2") and got["F"][1] > 19_900_000         # the other side of the globe
    assert got["E"] == (None, None)                                          # no coordinates
    assert {r["route_key"] for r in I.route_keys(sources.filter("id = 'C'"), cands.limit(0)).collect()} == {None}


def test_forecast_window_and_discovery_radius(spark):
    now = dt.datetime(2024, 2, 5, 12)
    fc = spark.createDataFrame([(now,), (now + dt.timedelta(hours=1),), (now + dt.timedelta(days=10),),
                                (now + dt.timedelta(days=10, seconds=1),)], "forecast_timestamp timestamp_ntz")
    kept = sorted(r[0] for r in I.forecast_window(fc, now).collect())
    assert kept == [now + dt.timedelta(hours=1), now + dt.timedelta(days=10)]

    # 50 km around (52.52, 13.40): 0.44 deg north is about 48.9 km, 0.46 deg about 51.2 km
    st = stations_frame(spark, [("in", "W1", 52.96, 13.40), ("out", "W2", 52.98, 13.40),
                                ("far_east", "W3", 52.52, 14.20)])
    got = {r["id"]: r["distance"] for r in I.stations_in_radius(st).collect()}
    assert set(got) == {"in"} and 48000 < got["in"] < 50000


def test_gate_stops_the_pipeline_before_dependants(spark, tmp_dir):
    """K5: the sf0.01 fixture data breaks a staging not-null rule on purpose
    (343 null WMO ids; at sf0.001 there are none); without allowing it, the
    run stops and no mart is written."""
    import os as _os

    from wxmesh.operators.checks import CheckFailed
    from wxmesh.plans.pipeline import run_pipeline
    from wxmesh.sources import fixtures as fx

    sf = "/root/testdata/sf0.01"
    out = tmp_dir + "/marts"
    with pytest.raises(CheckFailed, match="stg_observations: not_null\\(wmo_station_id\\)"):
        run_pipeline(spark, fx.raw_stations(spark, sf), fx.raw_postal(spark, sf), fx.raw_obs(spark, sf),
                     fx.raw_fc(spark, sf), out)
    assert not _os.path.exists(out)


def test_wkt_shapes(spark):
    """H7: rings, holes, parts, a third coordinate, exponents; null for anything else."""
    from wxmesh.functions.geo import from_wkt

    rows = spark.createDataFrame([
        ("POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))",), ("multipolygon(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))",),
        ("POLYGON Z ((1e1 -2.5 7, 3 4 7, 5 6 7, 1e1 -2.5 7))",), ("POINT (1 2)",), ("POLYGON EMPTY",), ("",), (None,)], "t string")
    got = [r[0] for r in rows.select(from_wkt("t")).collect()]
    shape = lambda g: [[[(p["x"], p["y"]) for p in ring] for ring in part] for part in g]
    assert shape(got[0]) == [[[(0, 0), (4, 0), (4, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)]]]
    assert shape(got[1]) == [[[(0, 0), (1, 0), (1, 1), (0, 0)]], [[(5, 5), (6, 5), (6, 6), (5, 5)]]]
    assert shape(got[2]) == [[[(10, -2.5), (3, 4), (5, 6), (10, -2.5)]]]
    assert got[3:] == [None] * 4


def test_a_reader_accounts_for_every_feature_and_station(spark, tmp_dir):
    from wxmesh.sources import landed

    with open(tmp_dir + "/s.json", "w") as f:
        f.write('{"sources": [{"id": "A", "lat": 1.5, "lon": "x"}, {"lat": 2}, null]}\n{"sources": []}\n{"other": 1}\nnot json\n\n')
    rows, rejects = landed.read_stations(spark, tmp_dir + "/s.json", "2024-01-01 00:00:00")
    got = rows.collect()
    assert [(r["id"], r["lat"], r["lon"], r["created_at"]) for r in got] == [("A", 1.5, None, dt.datetime(2024, 1, 1))]
    assert sorted(r["reason"] for r in rejects.collect()) == ["malformed document", "no sources", "no station id", "no station id"]


def test_box_crosses_the_antimeridian_and_the_pole(spark):
    """Stations that a plain longitude range would lose."""
    st = stations_frame(spark, [("wrap", "W1", 0.0, -179.95), ("same", "W2", 0.0, 179.8), ("far", "W3", 0.0, -178.0),
                                ("pole", "W4", 89.9, -170.0)])
    assert {r["id"] for r in I.stations_in_radius(st, (0.0, 179.9)).collect()} == {"wrap", "same"}
    assert {r["id"] for r in I.stations_in_radius(st, (0.0, -179.9)).collect()} == {"wrap", "same"}
    assert {r["id"] for r in I.stations_in_radius(st, (89.9, 13.4)).collect()} == {"pole"}
