"""Writes that die between their two steps leave the table whole, in batch and stream form."""

import os

import pytest
from pyspark.sql import types as T

from test_streams import NOW, at, doc, folders, forecasts, land, stations  # noqa: F401
from wxmesh.operators import ingest, publish
from wxmesh.streaming import incremental as S

SCHEMA = T.StructType([T.StructField("x", T.LongType())])


def values(spark, path):
    return sorted(r["x"] for r in publish.read(spark, path, SCHEMA).collect())


def numbers(spark, *xs):
    return spark.createDataFrame([(x,) for x in xs], SCHEMA)


def test_a_refresh_that_dies_leaves_the_old_table(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    assert values(spark, path) == []
    assert ingest.full_refresh(numbers(spark, 1, 2), path) and values(spark, path) == [1, 2]
    real = publish.switch
    monkeypatch.setattr(publish, "switch", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        ingest.full_refresh(numbers(spark, 3), path)
    assert values(spark, path) == [1, 2]
    monkeypatch.setattr(publish, "switch", real)
    assert ingest.full_refresh(publish.read(spark, path, SCHEMA).union(numbers(spark, 9)), path)  # from the table itself
    assert values(spark, path) == [1, 2, 9]
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) == 1  # nothing of the others is left


def test_a_folder_filled_by_other_means_is_read_and_then_replaced(spark, tmp_dir):
    numbers(spark, 5).write.parquet(f"{tmp_dir}/t")
    assert values(spark, f"{tmp_dir}/t") == [5]
    ingest.full_refresh(numbers(spark, 6), f"{tmp_dir}/t")
    assert values(spark, f"{tmp_dir}/t") == [6]


def test_a_forecast_run_that_dies_leaves_the_old_table(spark, stations, folders, monkeypatch):  # noqa: F811
    landing, table, ckpt = folders
    land(landing, "a.json", doc("S1", (at(13), 1.0), (at(3, 26), 2.0), (at(3, 28), 4.0)), doc("S2", (at(5, 26), 8.0)))
    S.run_forecasts_available_now(spark, landing, table, ckpt, stations, NOW)
    read = lambda: sorted((r["station_id"], r["temperature"]) for r in S.read_table_or_empty(spark, table, S.DATED).collect())
    old = read()
    land(landing, "b.json", doc("S1", (at(15, 26), 20.0), (at(3, 27), 30.0)))
    real = publish.switch
    monkeypatch.setattr(publish, "switch", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(Exception):
        S.run_forecasts_available_now(spark, landing, table, ckpt, stations, NOW)
    assert read() == old == [("S1", 1.0), ("S1", 2.0), ("S1", 4.0), ("S2", 8.0)]
    monkeypatch.setattr(publish, "switch", real)
    S.run_forecasts_available_now(spark, landing, table, ckpt, stations, NOW)
    assert read() == [("S1", 20.0), ("S1", 30.0), ("S2", 8.0)]
