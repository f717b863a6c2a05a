"""Numbers in a total order without a written copy of the rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wxmesh.operators.ingest import assign_ids
from wxmesh.operators.sequence import numbered_in_place

SCHEMA = "a string, b double, t timestamp_ntz, d date, n long"


def rows(n):
    r = random.Random(5)
    out = []
    for i in range(n):
        out.append((r.choice([None, "", "x", "é'\"\\", "x y", "hot", "hot", "hot", "hot"]), r.choice([None, float("-inf"), -0.5, 0.1 + 0.2, 1e300]),
                    None if i % 7 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=r.randrange(10**12)),
                    r.choice([None, dt.date(1969, 12, 31), dt.date(2024, 2, 29)]), i))
    return out


def in_order(row):
    return tuple((v is not None, "" if v is None else v) for v in row)


@pytest.mark.parametrize("n,parts", [(0, 4), (1, 4), (700, 1), (700, 5), (700, 64), (700, 300)])
def test_numbers_follow_the_order(spark, n, parts):
    data = rows(n)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = numbered_in_place(df, ["a", "b", "t", "d", "n"], "id", parts).collect()
    want = {row[4]: k for k, row in enumerate(sorted(data, key=in_order), 1)}
    assert {r["n"]: r["id"] for r in got} == want and len(got) == n


def test_no_rows_are_written_and_none_meet_in_one_task(spark, tmp_dir):
    spark.createDataFrame(rows(300), SCHEMA).write.parquet(f"{tmp_dir}/t")
    ids = assign_ids(spark.read.parquet(f"{tmp_dir}/t"), ["a", "n"], 10)
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and plan.count("FileScan") == 1 and f"{tmp_dir}/t" in plan
    assert [r[0] for r in ids.select("id").orderBy("id").collect()] == list(range(11, 311))


def test_ties_get_different_numbers_and_binary_is_refused(spark):
    df = spark.range(40).select(F.lit("same").alias("a"), F.lit(b"x").alias("raw"))
    assert sorted(r["id"] for r in numbered_in_place(df, ["a"], "id", 4).collect()) == list(range(1, 41))
    with pytest.raises(ValueError):
        numbered_in_place(df, ["raw"])
