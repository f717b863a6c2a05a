"""The physical plans keep the properties the design relies on at scale."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def plan_of(spark, name):
    df = entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_distance_join_is_an_equi_join(spark):
    plan = plan_of(spark, "distance_join_grid")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[_cx", plan)


def test_dedup_limits_before_the_shuffle(spark):
    plan = plan_of(spark, "stg_forecasts")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_station_map_ranks_with_partial_limit(spark):
    plan = plan_of(spark, "station_area_map")
    assert re.search(r"WindowGroupLimit \[postal_code#\d+\], \[dist#\d+ ASC NULLS FIRST\], dense_rank\(dist#\d+\), 10, Partial", plan)


def test_mart_has_no_window_over_whole_area_history(spark):
    plan = plan_of(spark, "hourly_forecasts")
    # the only windows are the per-(area, hour) best station pick
    for w in re.findall(r"Window \[[^\n]*", plan):
        assert "partitionby" not in w.lower() or "postal_code" in w
        assert "lag(" not in w
    assert "SortAggregate" not in plan


def test_cleaning_scans_the_raw_table_once(spark):
    # staged facts are checkpointed, so the cleaning plan reads them back
    plan = plan_of(spark, "cleaned_forecasts")
    assert "lineitem.parquet" not in plan


@pytest.mark.parametrize("name", ["surrogate_ids", "hourly_observations"])
def test_single_partition_only_for_bounded_offsets(spark, name):
    plan = plan_of(spark, name)
    for block in plan.split("Exchange SinglePartition")[1:]:
        # right below a single-partition exchange there is only the per-partition count
        assert "count(1)" in block.split("\n")[1] or "_pid" in block.split("\n")[1]


def test_station_side_is_the_broadcast_side(spark):
    """The size-checked station points are broadcast (build side); the areas
    stream through the join in their own partitions."""
    for name in ("station_area_map", "distance_join_grid"):
        plan = plan_of(spark, name)
        joins = re.findall(r"BroadcastHashJoin \[_cx#\d+L, _cy#\d+L\], \[_cx#\d+L, _cy#\d+L\], Inner, (Build\w+)", plan)
        assert joins == ["BuildLeft"], (name, joins)


def test_only_stations_near_an_area_reach_the_newest_row_step(spark):
    """C2 before E1: the raw rows are reduced by the candidate stations below the window, in either fact table."""
    from wxmesh.plans.catalog import Inputs

    i, whole = Inputs(spark, SF, near=True), Inputs(spark, SF)
    for name in ("stg_obs", "stg_fc"):
        plan = getattr(i, name)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Window [") < plan.index("LeftSemi")
        staged, every = getattr(i, name), getattr(whole, name)
        want = every.join(i.near_ids, "wmo_station_id", "left_semi").select(*every.columns)
        assert staged.exceptAll(want).isEmpty() and want.exceptAll(staged).isEmpty()
        assert 0 < staged.count() < every.count()
    mapped = whole.station_map.select("wmo_station_id")
    assert mapped.join(i.near_ids, "wmo_station_id", "left_anti").isEmpty()
