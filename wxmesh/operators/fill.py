"""Spine and one-step gap fill.

The reference fills a gap with ``coalesce(m, lag(m) over (partition by area
order by hour))`` over a spine of every area and every hour. Because every
area carries the same hour set, "the previous row of the area" is simply
(area, previous hour of the set). That turns the window into equi-joins on
``(area, hour)``: the work spreads over all (area, hour) keys instead of one
task per area, so a handful of areas with long histories does not serialise
the job. The fill stays one step: the previous row's *unfilled* value is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import previous_in_set
from .spatial_join import fits_broadcast

# Largest dimension side that may be broadcast to build a spine. A time is a
# fixed 8 bytes, so its rows bound its bytes; keys are measured in bytes too.
SPINE_BROADCAST_MAX_ROWS = 2_000_000
SPINE_BROADCAST_MAX_BYTES = 64 << 20


def spine(keys: DataFrame, times: DataFrame, max_broadcast_rows: int = SPINE_BROADCAST_MAX_ROWS,
          n_times: int | None = None) -> DataFrame:
    """C4: every key x every time; both inputs are distinct dimension sets.

    The product *is* the requested output (one row per area and hour). The
    smaller side is broadcast after its size is checked; only if both
    exceed the bound is a plain partitioned product used.
    """
    if n_times is None:
        n_times = times.count()
    if n_times <= max_broadcast_rows:
        return keys.crossJoin(F.broadcast(times))
    if fits_broadcast(keys, max_broadcast_rows, SPINE_BROADCAST_MAX_BYTES):
        return F.broadcast(keys).crossJoin(times)
    return keys.crossJoin(times)


def fill_from_previous(grid: DataFrame, values: DataFrame, key: str, order: str,
                       metrics: Sequence[str], prev_map: DataFrame | None = None,
                       broadcast_prev: bool = False) -> DataFrame:
    """Left join ``values`` onto ``grid`` and fill each metric once.

    ``grid`` holds every (key, order) pair, ``values`` at most one row per
    (key, order). ``prev_map`` (order, prev_order) is derived from the grid's
    order values when not given. ``broadcast_prev`` says the caller has
    checked that the order set (one row per slot) is small enough to
    broadcast; otherwise adaptive execution decides.

    ``values`` is read once: each row is emitted for its own slot and for the
    next slot of the order set, then one grouped aggregate on (key, order)
    (partial aggregation before the shuffle) puts the current and the
    previous value side by side, and one left join attaches them to the grid.
    """
    if prev_map is None:
        prev_map = previous_in_set(grid.select(order).distinct(), order, "_p")
    pm = prev_map.toDF("_next", "_p")
    if broadcast_prev:
        pm = F.broadcast(pm)
    slots = F.explode(F.array(
        F.struct(F.col(order).alias("_t"), F.lit(True).alias("_cur")),
        F.struct(F.col("_next").alias("_t"), F.lit(False).alias("_cur"))))
    tagged = (values.join(pm, F.col(order) == F.col("_p"), "left")
                    .select(key, slots.alias("_s"), *metrics)
                    .select(key, F.col("_s._t").alias(order), F.col("_s._cur").alias("_cur"), *metrics)
                    .filter(F.col(order).isNotNull()))
    pairs = tagged.groupBy(key, order).agg(
        *[F.max(F.when(F.col("_cur"), F.col(m))).alias(f"_cur_{m}") for m in metrics],
        *[F.max(F.when(~F.col("_cur"), F.col(m))).alias(f"_prv_{m}") for m in metrics])
    joined = grid.join(pairs, [key, order], "left")
    return joined.select(key, order, *[F.coalesce(f"_cur_{m}", f"_prv_{m}").alias(m) for m in metrics])
