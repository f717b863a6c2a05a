"""Global order without a single-partition window.

``row_number() over (order by ...)`` with no ``partition by`` moves every row
into one task. The helpers here give the same answers with the work spread
over ``n`` range partitions:

1. range-partition by the order and sort inside each partition;
2. number rows inside each partition (``monotonically_increasing_id`` minus
   the partition's base) and write them with their partition and number, so
   both are fixed (range bounds come from sampling; two separately planned
   exchanges could cut differently);
3. count rows per partition and turn the counts into offsets. The offsets
   table has one row per partition, so its size is bounded by ``n`` (a
   setting, not the data) and it is broadcast.

The order must be total (add tie-break columns), so a retried task numbers
its rows the same way.

``numbered_in_place`` writes no rows: it fixes the cuts once, from the order
columns alone, and deals the rows to them by part number, which is the same in
every attempt of a task.

``dense_rank_within`` ranks inside groups in the same way, so that one large
group is spread over partitions too.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _parts(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ranged(df: DataFrame, n: int, cols: Sequence[Column]) -> DataFrame:
    """``df`` written in range partitions of ``cols`` with ``_pid`` and ``_local``, the position in it from 0."""
    from ..session import materialise

    return materialise(
        df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
          .withColumn("_pid", F.spark_partition_id())
          .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("bigint"), 33)), "ranged")


def range_part(key: str | Column, bounds: Sequence) -> Column:
    """The number of the range that ``key`` lies in: how many of the sorted ``bounds`` after the first are at or below it.

    A binary search as a column expression, so a row costs the logarithm of the number of bounds. A null lies in the first range.
    """
    key, later = F.col(key) if isinstance(key, str) else key, list(bounds)[1:]
    if not later:
        return F.lit(0)
    held, low, high = F.array(*map(F.lit, later)), F.lit(0).alias("low"), F.lit(len(later)).alias("high")

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        above = F.coalesce(F.get(held, middle) <= key, F.lit(False)) & (s["low"] < s["high"])
        return F.struct(F.when(above, middle + 1).otherwise(s["low"]).alias("low"),
                        F.when(above | (s["low"] >= s["high"]), s["high"]).otherwise(middle).alias("high"))

    steps = F.array(*[F.lit(k) for k in range(len(later).bit_length() + 1)])
    return F.aggregate(steps, F.struct(low, high), halve, lambda s: s["low"])


TREE_PARTS = 256  # beyond, the comparisons as one expression would be too large to plan and compile


def _part_of(key: Column, bounds: Sequence[Column]) -> Column:
    """As ``range_part``: the same binary search, for not too many bounds as nested conditions that are compiled with the plan."""
    def between(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        middle = (lo + hi + 1) // 2
        return F.when(bounds[middle] <= key, between(middle, hi)).otherwise(between(lo, middle - 1))

    return between(0, max(0, len(bounds) - 1)) if len(bounds) <= TREE_PARTS else range_part(key, bounds)


def _cuts(df: DataFrame, order: Sequence[str], n: int) -> list[tuple[Column, int]]:
    """At most ``n`` (lowest key, number of rows) of consecutive ranges, from the order columns; equal keys share a range.

    A key travels as text and is cast back, which every type that has an order
    and a text form survives; so the driver holds ``n`` short rows.
    """
    key = F.struct(*order)
    ranged = df.select(*order).repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    low = ranged.groupBy("_pid").agg(F.min(key).alias("_low"), F.count(F.lit(1)).alias("_n"))
    rows = low.select("_pid", "_n", *[F.col("_low")[c].cast("string").alias(f"_{i}") for i, c in enumerate(order)]).collect()
    types = {f.name: f.dataType for f in df.schema.fields}
    return [(F.struct(*[F.lit(r[f"_{i}"]).cast(types[c]).alias(c) for i, c in enumerate(order)]), r["_n"])
            for r in sorted(rows, key=lambda r: r["_pid"])]


def numbered_in_place(df: DataFrame, order: Sequence[str], out: str = "row_id", num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row in the total ``order`` (ascending, nulls first), without writing rows.

    One pass over the order columns fixes the cuts and counts the rows between
    them; the rows are dealt by their part number, sorted there, and numbered
    from the count of the rows in the parts before. Two passes read ``df``, so it
    must give the same rows each time. A binary column cannot be in the order.
    """
    order = list(order)
    if any(df.schema[c].dataType.typeName() == "binary" for c in order):
        raise ValueError("a binary column cannot be in the order")
    cuts = _cuts(df, order, _parts(df, num_partitions))
    before = list(accumulate((n for _, n in cuts[:-1]), initial=0))
    part = _part_of(F.struct(*order), [low for low, _ in cuts]).cast("int")
    local = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    dealt = (df.withColumn("_part", part).repartitionById(len(before), F.col("_part")).sortWithinPartitions(*order)
               .withColumn("_local", local))
    offset = F.get(F.array(*[F.lit(b).cast("bigint") for b in before]), F.col("_part"))
    return dealt.withColumn(out, offset + F.col("_local") + F.lit(1)).drop("_part", "_local")


def dense_row_number(df: DataFrame, order: Sequence[str | Column], out: str = "row_id",
                     num_partitions: int | None = None, start: int = 1) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order`` (like row_number)."""
    n = _parts(df, num_partitions)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = _ranged(df, n, cols)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .withColumn(out, F.col("_off") + F.col("_local") + F.lit(start))
                  .drop("_pid", "_local", "_off"))


def dense_rank_within(df: DataFrame, group: str, value: str, out: str,
                      num_partitions: int | None = None) -> DataFrame:
    """Distinct (``group``, ``value``) pairs with ``out`` = dense_rank of ``value`` in its group.

    A group may span range partitions: its ranks go on from the pairs it has in
    the partitions before. The counts have one row per group and partition it is
    in, so a join key never holds more than one partition's rows.
    """
    n = _parts(df, num_partitions)
    ranged = _ranged(df.select(group, value).distinct(), n, [F.col(group), F.col(value)])
    counts = ranged.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", group, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_off"))
    return (ranged.join(offsets, ["_pid", group])
                  .select(group, value, (F.col("_off") + F.col("_local") + F.lit(1)).cast("int").alias(out)))


def previous_in_set(values: DataFrame, col: str, prev_col: str | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """For each distinct value of ``col``: the next smaller distinct value.

    Gives the same pairs as ``lag(col) over (order by col)`` on the distinct
    values, as an equi-join on consecutive positions.
    """
    prev_col = prev_col or f"prev_{col}"
    distinct = values.select(col).filter(F.col(col).isNotNull()).distinct()
    idx = dense_row_number(distinct, [col], "_i", num_partitions)
    prev = idx.select(F.col(col).alias(prev_col), (F.col("_i") + 1).alias("_i"))
    return idx.join(prev, "_i", "left").select(col, prev_col)
