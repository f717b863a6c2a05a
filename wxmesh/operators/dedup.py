"""Newest-row and canonical-value operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                    rank_col: str = "_rn") -> DataFrame:
    """Keep the first row per ``keys`` under a total ``order`` (QUALIFY ... = 1).

    Written as ``row_number() <= 1`` so Catalyst inserts a partial
    ``WindowGroupLimit`` before the shuffle: each map task forwards at most one
    row per key, which also tames keys holding a large share of the rows.
    Null keys form one group, as in SQL ``PARTITION BY``.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) <= 1)
              .drop(rank_col))


def latest_wins(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """The newest row per key; later columns of ``newest_first`` break ties."""
    return first_per_group(df, keys, [F.col(c).desc_nulls_last() for c in newest_first])


def canonical_first(df: DataFrame, partition: str, order: str, value: Column, out: str) -> DataFrame:
    """Every row gets the value of the first row (by ``order``) of its
    group; no row is dropped.

    Same answer as ``first(value) over (partition by .. order by ..)`` with
    the default frame, but as a grouped ``min_by`` (partial aggregation
    before the shuffle, so a group holding a large share of the rows is
    reduced map-side) joined back on the key; adaptive execution broadcasts
    the one-row-per-key side or splits a skewed join partition.
    """
    firsts = (df.groupBy(F.col(partition).alias("_key"))
                .agg(F.min_by(value, F.col(order)).alias(out)))
    # null-safe: a null key is one group, as in PARTITION BY
    return (df.join(firsts, F.col(partition).eqNullSafe(F.col("_key")), "left")
              .drop("_key"))
