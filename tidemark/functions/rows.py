"""Picking one row per key by aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], pick) -> DataFrame:
    ranked = [*order_by, *sorted(set(df.columns) - set(keys) - set(order_by))]
    best = df.groupBy(*keys).agg(pick(F.struct(*ranked)).alias("_best"))
    return best.select(
        *[c if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` per key; NULL sorts lowest.

    An aggregate and not ``row_number``: each map task keeps one row per key before the shuffle, so
    a key that holds a third of all rows sends at most one row per task, and the same plan is legal
    on a stream. Remaining columns break ties, which makes the winner independent of partitioning.
    """
    return _one_per_key(df, keys, order_by, F.max)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the least ``order_by`` per key; otherwise as `last_per_key`."""
    return _one_per_key(df, keys, order_by, F.min)
