"""Putting right, from an archive of events, what a stream got wrong in its revenue table.

Days are compared first, by sums in which each window and category has a weight of its own: the sums of
the events and of the stored parts are equal if no window differs. They need one number per day, no
windows are formed for them, and an order of summing does not matter. Windows are then compared the same
way, on the differing days alone, and only differing windows are computed again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import beyond_cents, exact_cents, line_amount
from tidemark.functions.times import MICROS_A_DAY, day_of, interval_micros
from tidemark.operators.revenue import PART_FIELDS, revenue_parts, sales_only

DAY = "day"
_WEIGHTS = 1 << 30


def with_day(events: DataFrame) -> DataFrame:
    """Events with their ``day``, by which an archive is to be partitioned."""
    return events.withColumn(DAY, day_of("event_time"))


def _checked(window: str) -> str:
    length = interval_micros(window)
    if not length or MICROS_A_DAY % length:
        raise ValueError(f"windows of {window!r} do not tile a day")
    return window


def _event_rows(events: DataFrame, window: str) -> DataFrame:
    """Sales as if each were a part of its own: no grouping."""
    return sales_only(events).select(
        F.window("event_time", window)["start"].alias("window_start"),
        "category",
        exact_cents(line_amount()).alias("cents"),
        beyond_cents(line_amount()).alias("beyond"),
        F.lit(1).cast("bigint").alias("orders"),
    )


def _differing(events: DataFrame, parts: DataFrame, key: Column) -> DataFrame:
    """Keys in which events and stored parts do not weigh the same.

    Both sides meet in one aggregate with opposite signs. Amounts beyond exact cents have no sums that
    could be compared, so what holds one differs.
    """
    spelled = F.coalesce("category", F.lit("\0"))
    weight = (F.pmod(F.xxhash64("window_start", spelled), F.lit(_WEIGHTS)) + 1).cast("decimal(10,0)")

    def weighed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(
            key.alias("key"),
            (weight * F.col("cents").cast("decimal(27,0)") * sign).alias("cents"),
            (weight * F.col("orders").cast("decimal(20,0)") * sign).alias("orders"),
            F.col("beyond").isNotNull().alias("inexact"),
        )

    both = weighed(events, 1).unionByName(weighed(parts, -1)).groupBy("key")
    sums = both.agg(*[F.sum(c).alias(c) for c in ("cents", "orders")], F.max("inexact").alias("inexact"))
    same = (F.coalesce("cents", F.lit(0)) == 0) & (F.col("orders") == 0) & ~F.col("inexact")
    return sums.filter(~same).select("key")


def differing_days(events: DataFrame, parts: DataFrame, window: str = "1 hour") -> list[int]:
    """Days on which the stored parts are not what the events give; at most a number per day."""
    rows = _event_rows(events, _checked(window))
    found = _differing(rows, parts, day_of("window_start")).collect()
    return sorted(r.key for r in found if r.key is not None)


def repaired_parts(
    events: DataFrame, parts: DataFrame, days: Sequence[int], window: str = "1 hour"
) -> DataFrame:
    """The parts with every differing window of ``days`` computed anew, and ``repaired`` beside them.

    ``events`` has `DAY` as a column, best as the partition column of the archive: only these days are
    read. Windows that the events do not have go.
    """
    of_days = events.filter(F.col(DAY).isin(*days))
    stored = parts.filter(day_of("window_start").isin(*days))
    rows = _event_rows(of_days, _checked(window))
    wrong = _differing(rows, stored, F.col("window_start")).withColumnRenamed("key", "window_start")
    anew = revenue_parts(of_days, window).join(wrong, "window_start", "left_semi")
    kept = parts.join(wrong, "window_start", "left_anti")
    return (
        kept.select(*PART_FIELDS)
        .withColumn("repaired", F.lit(False))
        .unionByName(anew.select(*PART_FIELDS).withColumn("repaired", F.lit(True)))
    )
