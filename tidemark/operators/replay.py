"""Bringing late dead letters back into the revenue table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.decode import parse_events
from tidemark.operators.revenue import PART_KEYS, revenue_parts, sum_parts
from tidemark.operators.route import split_valid_invalid
from tidemark.schemas import REASON_LATE, REVENUE_FIELDS


def replayable_events(dlq: DataFrame) -> DataFrame:
    """Events of the dead letters that were rejected only for being late."""
    late = dlq.filter(F.col("dlq_reason") == REASON_LATE)
    records = late.select(F.col("raw_json").alias("value"))
    return split_valid_invalid(parse_events(records, REVENUE_FIELDS))[0]


def replay_late(parts: DataFrame, dlq: DataFrame, window: str = "1 minute") -> DataFrame:
    """New parts of every window that a late sale touches; other windows stay as they are.

    Sums are mergeable, so the on-time events are not read again: the table of parts and the parts of
    the late events meet in one aggregate.
    """
    recovered = revenue_parts(replayable_events(dlq), window)
    tagged = parts.withColumn("_late", F.lit(False)).unionByName(
        recovered.withColumn("_late", F.lit(True))
    )
    touched = sum_parts(tagged, *PART_KEYS, also=[F.max("_late").alias("_late")])
    return touched.filter("_late").drop("_late")
