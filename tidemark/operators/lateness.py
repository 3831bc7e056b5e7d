"""The late cutoff that follows the data: greatest event time of earlier batches minus a delay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.times import earlier

BATCHES_PER_BLOCK = 65_536


def batch_cutoffs(
    events: DataFrame, batch: str = "batch_id", delay: str = "2 minutes"
) -> DataFrame:
    """One row per batch: ``cutoff`` from the batches before it, NULL for the first.

    Events shrink to a maximum per batch first. The running maximum is then taken in two levels,
    within blocks of batches and over the blocks, so that no task orders all batches: a block has at
    most `BATCHES_PER_BLOCK` rows, and a billion batches make some 15,000 blocks.
    """
    block = F.floor(F.col(batch) / BATCHES_PER_BLOCK)
    highs = (
        events.filter(F.col(batch).isNotNull())
        .groupBy(batch)
        .agg(F.max("event_time").alias("_high"))
        .withColumn("_block", block)
    )
    before = Window.orderBy(batch).partitionBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier_blocks = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        highs.groupBy("_block")
        .agg(F.max("_high").alias("_high"))
        .select("_block", F.max("_high").over(earlier_blocks).alias("_carried"))
    )
    seen = F.greatest(F.max("_high").over(before), F.col("_carried"))
    return highs.join(carried, "_block", "left").select(
        batch, earlier(seen, delay).alias("cutoff")
    )


def with_cutoff(
    events: DataFrame, batch: str = "batch_id", delay: str = "2 minutes"
) -> DataFrame:
    """Events with the ``cutoff`` of their batch.

    The cutoffs are one row per batch. No broadcast is forced: the size decides at run time, and
    beyond the limit a batch that holds most events is split by the adaptive skew join.
    """
    return events.join(batch_cutoffs(events, batch, delay), batch, "left")


def mark_late(
    events: DataFrame, batch: str = "batch_id", delay: str = "2 minutes"
) -> DataFrame:
    """`with_cutoff` plus ``is_late``; nothing is late in the first batch."""
    return with_cutoff(events, batch, delay).withColumn(
        "is_late", F.coalesce(F.col("event_time") < F.col("cutoff"), F.lit(False))
    )
