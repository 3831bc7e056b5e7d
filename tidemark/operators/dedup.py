"""Removing records that a producer sent more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rows import first_per_key


def dedup_events(
    events: DataFrame,
    order_by: Sequence[str] = ("event_time",),
    delay: str = "2 minutes",
    spread_copies: int | None = None,
) -> DataFrame:
    """One event per ``event_id``; events without an id are all kept.

    On a table the first copy in ``order_by`` stays, and copies shrink to one per task before the
    shuffle; a row without an id has a key of its own, so one aggregate serves both. On a stream the
    first copy to arrive stays and later ones within ``delay`` are dropped; rows without an id take a
    place in the state until the watermark has passed them, and rows later than that are dropped.

    ``spread_copies`` adds a step in front on streams, for ids with very many copies, since Spark does
    not combine there before its shuffle: copies first meet per id and one of that many groups of input
    tasks. It costs a second shuffle and a second state with every id within the delay.
    """
    own = F.when(F.col("event_id").isNull(), F.uuid())
    keyed = events.withColumn("_own", own)
    if not events.isStreaming:
        return first_per_key(keyed, ["event_id", "_own"], order_by).drop("_own")
    timed = keyed.withWatermark("event_time", delay)
    if spread_copies is not None:
        salted = timed.withColumn("_salt", F.spark_partition_id() % spread_copies)
        timed = salted.dropDuplicatesWithinWatermark(["event_id", "_own", "_salt"]).drop("_salt")
    return timed.dropDuplicatesWithinWatermark(["event_id", "_own"]).drop("_own")
