"""One stream, its tables: revenue parts of the on-time events, the dead letters, and their replay."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidemark.functions.rows import first_per_key
from tidemark.functions.times import day_of, earlier
from tidemark.operators.decode import decode_with_raw
from tidemark.operators.replay import replayable_events
from tidemark.operators.revenue import (
    PART_FIELDS,
    merge_parts,
    revenue_parts,
    revenue_table,
    sliding_parts,
)
from tidemark.operators.route import dead_letters, on_time, with_route
from tidemark.schemas import DLQ_FIELDS, REASON_MALFORMED, REVENUE_FIELDS
from tidemark.streaming.folders import BatchTable, CommitLog
from tidemark.streaming.seen import SeenIds
from tidemark.streaming.sinks import each_batch


@dataclass(frozen=True)
class RoutedTables:
    """The output folders of a routed stream. A batch counts in all tables at once.

    Sums of sales are all that is kept of on-time events; on-time stock moves are only counted as
    routed. ``copies_within``: an event whose id was seen in an event of the same UTC day, at most that
    much older than the newest one, is a copy and is left out; malformed records are dead letters all
    the same.
    """

    path: str
    window: str = "1 minute"
    delay: str = "2 minutes"
    copies_within: str | None = None

    @property
    def commits(self) -> CommitLog:
        return CommitLog(f"{self.path}/finished")

    @property
    def parts_table(self) -> BatchTable:
        return BatchTable(f"{self.path}/revenue_parts", PART_FIELDS, self.commits)

    @property
    def dlq_table(self) -> BatchTable:
        return BatchTable(f"{self.path}/dead_letters", DLQ_FIELDS, self.commits, apart=True)

    @property
    def seen(self) -> SeenIds:
        return SeenIds(f"{self.path}/seen_ids")

    @property
    def replayed_table(self) -> BatchTable:
        """Parts of late events that were brought back, by the newest batch they came from."""
        return BatchTable(
            f"{self.path}/replayed_parts", PART_FIELDS, CommitLog(f"{self.path}/replays")
        )

    def apply(self, records: DataFrame, batch_id: int) -> None:
        """Route one micro-batch. All writes depend only on the batch and those before it, and
        replace their folder, so a replay after a crash gives the same tables. The mark with the
        greatest event time is written last and makes the batch count."""
        spark = records.sparkSession
        slot = self.commits.begin(spark, batch_id)
        self.replayed_table.commits.prepare(spark)
        micros = self.commits.high(spark, batch_id - 1)
        before = F.timestamp_micros(F.lit(micros).cast("bigint"))
        cutoff = None if micros is None else earlier(before, self.delay)
        with ExitStack() as held:
            routed = with_route(decode_with_raw(records, REVENUE_FIELDS), cutoff)
            routed = held.enter_context(_kept(routed))
            if self.copies_within is not None:
                fresh = self._without_copies(routed, batch_id, micros)
                routed = held.enter_context(_kept(fresh))
            valid = F.col("route") != REASON_MALFORMED
            self.dlq_table.write(dead_letters(routed), batch_id)
            self.parts_table.write(revenue_parts(on_time(routed), self.window), batch_id)
            if self.copies_within is not None:
                self.seen.write(routed.filter(valid), batch_id)
            seen = F.max(F.when(valid, F.col("event_time")))
            high = routed.agg(F.greatest(seen, before).alias("high"))
            self.commits.finish(spark, batch_id, slot, high)

    def _without_copies(self, routed: DataFrame, batch_id: int, micros: int | None) -> DataFrame:
        """Malformed records, and the first copy of every id not seen in an earlier batch.

        ``routed`` is kept, so its records are parsed once. Of the ids seen, only the days of this
        batch are read.
        """
        spark = routed.sparkSession
        malformed = F.col("route") == REASON_MALFORMED
        valid = routed.filter(~malformed).withColumn("_day", day_of("event_time"))
        fresh = first_per_key(valid, ["event_id", "_day"], ["event_time"])
        if batch_id > 0 and micros is not None:
            horizon = self._horizon(micros)
            days = [r[0] for r in valid.filter(F.col("event_time") >= horizon).select("_day").distinct().collect()]
            known = self.seen.read(spark, days, batch_id - 1).filter(F.col("event_time") >= horizon)
            known = known.select("event_id", F.col("day").alias("_day"))
            fresh = fresh.join(known, ["event_id", "_day"], "left_anti")
        return fresh.select(*routed.columns).unionByName(routed.filter(malformed))

    def _horizon(self, micros: int) -> Column:
        """Older ids than this are forgotten once ``micros`` is the newest event time."""
        return earlier(F.timestamp_micros(F.lit(micros).cast("bigint")), self.copies_within)

    def writer(self, records: DataFrame, checkpoint: str) -> DataStreamWriter:
        return each_batch(records, self.apply, checkpoint)

    def parts(self, spark: SparkSession) -> DataFrame:
        """Revenue parts of all batches and replays, one row per window and category."""
        both = self.parts_table.read(spark).unionByName(self.replayed_table.read(spark))
        return merge_parts(both)

    def revenue(self, spark: SparkSession) -> DataFrame:
        return revenue_table(self.parts(spark))

    def sliding(self, spark: SparkSession, window: str, slide: str) -> DataFrame:
        """Sliding revenue from the stored parts; both lengths must be multiples of ``window``."""
        return revenue_table(sliding_parts(self.parts(spark), window, slide))

    def dlq(self, spark: SparkSession) -> DataFrame:
        """Dead letters of all batches, with their ``batch_id``."""
        return self.dlq_table.read(spark)

    def replay(self, spark: SparkSession) -> int:
        """Bring the late events of the dead letters back into the revenue; the newest batch covered.

        What is added goes by that batch's id, and only dead letters after the last replay are read,
        so running it again, or again after a crash, adds nothing twice.
        """
        table = self.replayed_table
        done, newest = table.commits.newest(spark), self.commits.newest(spark)
        if newest > done:
            late = self.dlq_table.read(spark, newest).filter(F.col("batch_id") > done)
            slot = table.commits.begin(spark, newest)
            table.write(revenue_parts(replayable_events(late), self.window), newest)
            table.commits.finish(spark, newest, slot)
        return newest

    def fold(self, spark: SparkSession, upto: int) -> None:
        """Let one base per table stand for all batches up to a finished one.

        Parts are merged, also those of replays. Dead letters are put together under the batches they
        came from, those of earlier folds are not touched. Of the ids seen, those beyond the horizon are
        forgotten.
        """
        batch_id = F.lit(upto).cast("bigint").alias("batch_id")
        self.parts_table.fold(
            spark, upto, lambda rows: merge_parts(rows).select(*PART_FIELDS, batch_id)
        )
        self.dlq_table.fold(spark, upto)
        if self.copies_within is not None:
            micros = self.commits.high(spark, upto)
            self.seen.fold(spark, upto, None if micros is None else self._horizon(micros))
        replayed = self.replayed_table
        if upto < replayed.commits.newest(spark):
            replayed.fold(spark, upto, lambda rows: merge_parts(rows).select(*PART_FIELDS, batch_id))


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    """A table that is read more than once, on the executors' disks if need be."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
