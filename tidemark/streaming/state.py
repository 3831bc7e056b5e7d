"""Keyed state kept by a change stream on plain parquet folders.

Each micro-batch adds its compacted changes under its id; the state is the last change per key. A
batch thus costs what it brings, and never a rewrite of the state. `ChangeLog.fold`, run from time to
time, keeps reading proportional to the state.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidemark.functions.rows import last_per_key
from tidemark.operators.changes import (
    change_key,
    flatten_changes,
    is_applicable,
    is_reject,
    reject_rows,
)
from tidemark.operators.decode import decode_changes
from tidemark.operators.state import last_changes, live_rows, merge_into_table
from tidemark.schemas import CHANGE_FIELDS, DLQ_FIELDS, KEY, OP_DELETE, ROW_FIELDS
from tidemark.streaming.folders import BatchTable, CommitLog
from tidemark.streaming.sinks import each_batch

LOG_FIELDS = {**ROW_FIELDS, "op": "string", "ts_ms": "bigint", "offset": "bigint"}


@contextmanager
def latest_and_rejects(records: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The last applicable change per key (`LOG_FIELDS`) and the dead letters of a micro-batch.

    The batch is decoded once and what is kept of it are its results: both leave in one aggregate, in
    which every reject is a group of its own.
    """
    if "offset" not in records.columns:
        records = records.withColumn("offset", F.lit(None).cast("bigint"))
    decoded = decode_changes(records, CHANGE_FIELDS, ["offset"])
    rejected = is_reject(change_key(), F.col("raw_json"))
    rows = decoded.withColumn("_reject", F.when(rejected, F.monotonically_increasing_id()))
    rows = rows.withColumn("raw_json", F.when(F.col("_reject").isNotNull(), F.col("raw_json")))
    rows = flatten_changes(rows, ["offset", "raw_json", "_reject"])
    rows = rows.filter(is_applicable(F.col(KEY)) | F.col("_reject").isNotNull())
    kept = last_per_key(rows, [KEY, "_reject"], ["ts_ms", "offset"])
    kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rejects = kept.filter(F.col("_reject").isNotNull())
        yield kept.filter(F.col("_reject").isNull()).select(*LOG_FIELDS), reject_rows(rejects, F.col(KEY))
    finally:
        kept.unpersist()


@dataclass(frozen=True)
class ChangeLog:
    """State below ``path``. ``guard_stale`` lets the change time decide across batches."""

    path: str
    guard_stale: bool = False

    @property
    def commits(self) -> CommitLog:
        return CommitLog(f"{self.path}/finished")

    @property
    def log(self) -> BatchTable:
        return BatchTable(f"{self.path}/log", LOG_FIELDS, self.commits)

    @property
    def dlq_table(self) -> BatchTable:
        return BatchTable(f"{self.path}/dead_letters", DLQ_FIELDS, self.commits, apart=True)

    def apply(self, records: DataFrame, batch_id: int) -> None:
        """Add one micro-batch of topic records; rejects go to the dead letters. Both count at once."""
        slot = self.commits.begin(records.sparkSession, batch_id)
        with latest_and_rejects(records) as (latest, rejects):
            self.log.write(latest, batch_id)
            self.dlq_table.write(rejects, batch_id)
        self.commits.finish(records.sparkSession, batch_id, slot)

    def writer(self, records: DataFrame, checkpoint: str) -> DataStreamWriter:
        return each_batch(records, self.apply, checkpoint)

    def current(self, spark: SparkSession) -> DataFrame:
        """The state: one row per live key."""
        return live_rows(last_changes(self.log.read(spark), "batch_id", self.guard_stale))

    def fold(self, spark: SparkSession, upto: int) -> None:
        """Let one base stand for all batches up to a finished one.

        Deletes stay in the base only where an older change could still arrive and must lose.
        """

        def last(rows: DataFrame) -> DataFrame:
            decided = last_changes(rows, "batch_id", self.guard_stale)
            return decided if self.guard_stale else decided.filter(F.col("op") != OP_DELETE)

        self.log.fold(spark, upto, last)
        self.dlq_table.fold(spark, upto)

    def dlq(self, spark: SparkSession) -> DataFrame:
        return self.dlq_table.read(spark)


def merge_writer(
    records: DataFrame, target: str, checkpoint: str, path: str
) -> DataStreamWriter:
    """Merge a change stream into a table of a catalog with row-level operations.

    Merging a compacted batch twice gives the same table, so a replay is harmless. Rejects go to the
    dead letters of a `ChangeLog` below ``path``.
    """
    kept = ChangeLog(path)

    def apply(batch: DataFrame, batch_id: int) -> None:
        slot = kept.commits.begin(batch.sparkSession, batch_id)
        with latest_and_rejects(batch) as (latest, rejects):
            merge_into_table(latest, target)
            kept.dlq_table.write(rejects, batch_id)
        kept.commits.finish(batch.sparkSession, batch_id, slot)

    return each_batch(records, apply, checkpoint)
