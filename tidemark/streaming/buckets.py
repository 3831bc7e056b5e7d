"""Keyed state that is updated in place, bucket by bucket.

Keys are dealt into buckets by hash, a bucket is a partition of a parquet table, and a micro-batch
rewrites the buckets it touches with Spark's dynamic partition overwrite. Reading a bucket costs its
state and not its history, and the buckets to read are literals on the partition column.

Every bucket has two slots that take turns: a batch writes the slot its bucket does not stand in, so a
crash in the middle of a write harms nothing that counts. Which slot counts is told by a marker row
without a key, which holds the batch that wrote the slot: the newest one that is finished.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidemark.operators.state import last_changes, live_rows
from tidemark.schemas import DLQ_FIELDS, KEY, OP_DELETE, STATE_COLUMNS, ddl
from tidemark.streaming.folders import NONE, BatchTable, CommitLog, read_if_there
from tidemark.streaming.sinks import each_batch
from tidemark.streaming.state import LOG_FIELDS, latest_and_rejects

SLOT_FIELDS = {**LOG_FIELDS, "batch_id": "bigint", "written_by": "bigint"}


@dataclass(frozen=True)
class BucketedState:
    """State below ``path`` in so many ``buckets``; ``guard_stale`` as in `ChangeLog`.

    A bucket should be some tens of megabytes; a batch of few keys then rewrites few of them. Deletes
    are kept only with ``guard_stale``, where an older change could still arrive and must lose. The
    number of buckets belongs to the stored table.
    """

    path: str
    buckets: int = 64
    guard_stale: bool = False

    @property
    def commits(self) -> CommitLog:
        return CommitLog(f"{self.path}/finished")

    @property
    def dlq_table(self) -> BatchTable:
        return BatchTable(f"{self.path}/dead_letters", DLQ_FIELDS, self.commits, apart=True)

    @property
    def table(self) -> str:
        return f"{self.path}/state"

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _slots(self, spark: SparkSession, upto: int, buckets: Sequence[int] | None) -> DataFrame:
        """Rows of all slots written by batches up to one, in some buckets or all."""
        schema = f"{ddl(SLOT_FIELDS)}, bucket INT, slot INT"
        rows = None if upto == NONE else read_if_there(spark, self.table, schema)
        if rows is None:
            return spark.createDataFrame([], schema)
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(*buckets))
        return rows.filter(F.col("written_by") <= upto)

    def _standing(self, slots: DataFrame) -> DataFrame:
        """``bucket`` and the ``slot`` that counts: at most a row per bucket, by the marker rows."""
        markers = slots.filter(F.col(KEY).isNull())
        return markers.groupBy("bucket").agg(F.max_by("slot", "written_by").alias("slot"))

    def _held(self, spark: SparkSession, upto: int, buckets: Sequence[int] | None) -> DataFrame:
        """Deciding changes as of a batch, with their bucket and slot, markers left out."""
        slots = self._slots(spark, upto, buckets)
        standing = F.broadcast(self._standing(slots))  # a row per bucket at most
        return slots.filter(F.col(KEY).isNotNull()).join(standing, ["bucket", "slot"])

    def apply(self, records: DataFrame, batch_id: int) -> None:
        """Merge one micro-batch of topic records. Running it again writes the same slots again."""
        spark = records.sparkSession
        slot = self.commits.begin(spark, batch_id)
        with latest_and_rejects(records) as (latest, rejects):
            latest = latest.select(
                "*",
                F.lit(batch_id).cast("bigint").alias("batch_id"),
                self.bucket_of(F.col(KEY)).alias("bucket"),
            )
            self._rewrite(latest, batch_id)
            self.dlq_table.write(rejects, batch_id)
        self.commits.finish(spark, batch_id, slot)

    def _rewrite(self, latest: DataFrame, batch_id: int) -> None:
        spark = latest.sparkSession
        touched = [r.bucket for r in latest.select("bucket").distinct().collect()]  # at most `buckets`
        if not touched:
            return
        held = self._held(spark, batch_id - 1, touched).select(*latest.columns)
        decided = last_changes(held.unionByName(latest), "batch_id", self.guard_stale)
        if not self.guard_stale:
            decided = decided.filter(F.col("op") != OP_DELETE)
        marks = spark.range(self.buckets).select(F.col("id").cast("int").alias("bucket"))
        marks = marks.filter(F.col("bucket").isin(*touched))
        standing = self._standing(self._slots(spark, batch_id - 1, touched))
        turns = marks.join(standing, "bucket", "left").select(
            "bucket", (1 - F.coalesce("slot", F.lit(1))).alias("slot")
        )
        rows = decided.unionByName(marks, allowMissingColumns=True).join(F.broadcast(turns), "bucket")
        rows = rows.withColumn("written_by", F.lit(batch_id).cast("bigint"))
        (
            rows.select(*SLOT_FIELDS, "bucket", "slot")
            .repartition("bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket", "slot")
            .parquet(self.table)
        )

    def writer(self, records: DataFrame, checkpoint: str) -> DataStreamWriter:
        return each_batch(records, self.apply, checkpoint)

    def current(self, spark: SparkSession, keys: Sequence[str] | None = None) -> DataFrame:
        """The state, one row per live key; of some keys only their buckets are read."""
        newest, buckets = self.commits.newest(spark), None
        if keys is not None:
            asked = spark.createDataFrame([(k,) for k in keys], f"{KEY} string")
            buckets = sorted({r[0] for r in asked.select(self.bucket_of(F.col(KEY))).collect()})
        rows = live_rows(self._held(spark, newest, buckets)).select(*STATE_COLUMNS)
        return rows if keys is None else rows.filter(F.col(KEY).isin(*keys))

    def dlq(self, spark: SparkSession) -> DataFrame:
        return self.dlq_table.read(spark)
