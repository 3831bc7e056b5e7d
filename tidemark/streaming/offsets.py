"""Which offsets of a topic a stream has read: holes and pieces that came twice.

The checkpoint says where a stream stands, not whether the topic was whole. A ledger keeps the runs of
consecutive offsets of every micro-batch; between all runs there must be no gap and no overlap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidemark.streaming.folders import BatchTable, CommitLog
from tidemark.streaming.sinks import each_batch

RUN_FIELDS = {"partition": "int", "first": "bigint", "last": "bigint", "records": "bigint"}
# Kinds of findings.
GAP = "gap"
OVERLAP = "overlap"
OFFSETS_PER_BLOCK = 65_536


def offset_runs(records: DataFrame) -> DataFrame:
    """Runs of consecutive offsets: ``partition``, ``first``, ``last``, ``records`` (copies included).

    Offsets are put in order within blocks only, where a number that stays equal along a run tells runs
    apart; runs that touch across blocks are then joined, one row per run and block.
    """
    partition = F.col("partition") if "partition" in records.columns else F.lit(0)
    block = F.floor(F.col("offset") / OFFSETS_PER_BLOCK)
    once = (
        records.select(partition.cast("int").alias("partition"), "offset")
        .groupBy("partition", "offset")
        .agg(F.count("*").alias("records"))
        .withColumn("block", block)
    )
    in_block = Window.partitionBy("partition", "block").orderBy("offset")
    runs = (
        once.withColumn("run", F.col("offset") - F.row_number().over(in_block))
        .groupBy("partition", "block", "run")
        .agg(
            F.min("offset").alias("first"),
            F.max("offset").alias("last"),
            F.sum("records").alias("records"),
        )
    )
    in_order = Window.partitionBy("partition").orderBy("first")
    apart = F.coalesce(F.col("first") - F.lag("last").over(in_order) != 1, F.lit(True))
    numbered = runs.withColumn("apart", apart.cast("int"))
    joined = numbered.withColumn("run", F.sum("apart").over(in_order))
    return (
        joined.groupBy("partition", "run")
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.sum("records").alias("records"),
        )
        .select(*RUN_FIELDS)
    )


def findings(runs: DataFrame) -> DataFrame:
    """Gaps and overlaps between runs (with ``batch_id``): ``partition``, ``kind``, ``first``, ``last``.

    An overlap names the batch that brought offsets again, a gap the batch behind it.
    """
    in_order = Window.partitionBy("partition").orderBy("first", "batch_id", "last")
    reached = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    placed = runs.withColumn("reached", reached)
    gap = placed.filter(F.col("first") > F.col("reached") + 1).select(
        "batch_id", "partition", F.lit(GAP).alias("kind"),
        (F.col("reached") + 1).alias("first"), (F.col("first") - 1).alias("last"),
    )
    overlap = placed.filter(F.col("first") <= F.col("reached")).select(
        "batch_id", "partition", F.lit(OVERLAP).alias("kind"),
        "first", F.least("last", "reached").alias("last"),
    )
    return gap.unionByName(overlap)


@dataclass(frozen=True)
class OffsetLedger:
    """Runs of all micro-batches below ``path``. ``strict`` refuses a batch that brings offsets again."""

    path: str
    strict: bool = False

    @property
    def table(self) -> BatchTable:
        return BatchTable(f"{self.path}/runs", RUN_FIELDS, CommitLog(f"{self.path}/finished"))

    def apply(self, records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        slot = self.table.commits.begin(spark, batch_id)
        self.table.write(offset_runs(records), batch_id)
        if self.strict:
            again = self.again(spark, batch_id)
            if again is not None:
                raise ValueError(f"{self.path}: batch {batch_id} brings offsets {again} again")
        self.table.commits.finish(spark, batch_id, slot)

    def again(self, spark: SparkSession, batch_id: int) -> tuple[int, int] | None:
        """The first offsets of a batch that an earlier batch has."""
        runs = self.table.read(spark, batch_id)
        found = findings(runs).filter((F.col("kind") == OVERLAP) & (F.col("batch_id") == batch_id))
        first = found.orderBy("partition", "first").first()
        return None if first is None else (first["first"], first["last"])

    def writer(self, records: DataFrame, checkpoint: str) -> DataStreamWriter:
        return each_batch(records, self.apply, checkpoint)

    def findings(self, spark: SparkSession) -> DataFrame:
        return findings(self.table.read(spark))
