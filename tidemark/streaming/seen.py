"""Ids of events that were seen, by the event's day, so that a batch reads the ids of its own days only.

What is read does not grow with how far back ids are remembered, nor with the number of days. Ids are a
set: the same one in two folders, as after a fold, changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import day_of
from tidemark.streaming.folders import read_if_there

SEEN = "event_id STRING, event_time TIMESTAMP, day INT, batch_id BIGINT"


@dataclass(frozen=True)
class SeenIds:
    """Folders ``day=.../batch_id=...`` below ``path``; folded ones have negative batch ids."""

    path: str

    def _write(self, rows: DataFrame) -> None:
        (
            rows.select("event_id", "event_time", "day", "batch_id")
            .repartition("day")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch_id")
            .parquet(self.path)
        )

    def write(self, events: DataFrame, batch_id: int) -> None:
        """Add the ids of one micro-batch; running it again replaces the same folders."""
        number = F.lit(batch_id).cast("bigint")
        self._write(events.withColumns({"day": day_of("event_time"), "batch_id": number}))

    def _read(self, spark: SparkSession, upto: int) -> DataFrame:
        rows = read_if_there(spark, self.path, SEEN)
        if rows is None:
            return spark.createDataFrame([], SEEN)
        return rows.filter(F.col("batch_id") <= upto)

    def read(self, spark: SparkSession, days: Sequence[int], upto: int) -> DataFrame:
        """Ids of some days, as of a batch. The days are literals: folders of others are not read."""
        return self._read(spark, upto).filter(F.col("day").isin(*days))

    def fold(self, spark: SparkSession, upto: int, horizon: Column | None) -> None:
        """One folder a day for the ids of all batches up to one.

        It has a number of its own and replaces no folder that counts; those of the batches, and days
        before the horizon, can then be removed.
        """
        rows = self._read(spark, upto)
        if horizon is not None:
            rows = rows.filter(F.col("event_time") >= horizon)
        folded = rows.groupBy("event_id", "day").agg(F.max("event_time").alias("event_time"))
        self._write(folded.withColumn("batch_id", F.lit(-2 - upto).cast("bigint")))
