"""Stream sinks. Those that take a micro-batch write it under its id, so a replay overwrites it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidemark.schemas import ddl

BatchFunction = Callable[[DataFrame, int], None]


def console_writer(df: DataFrame, mode: str = "append") -> DataStreamWriter:
    """Print to the console: ``append`` for events, ``update`` for aggregates."""
    return df.writeStream.format("console").outputMode(mode).option("truncate", "false")


@dataclass(frozen=True)
class StreamFolder:
    """A folder that holds a stream's table and its checkpoint side by side.

    The two belong together: one without the other would lose or repeat rows.
    """

    path: str
    fmt: str = "parquet"

    @property
    def checkpoint(self) -> str:
        return f"{self.path}/checkpoint"

    @property
    def files(self) -> str:
        return f"{self.path}/table"

    def appended(self, df: DataFrame) -> DataStreamWriter:
        """Append finished rows as files."""
        sink = df.writeStream.format(self.fmt).option("checkpointLocation", self.checkpoint)
        return sink.option("path", self.files)

    def into(self, df: DataFrame, table: str) -> StreamingQuery:
        """Start appending to a table of a catalog, for example a lakehouse table."""
        sink = df.writeStream.format(self.fmt).option("checkpointLocation", self.checkpoint)
        return sink.toTable(table)

    def each_batch(self, df: DataFrame, apply: BatchFunction, mode: str = "append") -> DataStreamWriter:
        return each_batch(df, apply, self.checkpoint, mode)

    def read(self, spark: SparkSession, schema) -> DataFrame:
        return spark.read.schema(schema).format(self.fmt).load(self.files)


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there now, then stop; an error of the stream is raised here."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch. Running it again replaces the same folder."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, fields: Mapping[str, str]) -> DataFrame:
    """All micro-batches of `write_batch` with their ``batch_id``."""
    return spark.read.schema(f"{ddl(fields)}, batch_id BIGINT").parquet(path)


def each_batch(
    df: DataFrame, apply: BatchFunction, checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    """Hand every micro-batch to a function, with a checkpoint."""
    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(apply)
    )
