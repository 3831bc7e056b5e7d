"""Topics as DataFrames of ``key, value`` records, from a broker or from files.

A file topic is a directory of parquet files with the same binary columns. Everything downstream only
reads ``value``, so either kind feeds the same operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RECORD_FIELDS = "key BINARY, value BINARY, offset BIGINT"


def read_topic(spark: SparkSession, fmt: str, schema: str | None = None, **options) -> DataFrame:
    """A stream of records from any source that yields ``value``."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load()


def read_kafka_stream(
    spark: SparkSession, bootstrap_servers: str, topic: str, **options
) -> DataFrame:
    """Subscribe to a topic from its earliest offset. Needs Spark's Kafka connector.

    Bound a micro-batch with ``maxOffsetsPerTrigger``.
    """
    return read_topic(
        spark,
        "kafka",
        **{
            "kafka.bootstrap.servers": bootstrap_servers,
            "subscribe": topic,
            "startingOffsets": "earliest",
            **options,
        },
    )


def read_file_topic(spark: SparkSession, path: str, **options) -> DataFrame:
    """The records of a file topic as a stream; bound a micro-batch with ``maxBytesPerTrigger``."""
    return read_topic(spark, "parquet", RECORD_FIELDS, path=path, **options)


def _counted(records: DataFrame) -> tuple[DataFrame, Observation]:
    """Records that count themselves while they are written, without a job of their own."""
    observed = Observation()
    return records.observe(observed, F.count("*").alias("sent")), observed


def publish(records: DataFrame, path: str) -> int:
    """Append records to a file topic and return how many. A missing offset is NULL."""
    columns = [
        F.col(c) if c in records.columns else F.lit(None).cast(t).alias(c)
        for c, t in (f.split() for f in RECORD_FIELDS.split(", "))
    ]
    counted, observed = _counted(records.select(*columns))
    counted.write.mode("append").parquet(path)
    return observed.get["sent"]


def publish_kafka(records: DataFrame, bootstrap_servers: str, topic: str) -> int:
    """Send records to a broker topic and return how many.

    The key decides the partition, which keeps a key in order. A retried task sends again, so readers
    that need each event once use `tidemark.operators.dedup.dedup_events`.
    """
    counted, observed = _counted(records.select("key", "value"))
    (
        counted.write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )
    return observed.get["sent"]
