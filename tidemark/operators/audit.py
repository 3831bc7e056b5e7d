"""Accounting for every record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import ON_TIME, REASON_LATE, REASON_MALFORMED


def reason_counts(dlq: DataFrame) -> DataFrame:
    """Dead letters per reason."""
    return dlq.groupBy("dlq_reason").agg(F.count("*").alias("records"))


def conservation(routed: DataFrame) -> DataFrame:
    """Counts of all places in one pass over `with_route`, and whether they add up."""

    def placed(*places: str):
        return F.count_if(F.col("route").isin(*places))

    counts = routed.agg(
        F.count("*").alias("n_in"),
        placed(ON_TIME, REASON_LATE).alias("n_valid"),
        placed(REASON_MALFORMED).alias("n_invalid"),
        placed(ON_TIME).alias("n_on_time"),
        placed(REASON_LATE).alias("n_late"),
        placed(REASON_LATE, REASON_MALFORMED).alias("n_dlq"),
    )
    return counts.withColumn(
        "conserved",
        (F.col("n_in") == F.col("n_valid") + F.col("n_invalid"))
        & (F.col("n_valid") == F.col("n_on_time") + F.col("n_late"))
        & (F.col("n_in") == F.col("n_on_time") + F.col("n_dlq")),
    )
