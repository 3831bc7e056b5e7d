"""Typed events to topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import EVENT_FIELDS, SALE, STOCK


def event_key() -> Column:
    """Record key: order, else SKU, else event id. An empty text counts as absent."""
    return F.coalesce(
        F.nullif(F.col("order_id"), F.lit("")),
        F.nullif(F.col("sku"), F.lit("")),
        F.col("event_id"),
    )


def payload(columns: list[str]) -> Column:
    """Compact JSON with keys in order; a NULL field is left out."""
    return F.to_json(F.struct(*sorted(set(columns) & set(EVENT_FIELDS))))


def encode_records(events: DataFrame) -> DataFrame:
    """Events to ``key BINARY, value BINARY``, ready for a topic."""
    return events.select(
        event_key().cast("binary").alias("key"),
        payload(events.columns).cast("binary").alias("value"),
    )


def _typed(rows: DataFrame, event_type: str) -> DataFrame:
    present = [
        F.col(c).cast(EVENT_FIELDS[c]).alias(c)
        for c in rows.columns
        if c in EVENT_FIELDS and c != "event_type"
    ]
    return rows.select(F.lit(event_type).alias("event_type"), *present)


def build_events(sales: DataFrame, stock_moves: DataFrame) -> DataFrame:
    """One event table from a table of sales and a table of stock moves.

    Both must have ``event_id`` and the wire text ``ts``; a column one of them lacks is NULL there.
    """
    both = _typed(sales, SALE).unionByName(
        _typed(stock_moves, STOCK), allowMissingColumns=True
    )
    return both.select(
        *[
            F.col(c) if c in both.columns else F.lit(None).cast(dtype).alias(c)
            for c, dtype in EVENT_FIELDS.items()
        ]
    )
