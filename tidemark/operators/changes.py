"""Change envelopes to flat changes, compaction, rejects and the report of old and new values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rows import last_per_key
from tidemark.operators.decode import decode_changes
from tidemark.schemas import CHANGE_FIELDS, KEY, KNOWN_OPS, REASON_MALFORMED, ROW_FIELDS


def change_key() -> Column:
    """The key of an envelope: from the new image, for a delete from the old one."""
    return F.coalesce(F.col(f"after.{KEY}"), F.col(f"before.{KEY}"))


def flatten_changes(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per change: key, new values (NULL for a delete), operation, time."""
    values = [F.col(f"after.{c}").alias(c) for c in ROW_FIELDS if c != KEY]
    return events.select(change_key().alias(KEY), *values, "op", "ts_ms", *keep)


def is_applicable(key: Column) -> Column:
    """A change can be applied if it names a row and its operation is known. Never NULL."""
    return F.coalesce(F.col("op").isin(*KNOWN_OPS), F.lit(False)) & key.isNotNull()


def applicable_changes(changes: DataFrame) -> DataFrame:
    """Flat changes without those that name no row (truncate, message events)."""
    return changes.filter(is_applicable(F.col(KEY)))


def is_reject(key: Column, payload: Column) -> Column:
    """A record is one unless its change can be applied or it is a tombstone (NULL payload). Never NULL.

    One condition on parsed fields: a separate test of the payload would move below the parse and
    compute a derived payload a second time.
    """
    return F.when(payload.isNull(), F.lit(False)).otherwise(~is_applicable(key))


def reject_rows(rejects: DataFrame, key: Column) -> DataFrame:
    """Rejected records as dead-letter rows."""
    return rejects.select(
        F.coalesce(key, F.lit("unknown")).alias("event_id"),
        "raw_json",
        F.lit(REASON_MALFORMED).alias("dlq_reason"),
    )


def change_rejects(decoded: DataFrame) -> DataFrame:
    """Dead-letter rows of `decode_changes`."""
    return reject_rows(decoded.filter(is_reject(change_key(), F.col("raw_json"))), change_key())


def change_dead_letters(raw: DataFrame) -> DataFrame:
    """Dead-letter rows of a change topic."""
    return change_rejects(decode_changes(raw, CHANGE_FIELDS))


def latest_change_per_key(
    changes: DataFrame, order_by: Sequence[str] = ("ts_ms",), tie_break: Sequence[str] = ("offset",)
) -> DataFrame:
    """The last change per key; a delete may be the last.

    ``tie_break`` columns are used where the input has them, so equal times resolve by log order.
    """
    order = [*order_by, *[c for c in tie_break if c in changes.columns]]
    return last_per_key(changes, [KEY], order)


def value_changes(envelopes: DataFrame, field: str, keep: Sequence[str] = ()) -> DataFrame:
    """Old and new value of one field for every change that altered it."""
    old, new = F.col(f"before.{field}"), F.col(f"after.{field}")
    return envelopes.filter(~old.eqNullSafe(new)).select(
        change_key().alias(KEY), "op", "ts_ms", *keep, old.alias("old_value"), new.alias("new_value")
    )
