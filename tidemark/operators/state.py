"""Keyed state from changes: what MERGE does, as a plan that needs no row-level table format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rows import last_per_key
from tidemark.operators.changes import applicable_changes, latest_change_per_key
from tidemark.schemas import KEY, OP_DELETE, OP_READ, STATE_COLUMNS

VALUE_COLUMNS = tuple(c for c in STATE_COLUMNS if c != KEY)


def last_changes(
    log: DataFrame, batch: str | None = None, guard_stale: bool = False
) -> DataFrame:
    """The deciding change per key of a log, deletes included.

    With ``batch`` the later batch wins and time decides within a batch, as if each batch had been
    merged in turn. ``guard_stale`` puts time first, so an older change in a later batch loses.
    """
    order = ["ts_ms"] if batch is None else [batch, "ts_ms"]
    if guard_stale:
        order.sort(key=lambda c: c != "ts_ms")
    return latest_change_per_key(applicable_changes(log), order)


def live_rows(changes: DataFrame) -> DataFrame:
    """State rows of one change per key: everything that is not deleted."""
    return changes.filter(F.col("op") != OP_DELETE).select(*STATE_COLUMNS)


def fold_changes(
    log: DataFrame, batch: str | None = None, guard_stale: bool = False
) -> DataFrame:
    """The state a log of changes leads to, starting from nothing."""
    return live_rows(last_changes(log, batch, guard_stale))


def merge_changes(state: DataFrame, changes: DataFrame) -> DataFrame:
    """State after one batch: delete, update or insert by key.

    State rows and changes meet in one aggregate, any change beating the state row. Both sides shrink
    to a row per key and task before the only shuffle; there is no join that a hot key could skew.
    ``state`` has one row per key.
    """
    usable = applicable_changes(changes)
    order = [c for c in ("ts_ms", "offset") if c in usable.columns]
    base = state.select(*STATE_COLUMNS).withColumns(
        {"op": F.lit(OP_READ), "_change": F.lit(False)}
    )
    both = base.unionByName(
        usable.select(*STATE_COLUMNS, "op", *order).withColumn("_change", F.lit(True)),
        allowMissingColumns=True,
    )
    return live_rows(last_per_key(both, [KEY], ["_change", *order]))


def merge_into_table(changes: DataFrame, target: str) -> None:
    """Compact a batch and merge it into a table of a catalog with row-level operations."""
    source = latest_change_per_key(applicable_changes(changes)).alias("s")
    values = {c: F.col(f"s.{c}") for c in VALUE_COLUMNS}
    deleted = F.col("s.op") == OP_DELETE
    (
        source.mergeInto(target, F.expr(f"{target}.{KEY} = s.{KEY}"))
        .whenMatched(deleted)
        .delete()
        .whenMatched()
        .update(values)
        .whenNotMatched(~deleted)
        .insert({KEY: F.col(f"s.{KEY}"), **values})
        .merge()
    )
