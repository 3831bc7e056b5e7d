"""Topic records to typed rows.

The parsed struct is expanded with ``inline(array(...))`` and not with ``select("e.*")``. A filter on
a parsed field is then evaluated on the generated column; behind ``e.*`` the optimizer would push it
below the projection together with a second ``from_json`` for every field it mentions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import event_time
from tidemark.schemas import ENVELOPE_FIELDS, EVENT_FIELDS, ddl


def _expand_json(raw: DataFrame, fields: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    text = raw.select(*keep, F.col("value").cast("string").alias("raw_json"))
    parsed = F.from_json("raw_json", ddl(fields))
    return text.select(*keep, "raw_json", F.inline(F.array(parsed)))


def decode_with_raw(
    raw: DataFrame,
    fields: Mapping[str, str] = EVENT_FIELDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Records to event columns plus ``event_time`` and the payload as ``raw_json``.

    A payload that is not a JSON object, or a NULL one, gives NULL in every event column. A field of
    the wrong type gives NULL in that field only. ``fields`` narrows what is parsed (it must hold
    ``ts``); ``keep`` carries record columns such as ``offset`` through.
    """
    return _expand_json(raw, fields, keep).withColumn("event_time", event_time("ts"))


def parse_events(
    raw: DataFrame,
    fields: Mapping[str, str] = EVENT_FIELDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """`decode_with_raw` without the payload."""
    return decode_with_raw(raw, fields, keep).drop("raw_json")


def decode_changes(
    raw: DataFrame,
    fields: Mapping[str, str] = ENVELOPE_FIELDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Records to change envelopes with the payload, rejects included."""
    return _expand_json(raw, fields, keep)


def parse_cdc_events(
    raw: DataFrame,
    fields: Mapping[str, str] = ENVELOPE_FIELDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Records to change envelopes; records without an operation (tombstones, text) are left out.

    `tidemark.operators.changes.change_dead_letters` returns what is left out here. With
    ``CHANGE_FIELDS`` only what `tidemark.operators.changes.flatten_changes` reads is parsed.
    """
    return decode_changes(raw, fields, keep).drop("raw_json").filter(F.col("op").isNotNull())
