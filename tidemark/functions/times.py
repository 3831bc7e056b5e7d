"""Instants, their text on the wire, and interval strings.

Instants are ``TIMESTAMP`` inside the library. Text and ``TIMESTAMP_NTZ`` output is always UTC,
whatever the session zone is. ``to_utc_timestamp`` and ``date_format`` are avoided on purpose: both
pass through a local wall clock, which is wrong in the hour a zone skips or repeats.
"""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length of the units an interval string may use, in microseconds.
_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
MICROS_A_DAY = _UNIT_MICROS["day"]

_FULL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?"
_ZONED = _FULL + r"(Z|[+-][0-9]{2}:[0-9]{2})$"
_BARE = _FULL + "$"


def utc_wall_clock(ts: Column | str) -> Column:
    """``TIMESTAMP`` to the UTC wall clock as ``TIMESTAMP_NTZ``."""
    micros = F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return epoch + F.expr("INTERVAL '0.000001' SECOND") * micros


def wire_text(ts: Column | str) -> Column:
    """``TIMESTAMP`` to ``yyyy-MM-ddTHH:mm:ssZ``; fractions of a second are cut off."""
    text = utc_wall_clock(ts).cast("string")
    return F.concat(
        F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("Z")
    )


def event_time(ts: Column | str) -> Column:
    """Text to ``TIMESTAMP``: a full date and time, with a zone or else in UTC.

    Anything else is NULL. Spark alone would complete a bare time by the day of the run, and read a
    text without a zone in the session's.
    """
    text = F.col(ts) if isinstance(ts, str) else ts
    zoned = F.when(text.rlike(_ZONED), text).when(text.rlike(_BARE), F.concat(text, F.lit("Z")))
    return F.try_to_timestamp(zoned)


def instant(value: Column | datetime | str) -> Column:
    """A cutoff as a column. A datetime or a text without a zone is taken as UTC."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        aware = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
        value = aware.astimezone(timezone.utc).isoformat()
    if not re.search(f"{_ZONED}|{_BARE}", value):
        raise ValueError(f"not a full date and time: {value!r}")
    return event_time(F.lit(value))


def interval_micros(text: str) -> int | None:
    """Length of an interval string, or None if it has units of varying length (months)."""
    parts = re.findall(r"(\d+)\s*([a-zA-Z]+)", text)
    units = [(int(n), u.lower().removesuffix("s")) for n, u in parts]
    leftover = re.sub(r"\d+\s*[a-zA-Z]+", "", text.replace("interval", "")).strip()
    if not units or leftover or any(u not in _UNIT_MICROS for _, u in units):
        return None
    return sum(n * _UNIT_MICROS[u] for n, u in units)


def day_of(column: str) -> Column:
    """The UTC day of an instant, as a number."""
    return F.floor(F.unix_micros(column) / MICROS_A_DAY).cast("int")


def earlier(ts: Column, delay: str) -> Column:
    """``ts`` minus an interval of fixed length, in elapsed time.

    Subtracting an ``INTERVAL`` would count days on the session zone's calendar.
    """
    micros = interval_micros(delay)
    if micros is None:
        raise ValueError(f"not an interval of fixed length: {delay!r}")
    return F.timestamp_micros(F.unix_micros(ts) - F.lit(micros))
