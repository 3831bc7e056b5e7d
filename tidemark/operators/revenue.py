"""Revenue and order counts per category over event-time windows.

The sums are kept as mergeable parts (``cents``, ``beyond``, ``orders``) until the last step, so
windows can be built from smaller buckets, and a table can be built from micro-batches, exactly.
Nothing here sorts: a sort is refused on a stream in append and update mode.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import (
    CENTS_TOTAL,
    as_double,
    beyond_cents,
    exact_cents,
    line_amount,
)
from tidemark.functions.times import interval_micros
from tidemark.schemas import SALE

PART_FIELDS = {
    "window_start": "timestamp",
    "window_end": "timestamp",
    "category": "string",
    "cents": CENTS_TOTAL,
    "beyond": "double",
    "orders": "bigint",
}
PART_KEYS = ("window_start", "window_end", "category")


def sales_only(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == SALE)


def sale_revenue(events: DataFrame) -> DataFrame:
    """Sale events with ``revenue``; NULL if quantity or price is NULL."""
    return sales_only(events).withColumn("revenue", F.round(line_amount(), 2))


def _flat(windowed: DataFrame) -> DataFrame:
    return windowed.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "category",
        F.col("cents").cast(CENTS_TOTAL).alias("cents"),
        "beyond",
        "orders",
    )


def _sum_sales(sales: DataFrame, window: Column) -> DataFrame:
    return sales.groupBy(window.alias("window"), "category").agg(
        F.sum(exact_cents(line_amount())).alias("cents"),
        F.sum(beyond_cents(line_amount())).alias("beyond"),
        F.count("*").alias("orders"),
    )


def sum_parts(parts: DataFrame, *keys: Column | str, also: Sequence[Column] = ()) -> DataFrame:
    """Add up parts per group."""
    return parts.groupBy(*keys).agg(
        F.sum("cents").cast(CENTS_TOTAL).alias("cents"),
        F.sum("beyond").alias("beyond"),
        F.sum("orders").alias("orders"),
        *also,
    )


def _shared_bucket(window: str, slide: str) -> str | None:
    """The longest bucket that tiles both intervals, if their lengths are fixed."""
    length, step = interval_micros(window), interval_micros(slide)
    if not length or not step:
        return None
    return f"{gcd(length, step)} microseconds"


def revenue_parts(
    events: DataFrame,
    window: str = "1 minute",
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Mergeable sums per window and category, one row each.

    A sliding window on a table first sums rows into buckets that tile the windows, then expands the
    buckets: each row is hashed once and not ``window / slide`` times. A stream allows one stateful
    aggregate in every output mode, so there the rows are expanded.
    """
    sales = sales_only(events)
    if watermark is not None:
        sales = sales.withWatermark("event_time", watermark)
    if slide is None:
        return _flat(_sum_sales(sales, F.window("event_time", window)))
    bucket = None if sales.isStreaming else _shared_bucket(window, slide)
    if bucket is None:
        return _flat(_sum_sales(sales, F.window("event_time", window, slide)))
    return sliding_parts(_flat(_sum_sales(sales, F.window("event_time", bucket))), window, slide)


def merge_parts(parts: DataFrame) -> DataFrame:
    """Add up parts of the same window and category, for example of several micro-batches."""
    return sum_parts(parts, *PART_KEYS)


def sliding_parts(parts: DataFrame, window: str, slide: str) -> DataFrame:
    """Parts of sliding windows from parts of short ones that tile them.

    ``window`` and ``slide`` must be multiples of the short windows' length. Short windows are expanded
    and not rows, so this reads a stored table of parts of any number of events.
    """
    return _flat(
        sum_parts(parts, F.window("window_start", window, slide).alias("window"), "category")
    )


def revenue_table(parts: DataFrame, *more: str) -> DataFrame:
    """Merged parts to the public columns; ``more`` columns are carried along."""
    return parts.select(
        "window_start",
        "window_end",
        "category",
        as_double(F.col("cents"), F.col("beyond")).alias("revenue"),
        "orders",
        *more,
    )


def revenue_tumbling(
    events: DataFrame, window: str = "1 minute", watermark: str = "2 minutes"
) -> DataFrame:
    """Revenue and number of sale events per category in windows that do not overlap."""
    return revenue_table(revenue_parts(events, window, watermark=watermark))


def revenue_sliding(
    events: DataFrame,
    window: str = "5 minutes",
    slide: str = "1 minute",
    watermark: str = "2 minutes",
) -> DataFrame:
    """As `revenue_tumbling`, over windows that start every ``slide``."""
    return revenue_table(revenue_parts(events, window, slide, watermark))


def closed_sliding_parts(
    events: DataFrame,
    window: str = "5 minutes",
    slide: str = "1 minute",
    watermark: str = "2 minutes",
) -> DataFrame:
    """Mergeable sums of sliding windows that are over, for a stream in append mode.

    Two stateful aggregates, one behind the other: events are summed into buckets that tile window and
    slide, and a bucket goes into its ``window / slide`` windows once, when the watermark closes it.
    An event thus costs one state update whatever the overlap, where expanded rows cost one per window.
    An event is too late when its bucket is closed, also if a longer window is still open. Months and
    other lengths that no bucket tiles are refused.
    """
    bucket = _shared_bucket(window, slide)
    if bucket is None:
        raise ValueError(f"no fixed bucket tiles windows of {window!r} every {slide!r}")
    sales = sales_only(events).withWatermark("event_time", watermark)
    buckets = _sum_sales(sales, F.window("event_time", bucket))
    over = F.window(F.window_time("window"), window, slide).alias("window")
    return _flat(sum_parts(buckets, over, "category"))


def revenue_sliding_closed(
    events: DataFrame,
    window: str = "5 minutes",
    slide: str = "1 minute",
    watermark: str = "2 minutes",
) -> DataFrame:
    """`revenue_sliding` by `closed_sliding_parts`: each window once, when it is over."""
    return revenue_table(closed_sliding_parts(events, window, slide, watermark))


def in_window_order(revenue: DataFrame) -> DataFrame:
    """Sort a finished revenue table. For tables, or a stream in complete mode."""
    return revenue.orderBy("window_start", "category")
