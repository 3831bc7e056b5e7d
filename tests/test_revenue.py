"""Windowed revenue: fixed cases, NULLs, amounts without cents, random input against Python."""

import math
from collections import defaultdict
from datetime import datetime, timedelta, timezone
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import sale
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.money import exact_cents
from tidemark.functions.times import interval_micros
from tidemark.operators.decode import parse_events
from tidemark.operators.revenue import (
    merge_parts,
    revenue_parts,
    revenue_sliding,
    revenue_table,
    revenue_tumbling,
    sale_revenue,
)

DAY = "2025-01-01T"


def collected(df):
    """Rows with windows as epoch seconds."""
    cols = [F.unix_seconds(c).alias(c) for c in ("window_start", "window_end")]
    rows = df.select(*cols, "category", "revenue", "orders").collect()
    return {(r.window_start, r.window_end, r.category): (r.revenue, r.orders) for r in rows}


def at(text):
    return int(datetime.fromisoformat(f"{DAY}{text}+00:00").timestamp())



@pytest.mark.parametrize("window,slide", [("5 minutes", "2 minutes"), ("1 hour", "25 minutes")])
def test_sliding_by_buckets_equals_expanding_rows(raw, window, slide):
    texts = [
        sale(f"s{i}", f"{DAY}10:{i % 60:02d}:{i * 7 % 60:02d}Z", unit_price=0.1 * i) for i in range(60)
    ]
    events = parse_events(raw(texts))
    direct = (
        sale_revenue(events)
        .groupBy(F.window("event_time", window, slide), "category")
        .agg(F.round(F.sum("revenue"), 2).alias("revenue"), F.count("*").alias("orders"))
        .select("window.start", "window.end", "category", "revenue", "orders")
        .toDF("window_start", "window_end", "category", "revenue", "orders")
    )
    assert collected(revenue_sliding(events, window, slide)) == collected(direct)


def test_orders_count_sales_with_missing_numbers_and_null_category(raw):
    events = parse_events(
        raw(
            [
                sale("a", DAY + "10:00:10Z", quantity=None),
                sale("b", DAY + "10:00:20Z", category=None),
                sale("c", DAY + "10:00:30Z"),
                sale("d", "some time today"),
            ]
        )
    )
    window = (at("10:00:00"), at("10:01:00"))
    assert collected(revenue_tumbling(events)) == {
        (*window, "books"): (5.0, 2),
        (*window, None): (5.0, 1),
    }


def test_amounts_without_exact_cents_are_still_summed(raw):
    huge = sale("a", DAY + "10:00:10Z", quantity=10, unit_price=1e20)
    small = sale("b", DAY + "10:00:20Z")
    strange = sale("c", DAY + "10:00:20Z", category="toys", unit_price=float("nan"))
    result = collected(revenue_tumbling(parse_events(raw([huge, small, strange]))))
    window = (at("10:00:00"), at("10:01:00"))
    assert result[(*window, "books")] == (1e21, 2)
    assert math.isnan(result[(*window, "toys")][0])


def test_parts_of_batches_add_up(raw):
    texts = [sale(f"s{i}", f"{DAY}10:00:{i:02d}Z", unit_price=0.1) for i in range(30)]
    whole = revenue_parts(parse_events(raw(texts)))
    halves = revenue_parts(parse_events(raw(texts[:11]))).unionByName(
        revenue_parts(parse_events(raw(texts[11:])))
    )
    assert collected(revenue_table(merge_parts(halves))) == collected(revenue_table(whole))
    assert list(collected(revenue_table(whole)).values()) == [(3.0, 30)]


sales = st.lists(
    st.tuples(
        st.integers(0, 7200),
        st.sampled_from(["books", "home", "toys"]),
        st.integers(0, 9),
        st.decimals("0", "120", places=2),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(sales)
def test_random_sales_against_plain_python(raw, rows):
    start = datetime(2025, 1, 1, tzinfo=timezone.utc)
    texts, want = [], defaultdict(lambda: [Decimal(0), 0])
    for i, (second, category, quantity, price) in enumerate(rows):
        when = start + timedelta(seconds=second)
        texts.append(sale(f"s{i}", when.strftime("%Y-%m-%dT%H:%M:%SZ"), category, quantity, float(price)))
        bucket = int(when.replace(second=0).timestamp())
        total = want[(bucket, bucket + 60, category)]
        total[0] += (quantity * price).quantize(Decimal("0.01"), ROUND_HALF_UP)
        total[1] += 1
    got = collected(revenue_tumbling(parse_events(raw(texts))))
    assert got == {key: (float(total), n) for key, (total, n) in want.items()}


AMOUNTS = st.one_of(
    st.floats(allow_nan=False, allow_infinity=False),
    st.floats(-1e6, 1e6),
    st.integers(-10**9, 10**9).map(lambda n: n / 1000),
    st.integers(-10**17, 10**17).map(lambda n: n / 200),
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(AMOUNTS, min_size=1, max_size=300))
def test_cents_round_the_decimal_text_half_up(spark, amounts):
    amounts = [*amounts, 1.005, -1.005, 0.285, 2.675, 1e11 + 0.005, 9.999e15, 1e16, -1e300]
    frame = spark.createDataFrame([(a,) for a in amounts], "a double")
    for row in frame.select("a", exact_cents(F.col("a")).alias("cents")).collect():
        text = Decimal(repr(row.a))
        want = None if abs(text) >= 10**16 else (text * 100).quantize(Decimal(1), ROUND_HALF_UP)
        assert row.cents == want, row.a


def test_interval_strings():
    assert interval_micros("2 minutes") == 120_000_000
    assert interval_micros("1 hour 30 minutes") == 5_400_000_000
    assert interval_micros("1 month") is None
