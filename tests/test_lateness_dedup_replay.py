"""Moving cutoff, copies, replay of late dead letters."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import sale
from pyspark.sql import functions as F

from tidemark.operators import lateness
from tidemark.operators.decode import decode_with_raw, parse_events
from tidemark.operators.dedup import dedup_events
from tidemark.operators.replay import replay_late
from tidemark.operators.revenue import revenue_parts, revenue_table
from tidemark.operators.route import dead_letters, on_time, with_route

START = datetime(2025, 1, 1, tzinfo=timezone.utc)


def stamp(seconds):
    return (START + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


@pytest.mark.parametrize("block", [1, 3, 65_536])
def test_cutoff_against_a_plain_loop(spark, monkeypatch, block):
    monkeypatch.setattr(lateness, "BATCHES_PER_BLOCK", block)
    rng = random.Random(block)
    rows = [(i, rng.choice([0, 1, 2, 5, 6, 7, 11]), rng.randint(0, 5000)) for i in range(200)]
    frame = spark.createDataFrame(rows, "id int, batch_id bigint, at bigint").withColumn(
        "event_time", F.timestamp_seconds("at")
    )
    got = {
        r.id: (r.cutoff_s, r.is_late)
        for r in lateness.mark_late(frame, delay="10 minutes")
        .withColumn("cutoff_s", F.unix_seconds("cutoff"))
        .collect()
    }
    for i, batch, at in rows:
        seen = [t for _, b, t in rows if b < batch]
        cutoff = max(seen) - 600 if seen else None
        assert got[i] == (cutoff, cutoff is not None and at < cutoff)


def test_delay_is_elapsed_time_across_a_clock_change(spark):
    """New York skips an hour on 2025-03-09; a day stays 24 hours."""
    rows = [(0, "2025-03-09T12:00:00Z"), (1, "2025-03-08T12:00:00Z")]
    frame = spark.createDataFrame(rows, "batch_id bigint, ts string").select(
        "batch_id", F.to_timestamp("ts").alias("event_time")
    )
    marked = lateness.mark_late(frame, delay="1 day").filter("batch_id = 1").first()
    assert marked.cutoff == marked.event_time and not marked.is_late
    with pytest.raises(ValueError):
        lateness.mark_late(frame, delay="1 month")


def test_first_copy_stays_and_rows_without_id_are_kept(raw):
    texts = [
        sale("a", stamp(20)),
        sale("a", stamp(10)),
        sale("b", stamp(5)),
        sale(None, stamp(1)),
        sale(None, stamp(1)),
    ] + [sale("hot", stamp(3))] * 30
    kept = dedup_events(parse_events(raw(texts)))
    rows = sorted((r.event_id or "", r.ts) for r in kept.collect())
    assert rows == sorted(
        [("a", stamp(10)), ("b", stamp(5)), ("hot", stamp(3)), ("", stamp(1)), ("", stamp(1))]
    )
    assert kept.columns == parse_events(raw(texts)).columns


def test_replay_gives_the_table_without_lateness(raw):
    texts = [sale(f"s{i}", stamp(7 * i), quantity=i % 4, unit_price=0.1 * i) for i in range(60)]
    texts += ["plainly no JSON", '{"event_type":"refund","event_id":"m","ts":"%s"}' % stamp(1)]
    routed = with_route(decode_with_raw(raw(texts)), stamp(200))
    parts = revenue_parts(on_time(routed))
    complete = revenue_table(revenue_parts(parse_events(raw(texts))))
    touched = revenue_table(replay_late(parts, dead_letters(routed)))
    late_windows = complete.filter(F.col("window_start") < F.to_timestamp(F.lit(stamp(200))))
    assert sorted(map(repr, touched.collect())) == sorted(map(repr, late_windows.collect()))
