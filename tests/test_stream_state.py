"""Chained windows, bucketed state, ids by day, balances, offsets, repair, chains and field errors."""

import json
import random
from collections import Counter
from pathlib import Path

import pytest
from conftest import SF_DIR, ChangeFeed, sale
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tidemark.operators.chains import chain_breaks
from tidemark.operators.decode import parse_cdc_events, parse_events
from tidemark.operators.fields import field_errors
from tidemark.operators.repair import differing_days, repaired_parts, with_day
from tidemark.operators.revenue import (
    revenue_parts,
    revenue_sliding,
    revenue_sliding_closed,
    revenue_table,
)
from tidemark.plans.stream_queries import feed_waves, in_waves
from tidemark.schemas import DLQ_FIELDS, REVENUE_FIELDS
from tidemark.sources.topics import publish, read_file_topic
from tidemark.streaming.balance import Balance, audited_events
from tidemark.streaming.buckets import BucketedState
from tidemark.streaming.folders import BatchTable, CommitLog
from tidemark.streaming.offsets import OffsetLedger, offset_runs
from tidemark.streaming.routed import RoutedTables
from tidemark.streaming.seen import SeenIds
from tidemark.streaming.sinks import StreamFolder, drain
from tidemark.streaming.state import ChangeLog


def rows(df):
    return sorted(map(repr, df.collect()))


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def partition_filters(df):
    """The partition filters of every file scan of a plan."""
    scans = [line for line in executed(df).splitlines() if "PartitionFilters: " in line]
    assert scans
    return [line.split("PartitionFilters: ")[1].split("PushedFilters")[0] for line in scans]


# --- sliding windows by two chained aggregates


def chained_progress(spark, path, waves, window):
    folder = StreamFolder(path)
    updated = []

    def writer(topic):
        stream = revenue_sliding_closed(parse_events(topic, REVENUE_FIELDS), window, "1 hour")
        return folder.appended(stream)

    def after(query):
        for progress in query.recentProgress:
            if progress["numInputRows"]:
                updated.append([s["numRowsUpdated"] for s in progress["stateOperators"]])

    in_waves(waves, spark, path, writer, after=after)
    schema = revenue_sliding(parse_events(read_file_topic(spark, f"{path}/topic"))).schema
    return folder.read(spark, schema), updated


def test_an_event_updates_one_bucket_whatever_the_overlap(spark, tmp_path):
    waves = feed_waves(spark, SF_DIR)
    _, narrow = chained_progress(spark, str(tmp_path / "narrow"), waves, "2 hours")
    _, wide = chained_progress(spark, str(tmp_path / "wide"), waves, "24 hours")
    assert len(narrow) == len(wide) == 3
    # of the two operators of a batch one sums events into buckets: the same in both streams
    assert [min(a) <= min(b) for a, b in zip(narrow, wide)] == [True] * 3
    assert [set(a) & set(b) != set() for a, b in zip(narrow, wide)] == [True] * 3


def test_closed_windows_equal_the_batch(spark, tmp_path):
    waves = feed_waves(spark, SF_DIR)[:1]
    got, _ = chained_progress(spark, str(tmp_path / "out"), waves, "5 hours")
    events = parse_events(waves[0], REVENUE_FIELDS)
    valid = events.filter("event_type in ('sale', 'stock') and event_id is not null")
    high = valid.agg(F.max("event_time")).first()[0]
    whole = revenue_sliding(events, "5 hours", "1 hour")
    closed = whole.filter(F.col("window_end") <= F.lit(high) - F.expr("INTERVAL 2 MINUTES"))
    assert got.count() > 0
    assert rows(got) == rows(closed.select(*got.columns))


def test_windows_that_no_bucket_tiles_are_refused(spark):
    with pytest.raises(ValueError, match="tiles"):
        revenue_sliding_closed(parse_events(spark.createDataFrame([], "value binary")), "1 month", "1 hour")


# --- state in buckets


def change_batches(seed, batches=4, keys=30, per_batch=25):
    """Topic texts per batch, also with older changes in later batches and rows that no key names."""
    rng, out, at = random.Random(seed), [], 0
    for _ in range(batches):
        feed = ChangeFeed()
        for _ in range(per_batch):
            at += 1
            sku = f"k{rng.randrange(keys)}"
            when = at - (rng.randrange(40) if rng.random() < 0.2 else 0)
            if rng.random() < 0.25:
                feed.drop(sku, when)
            else:
                feed.put(sku, float(at), when)
        feed.noise("no json", '{"op":"t"}')
        out.append(feed.texts)
    return out


@pytest.mark.parametrize("guard", [False, True])
def test_buckets_hold_what_the_log_says(spark, raw, tmp_path, guard):
    buckets = BucketedState(str(tmp_path / "b"), buckets=5, guard_stale=guard)
    log = ChangeLog(str(tmp_path / "l"), guard_stale=guard)
    for i, texts in enumerate(change_batches(guard)):
        records = raw(texts)
        buckets.apply(records, i)
        log.apply(records, i)
        assert rows(buckets.current(spark)) == rows(log.current(spark))
        buckets.apply(records, i)  # a replay changes nothing
        assert rows(buckets.current(spark)) == rows(log.current(spark))
    assert rows(buckets.dlq(spark)) == rows(log.dlq(spark))


def test_a_crash_in_the_middle_of_a_write_harms_nothing(spark, raw, tmp_path, monkeypatch):
    state = BucketedState(str(tmp_path / "b"), buckets=3)
    first, second, third, fourth = change_batches(7)
    state.apply(raw(first), 0)
    state.apply(raw(second), 1)
    before = rows(state.current(spark))
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "finish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            state.apply(raw(third), 2)
    assert rows(state.current(spark)) == before
    state.apply(raw(third), 2)
    state.apply(raw(fourth), 3)
    log = ChangeLog(str(tmp_path / "l"))
    for i, texts in enumerate((first, second, third, fourth)):
        log.apply(raw(texts), i)
    assert rows(state.current(spark)) == rows(log.current(spark))


def test_a_batch_reads_and_writes_the_buckets_it_touches(spark, raw, tmp_path):
    state = BucketedState(str(tmp_path / "b"), buckets=8)
    feed = ChangeFeed()
    for i in range(200):
        feed.put(f"k{i}", 1.0, i)
    state.apply(raw(feed.texts), 0)

    def files():
        return {str(p) for p in Path(state.table).rglob("*.parquet")}

    before = files()
    state.apply(raw(ChangeFeed().put("k1", 2.0, 500).texts), 1)
    touched = {p.split("bucket=")[1].split("/")[0] for p in files() - before}
    assert len(touched) == 1 and before <= files()
    only = state.current(spark, keys=["k1"])
    assert [r.unit_price for r in only.collect()] == [2.0]
    assert all(f"= {min(touched)})" in filters for filters in partition_filters(only))
    assert state.current(spark).count() == 200


def test_nothing_applied_is_an_empty_state(spark, raw, tmp_path):
    state = BucketedState(str(tmp_path / "b"))
    assert state.current(spark).collect() == []
    state.apply(raw(["junk"]), 0)
    assert state.current(spark).collect() == [] and state.dlq(spark).count() == 1


@pytest.mark.parametrize("kind", [BucketedState, ChangeLog])
def test_a_batch_keeps_a_row_per_key_and_reject(spark, raw, tmp_path, monkeypatch, kind):
    feed, persist, kept = ChangeFeed(), DataFrame.persist, []
    for i in range(300):
        feed.put(f"k{i % 3}", float(i), i)
    records = raw([*feed.noise("junk", "junk", '{"op":"t"}').texts, None])

    def counted(df, *args):
        kept.append(df.count())
        return persist(df, *args)

    monkeypatch.setattr(DataFrame, "persist", counted)
    state = kind(str(tmp_path / "s"))
    state.apply(records, 0)
    assert kept and max(kept) == 3 + 3
    assert sorted(r.raw_json for r in state.dlq(spark).collect()) == ["junk", "junk", '{"op":"t"}']
    assert {r.sku: r.unit_price for r in state.current(spark).collect()} == {"k0": 297.0, "k1": 298.0, "k2": 299.0}


# --- ids by day, one parse, folds


def test_ids_are_read_of_the_asked_days_only(spark, tmp_path):
    seen = SeenIds(str(tmp_path / "seen"))
    days = spark.range(40).select(
        F.concat(F.lit("e"), "id").alias("event_id"),
        F.timestamp_seconds(F.col("id") * 43_200).alias("event_time"),
    )
    seen.write(days.filter("event_id < 'e3'"), 0)
    seen.write(days.filter("event_id >= 'e3'"), 1)
    got = seen.read(spark, [2, 3], 1)
    assert {r.event_id for r in got.collect()} == {"e4", "e5", "e6", "e7"}
    assert all("day#" in filters for filters in partition_filters(got))
    before = {r.event_id for r in seen.read(spark, list(range(25)), 1).collect()}
    seen.fold(spark, 0, None)
    assert {r.event_id for r in seen.read(spark, list(range(25)), 1).collect()} == before
    seen.fold(spark, 1, F.timestamp_seconds(F.lit(86_400 * 15)))
    folded = seen.read(spark, list(range(25)), -3)
    assert {r.day for r in folded.collect()} == set(range(15, 20))


def test_copies_of_another_day_are_other_events(spark, raw, tmp_path):
    tables = RoutedTables(str(tmp_path / "t"), delay="30 days", copies_within="20 days")
    tables.apply(raw([sale("a", "2025-01-01T10:00:00Z"), sale("b", "2025-01-01T10:00:00Z")]), 0)
    again = [sale("a", "2025-01-01T10:00:00Z"), sale("a", "2025-01-02T10:00:00Z")]
    tables.apply(raw(again * 2), 1)
    assert tables.revenue(spark).agg(F.sum("orders")).first()[0] == 3


def test_a_batch_without_copies_is_parsed_once(spark, raw, tmp_path):
    tables = RoutedTables(str(tmp_path / "t"), copies_within="20 days")
    plans = []
    write = BatchTable.write

    def spied(self, df, batch_id):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(self, df, batch_id)

    BatchTable.write = spied
    try:
        tables.apply(raw([sale("a", "2025-01-01T10:00:00Z")]), 0)
        tables.apply(raw([sale("b", "2025-01-01T11:00:00Z")]), 1)
    finally:
        BatchTable.write = write
    assert plans and all("from_json" not in plan.split("InMemoryRelation")[0] for plan in plans)


def test_a_fold_of_rows_apart_writes_new_rows_only(spark, tmp_path):
    table = BatchTable(str(tmp_path / "t"), DLQ_FIELDS, CommitLog(str(tmp_path / "c")), apart=True)

    def letters(n):
        return spark.createDataFrame([(str(n), "{}", "late")], "event_id string, raw_json string, dlq_reason string")

    for n in range(6):
        slot = table.commits.begin(spark, n)
        table.write(letters(n), n)
        table.commits.finish(spark, n, slot)
        if n in (2, 5):
            table.fold(spark, n - 1)
    bases = {p.name: spark.read.parquet(str(p)).count() for p in Path(table.path, "base").iterdir() if p.is_dir()}
    assert bases == {"upto=1": 2, "upto=4": 3}
    assert sorted(r.event_id for r in table.read(spark).collect()) == list("012345")
    letters(9).withColumn("batch_id", F.lit(9).cast("bigint")).write.parquet(f"{table.path}/base/upto=3")
    assert sorted(r.event_id for r in table.read(spark).collect()) == list("012345")


def test_folded_replays_stay_the_same_revenue(spark, raw, tmp_path):
    tables = RoutedTables(str(tmp_path / "t"), delay="1 minute")
    for n in range(4):
        late = sale(f"l{n}", "2025-01-01T08:00:00Z")
        tables.apply(raw([sale(f"s{n}", f"2025-01-01T1{n}:00:00Z"), late]), n)
        tables.replay(spark)
    before = rows(tables.revenue(spark))
    tables.fold(spark, 2)
    assert rows(tables.revenue(spark)) == before
    assert tables.revenue(spark).agg(F.sum("orders")).first()[0] == 8


# --- balance, offsets, repair


def test_every_row_behind_the_watermark_is_counted(spark, raw, tmp_path):
    waves = [
        raw([sale("a", "2025-01-01T10:00:00Z"), sale("a", "2025-01-01T10:00:00Z"), "junk"]),
        raw([sale("b", "2025-01-01T09:00:00Z"), sale("c", "2025-01-01T09:57:59Z"), sale("d", "2025-01-01T09:59:00Z")]),
    ]
    folder, balance, ended = StreamFolder(str(tmp_path / "out")), Balance(), []
    spark.streams.addListener(balance)
    try:
        in_waves(
            waves, spark, folder.path,
            lambda topic: folder.appended(audited_events(parse_events(topic, REVENUE_FIELDS))),
            after=ended.append,
        )
        got = balance.of(spark, ended[-1]).orderBy("batch_id").drop("batch_id").collect()
    finally:
        spark.streams.removeListener(balance)
    assert [tuple(r) for r in got] == [(3, 1, 1, 1, 0, True), (3, 0, 1, 0, 2, True)]


def test_runs_of_offsets_equal_a_walk(spark, monkeypatch):
    from tidemark.streaming import offsets

    monkeypatch.setattr(offsets, "OFFSETS_PER_BLOCK", 7)
    rng = random.Random(4)
    sent = [(p, o) for p in (0, 1) for o in range(80) if rng.random() < 0.7 for _ in range(rng.choice([1, 1, 2]))]
    got = offset_runs(spark.createDataFrame(sent, "partition int, offset bigint").repartition(3))
    want, times = [], Counter(sent)
    for p, o in sorted(times):
        if want and want[-1][0] == p and want[-1][2] == o - 1:
            want[-1][2:] = [o, want[-1][3] + times[p, o]]
        else:
            want.append([p, o, o, times[p, o]])
    assert sorted(map(list, got.collect())) == want


def test_a_strict_ledger_refuses_offsets_it_has(spark, tmp_path):
    ledger = OffsetLedger(str(tmp_path / "l"), strict=True)

    def read(*offsets):
        return spark.createDataFrame([(o,) for o in offsets], "offset bigint")

    ledger.apply(read(1, 2, 3), 0)
    with pytest.raises(ValueError, match=r"offsets \(3, 3\) again"):
        ledger.apply(read(3, 4), 1)
    ledger.apply(read(5, 6), 1)
    found = [(r.kind, r["first"], r["last"]) for r in ledger.findings(spark).collect()]
    assert found == [("gap", 4, 4)]


def test_repair_reads_the_differing_days_only(spark, raw, tmp_path):
    rng = random.Random(8)
    texts = [
        sale(f"s{i}", f"2025-01-{1 + i % 6:02d}T{rng.randrange(24):02d}:30:00Z", rng.choice("ab"), i, 2.5)
        for i in range(200)
    ]
    texts.append(sale("none", "2025-01-03T05:00:00Z", None, None, None))
    whole = parse_events(raw(texts), REVENUE_FIELDS)
    path = str(tmp_path / "archive")
    with_day(whole).write.partitionBy("day").parquet(path)
    archive = spark.read.parquet(path)
    missed = F.col("event_id").isin("s7", "s13", "none")
    stream = revenue_parts(whole.filter(~missed), "1 hour").union(
        revenue_parts(whole.filter("event_id = 's20'"), "1 hour")  # counted twice
    )
    stored = stream.groupBy("window_start", "window_end", "category").agg(
        F.sum("cents").alias("cents"), F.sum("beyond").alias("beyond"), F.sum("orders").alias("orders")
    )
    days = differing_days(archive, stored)
    first = 20089  # 2025-01-01
    assert days == sorted({first + 7 % 6, first + 13 % 6, first + 2, first + 20 % 6})
    got = repaired_parts(archive, stored, days)
    assert rows(revenue_table(got)) == rows(revenue_table(revenue_parts(whole, "1 hour")))
    assert 0 < got.filter("repaired").count() < got.count()
    assert all("day#" in filters for filters in partition_filters(got))
    assert differing_days(archive, revenue_parts(whole, "1 hour")) == []
    with pytest.raises(ValueError, match="tile"):
        differing_days(archive, stored, "7 hours")


# --- chains of changes, errors of fields


def test_lost_changes_show_in_the_sums(spark, raw):
    feed = ChangeFeed()
    for n, sku in enumerate(["whole", "middle", "first", "gone", "back", "tail", "ended"]):
        for step in range(4):
            feed.put(sku, 1.0 + step, 10 * n + step)
    feed.drop("gone", 99).drop("ended", 99)
    feed.put("gone", 7.0, 100)
    envelopes = [json.loads(t) for t in feed.texts if t]
    placed = {}
    lost = {("middle", 1), ("first", 0), ("tail", 3), ("gone", 4), ("ended", 2)}
    texts = []
    for e in envelopes:
        sku = (e["after"] or e["before"])["sku"]
        placed[sku] = placed.get(sku, -1) + 1
        texts.append(None if (sku, placed[sku]) in lost else json.dumps(e))
    decoded = parse_cdc_events(raw(texts), keep=("offset",))
    got = {r.sku: (r.changes, r.standing) for r in chain_breaks(decoded).collect()}
    assert set(got) == {"middle", "first", "gone", "ended"}  # the end of "tail" leaves no trace
    assert got["gone"] == (5, 2) and got["first"] == (3, 0)
    whole = parse_cdc_events(raw([json.dumps(e) for e in envelopes]), keep=("offset",))
    assert chain_breaks(whole).collect() == []


def test_a_log_that_starts_from_a_state(spark, raw):
    rows_ = [(s, "garden", 1.0, 4, "tick 0") for s in ("a", "b", "c")]
    base = spark.createDataFrame(rows_, "sku string, category string, unit_price double, stock int, updated_at string")
    feed = ChangeFeed()
    for sku in "abc":
        feed.put(sku, 1.0, 0)
    feed.texts.clear()
    feed.put("a", 2.0, 1).put("a", 3.0, 2).drop("b", 3)
    texts = [t for t in feed.texts if t]
    decoded = parse_cdc_events(raw(texts), keep=("offset",))
    assert chain_breaks(decoded, base).collect() == []
    assert [r.sku for r in chain_breaks(parse_cdc_events(raw(texts[1:]), keep=("offset",)), base).collect()] == ["a"]


def test_errors_of_fields_are_told_apart(spark, raw):
    texts = [
        '{"event_type":"sale","event_id":"a","ts":"x","quantity":"5","unit_price":3,"more":{"a":1}}',
        '{"event_type":null,"quantity":3000000000,"unit_price":1.5}',
        "error", "[1]", None, "{}", '{"ts":1,"ts":2}',
        '{"ts":"t","event_id":"i","event_type":"e","quantity":2,"unit_price":1e400,"category":{"x":1}}',
    ]
    got = Counter((r.field, r.error) for r in field_errors(raw(texts)).collect())
    assert got == Counter(
        {
            ("quantity", "wrong_type"): 2,
            ("category", "wrong_type"): 1,
            ("more", "unknown_field"): 1,
            ("event_type", "null"): 1,
            ("event_type", "absent"): 1,
            ("event_id", "absent"): 2,
            ("ts", "absent"): 2,
            (None, "not_an_object"): 3,
        }
    )


def test_a_payload_is_parsed_once(spark, raw):
    plan = executed(field_errors(raw(["{}"])))
    assert plan.count("parseJson") == 1
