"""Real streams over file topics: modes, watermark, restart, replay of a batch, state."""

import os
import re
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from conftest import SF_DIR, ChangeFeed, sale
from pyspark.sql import functions as F

from tidemark.operators.decode import parse_events
from tidemark.operators.dedup import dedup_events
from tidemark.operators.revenue import revenue_sliding, revenue_tumbling
from tidemark.plans.stream_queries import feed_waves, in_waves
from tidemark.schemas import REVENUE_FIELDS
from tidemark.sources.catalogs import keyed_state_configs
from tidemark.sources.tables import feed, feed_stream
from tidemark.sources.topics import publish, read_file_topic
from tidemark.streaming import routed, state
from tidemark.streaming.folders import Snapshots, Versions
from tidemark.streaming.routed import RoutedTables
from tidemark.streaming.sinks import StreamFolder, console_writer, drain, each_batch
from tidemark.streaming.state import ChangeLog

START = datetime(2025, 1, 1, tzinfo=timezone.utc)
REVENUE = {
    "window_start": "timestamp",
    "window_end": "timestamp",
    "category": "string",
    "revenue": "double",
    "orders": "bigint",
}


def stamp(seconds):
    return (START + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


def publish_each(raw, path, batches):
    """One file per batch, oldest first."""
    for i, texts in enumerate(batches):
        before = set(Path(path).glob("*.parquet")) if Path(path).exists() else set()
        publish(raw(texts).coalesce(1), path)
        for new in set(Path(path).glob("*.parquet")) - before:
            os.utime(new, (1_700_000_000 + i, 1_700_000_000 + i))


def topic(spark, path):
    return read_file_topic(spark, path, maxFilesPerTrigger=1)


def rows(df):
    return sorted(map(repr, df.collect()))


def forget_last_commit(checkpoint):
    """The state after a crash between writing a batch and committing it."""
    commits = sorted(Path(checkpoint, "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    for crc in Path(checkpoint, "commits").glob(f".{commits[-1].name}.crc"):
        crc.unlink()


def test_append_emits_closed_windows_only(spark, raw, tmp_path):
    """The watermark is 10:00 + 300 s - 120 s = 180 s: the window that ends there is closed."""
    path = str(tmp_path / "topic")
    early = [sale(f"s{t}", stamp(t)) for t in (10, 70, 130)]
    publish_each(raw, path, [early, [sale("e", stamp(300))]])
    folder = StreamFolder(str(tmp_path / "out"))
    stream = revenue_tumbling(parse_events(topic(spark, path)))
    drain(folder.appended(stream))
    got = folder.read(spark, stream.schema)
    ends = sorted(r.e for r in got.select(F.unix_seconds("window_end").alias("e")).collect())
    assert ends == [int(START.timestamp()) + s for s in (60, 120, 180)]


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_update_and_complete_equal_the_batch(spark, raw, tmp_path, mode):
    path, out = str(tmp_path / "topic"), str(tmp_path / "out")
    publish_each(raw, path, [[sale(f"{b}-{t}", stamp(t + b)) for t in range(0, 200, 9)] for b in range(3)])
    stream = revenue_sliding(parse_events(topic(spark, path)), watermark="1 hour")
    if mode == "update":
        table = Versions(out, REVENUE, ("window_start", "window_end", "category"))
    else:
        table = Snapshots(out, REVENUE)
    drain(each_batch(stream, table.apply, str(tmp_path / "cp"), mode))
    batch = revenue_sliding(parse_events(spark.read.parquet(path)))
    assert rows(table.current(spark).select(*REVENUE)) == rows(batch.select(*REVENUE))
    if mode == "update":
        table.fold(spark, 1)
        assert rows(table.current(spark).select(*REVENUE)) == rows(batch.select(*REVENUE))
    else:
        assert len(list(Path(out).glob("slot=*"))) == 2


def test_readers_prune_to_finished_batches(spark, raw, tmp_path):
    path = str(tmp_path / "topic")
    publish_each(raw, path, routed_batches())
    tables = RoutedTables(str(tmp_path / "out"))
    drain(tables.writer(topic(spark, path), str(tmp_path / "cp")))
    tables.fold(spark, 0)
    plan = tables.dlq(spark)._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[(.*?)\]", plan)
    assert any("batch_id" in f and ">= 1" in f and "<= " in f for f in filters), filters


def test_registered_streams_have_several_batches(spark, tmp_path):
    folder = StreamFolder(str(tmp_path / "out"))

    def writer(records):
        return folder.appended(revenue_tumbling(parse_events(records, REVENUE_FIELDS), "1 hour"))

    assert len(in_waves(feed_waves(spark, SF_DIR), spark, folder.path, writer)) >= 3


def test_console_and_catalog_sinks(spark, raw, tmp_path):
    path = str(tmp_path / "topic")
    publish_each(raw, path, [[sale("a", stamp(1))]])
    printed = drain(console_writer(parse_events(topic(spark, path))))
    assert printed.lastProgress["numInputRows"] == 1
    assert "Console" in printed.lastProgress["sink"]["description"]
    folder = StreamFolder(str(tmp_path / "out"))
    query = folder.into(parse_events(topic(spark, path)), "stream_events")
    query.processAllAvailable()
    query.stop()
    assert spark.table("stream_events").count() == 1
    assert Path(folder.checkpoint, "commits").exists()
    spark.sql("DROP TABLE stream_events")


def routed_batches():
    first = [sale(f"a{t}", stamp(t)) for t in range(0, 600, 20)] + ["plainly no JSON"]
    second = [sale("late", stamp(10)), sale("edge", stamp(460)), sale("new", stamp(900))]
    third = [sale("late2", stamp(700)), sale("ok", stamp(800)), "{}", None]
    return [first, second, third]


def test_routed_tables_follow_the_cutoff(spark, raw, tmp_path):
    """Batch 0 reaches 580 s, so the cutoff of batch 1 is 460 s; batch 1 reaches 900 s."""
    path = str(tmp_path / "topic")
    batches = routed_batches()
    publish_each(raw, path, batches)
    tables = RoutedTables(str(tmp_path / "out"))
    drain(tables.writer(topic(spark, path), str(tmp_path / "cp")))
    dlq = [(r.batch_id, r.event_id, r.dlq_reason) for r in tables.dlq(spark).collect()]
    assert sorted(dlq) == [
        (0, "unknown", "malformed_or_unknown"),
        (1, "late", "late"),
        (2, "late2", "late"),
        (2, "unknown", "malformed_or_unknown"),
        (2, "unknown", "malformed_or_unknown"),
    ]
    orders = tables.revenue(spark).agg(F.sum("orders")).first()[0]
    assert orders + len(dlq) == sum(map(len, batches))


def test_replayed_batch_leaves_both_tables_as_they_were(spark, raw, tmp_path):
    path, checkpoint = str(tmp_path / "topic"), str(tmp_path / "cp")
    publish_each(raw, path, routed_batches())
    tables = RoutedTables(str(tmp_path / "out"))
    drain(tables.writer(topic(spark, path), checkpoint))
    before = rows(tables.revenue(spark)), rows(tables.dlq(spark))
    forget_last_commit(checkpoint)
    again = drain(tables.writer(topic(spark, path), checkpoint))
    assert sum(p["numInputRows"] for p in again.recentProgress) == len(routed_batches()[-1])
    assert (rows(tables.revenue(spark)), rows(tables.dlq(spark))) == before
    for upto in (0, 1, 1):
        tables.fold(spark, upto)
        assert (rows(tables.revenue(spark)), rows(tables.dlq(spark))) == before
    publish_each(raw, path, [[sale("more", stamp(950))]])
    drain(tables.writer(topic(spark, path), checkpoint))
    orders = tables.revenue(spark).agg(F.sum("orders")).first()[0]
    assert orders == 1 + sum(map(len, routed_batches())) - len(before[1])


def orders_of(tables, spark):
    return tables.revenue(spark).agg(F.sum("orders")).first()[0]


def test_fold_past_the_newest_batch_is_refused(spark, raw, tmp_path):
    path, checkpoint = str(tmp_path / "topic"), str(tmp_path / "cp")
    tables = RoutedTables(str(tmp_path / "out"))
    publish_each(raw, path, [[sale("a", stamp(1)), sale("b", stamp(2))]])
    drain(tables.writer(topic(spark, path), checkpoint))
    for upto in (0, 5):
        with pytest.raises(ValueError, match="cannot fold"):
            tables.fold(spark, upto)
    publish_each(raw, path, [[sale(f"c{i}", stamp(3 + i)) for i in range(3)]])
    drain(tables.writer(topic(spark, path), checkpoint))
    assert orders_of(tables, spark) == 5


@pytest.mark.parametrize("folded", [False, True])
def test_a_new_checkpoint_on_used_tables_is_refused(spark, raw, tmp_path, folded):
    path = str(tmp_path / "topic")
    tables = RoutedTables(str(tmp_path / "out"))
    publish_each(raw, path, [[sale("a", stamp(1))], [sale("b", stamp(2))]])
    drain(tables.writer(topic(spark, path), str(tmp_path / "cp")))
    if folded:
        tables.fold(spark, 0)
    with pytest.raises(Exception, match="another stream"):
        drain(tables.writer(topic(spark, path), str(tmp_path / "other")))
    assert orders_of(tables, spark) == 2


def test_readers_see_whole_batches_only(spark, raw, tmp_path, monkeypatch):
    """A batch that fails after some of its tables shows in none of them, and is whole after a retry."""
    path, checkpoint = str(tmp_path / "topic"), str(tmp_path / "cp")
    tables = RoutedTables(str(tmp_path / "out"))
    publish_each(raw, path, routed_batches()[:2])
    drain(tables.writer(read_file_topic(spark, path, maxFilesPerTrigger=1), checkpoint))
    before = rows(tables.revenue(spark)), rows(tables.dlq(spark))
    publish_each(raw, path, routed_batches()[2:])

    def lost(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as broken:
        broken.setattr(routed, "revenue_parts", lost)
        with pytest.raises(Exception, match="executor lost"):
            drain(tables.writer(topic(spark, path), checkpoint))
    assert Path(tables.dlq_table.path, "batches", "batch_id=2").exists()
    assert (rows(tables.revenue(spark)), rows(tables.dlq(spark))) == before
    drain(tables.writer(topic(spark, path), checkpoint))
    assert orders_of(tables, spark) + tables.dlq(spark).count() == sum(map(len, routed_batches()))


def test_replay_of_stored_dead_letters_runs_once(spark, raw, tmp_path):
    path, checkpoint = str(tmp_path / "topic"), str(tmp_path / "cp")
    tables = RoutedTables(str(tmp_path / "out"))
    publish_each(raw, path, routed_batches()[:2])
    drain(tables.writer(topic(spark, path), checkpoint))
    punctual = orders_of(tables, spark)
    for _ in range(2):
        assert tables.replay(spark) == 1
        assert orders_of(tables, spark) == punctual + 1
    publish_each(raw, path, routed_batches()[2:])
    drain(tables.writer(topic(spark, path), checkpoint))
    for _ in range(2):
        tables.replay(spark)
        tables.fold(spark, 1)
    sales = [text for batch in routed_batches() for text in batch if text and "sale" in text]
    assert rows(tables.revenue(spark)) == rows(revenue_tumbling(parse_events(raw(sales))))
    five = revenue_sliding(parse_events(raw(sales)), "5 minutes", "1 minute")
    assert rows(tables.sliding(spark, "5 minutes", "1 minute")) == rows(five)


def test_copies_in_later_batches_count_once(spark, raw, tmp_path):
    path, checkpoint = str(tmp_path / "topic"), str(tmp_path / "cp")
    first = [sale(f"s{i % 5}", stamp(10 * (i % 5))) for i in range(12)] + ['{"event_type":"sale"}'] * 2
    second = [sale(f"s{i}", stamp(10 * i)) for i in range(3, 8)] + ['{"event_type":"sale"}']
    tables = RoutedTables(str(tmp_path / "out"), copies_within="1 hour")
    publish_each(raw, path, [first, second, [sale("s6", stamp(60)), sale("s9", stamp(90))]])
    drain(tables.writer(topic(spark, path), checkpoint))
    assert orders_of(tables, spark) == 9
    assert [r.dlq_reason for r in tables.dlq(spark).collect()] == ["malformed_or_unknown"] * 3
    tables.fold(spark, 1)
    publish_each(raw, path, [[sale("s0", stamp(0)), sale("s9", stamp(90)), sale("s10", stamp(95))]])
    drain(tables.writer(topic(spark, path), checkpoint))
    assert orders_of(tables, spark) == 10


@pytest.mark.parametrize("on_disk", [False, True])
def test_stream_dedup_across_batches(spark, raw, tmp_path, on_disk):
    for name, value in keyed_state_configs().items() if on_disk else ():
        spark.conf.set(name, value)
    try:
        _dedup_across_batches(spark, raw, tmp_path)
    finally:
        for name in keyed_state_configs():
            spark.conf.unset(name)


def _dedup_across_batches(spark, raw, tmp_path):
    """Copies in one batch and in later ones; rows without an id are no copies of each other."""
    for spread in (None, 4):
        path = str(tmp_path / f"topic{spread}")
        first = [sale(f"s{i % 10}", stamp(i % 10)) for i in range(40)] + [sale(None, stamp(3))] * 2
        second = [sale(f"s{i}", stamp(i)) for i in range(5, 15)] + [sale(None, stamp(3))]
        publish_each(raw, path, [first, second])
        folder = StreamFolder(str(tmp_path / f"out{spread}"))
        stream = dedup_events(parse_events(topic(spark, path)), spread_copies=spread)
        drain(folder.appended(stream))
        got = [r.event_id for r in folder.read(spark, stream.schema).collect()]
        assert sorted(g for g in got if g) == sorted(f"s{i}" for i in range(15))
        assert got.count(None) == 3


def change_batches():
    """The second batch is older than the first where both touch a product."""
    first, second, third = ChangeFeed(), ChangeFeed(), ChangeFeed()
    first.put("lamp", 1.5, 200).put("lamp", 2.5, 300).put("rug", 1.5, 100).drop("vase", 300)
    second.put("lamp", 9.5, 100, op="u").drop("rug", 200).put("vase", 5.5, 100).noise('{"op":"t"}')
    third.put("desk", 4.5, 50).noise("plainly no JSON")
    return [first.texts, second.texts, third.texts]


@pytest.mark.parametrize(
    "guard,want",
    [(False, {"lamp": 9.5, "vase": 5.5, "desk": 4.5}), (True, {"lamp": 2.5, "desk": 4.5})],
)
def test_state_across_batches_replay_and_folding(spark, raw, tmp_path, guard, want):
    path, checkpoint = str(tmp_path / "topic"), str(tmp_path / "cp")
    publish_each(raw, path, change_batches())
    log = ChangeLog(str(tmp_path / "out"), guard)

    def prices():
        return {r.sku: r.unit_price for r in log.current(spark).collect()}

    drain(log.writer(topic(spark, path), checkpoint))
    assert prices() == want
    forget_last_commit(checkpoint)
    drain(log.writer(topic(spark, path), checkpoint))
    assert prices() == want
    for upto in (0, 0, 1):
        log.fold(spark, upto)
        assert prices() == want
    publish_each(raw, path, [ChangeFeed().drop("desk", 900).texts])
    drain(log.writer(topic(spark, path), checkpoint))
    assert prices() == {k: v for k, v in want.items() if k != "desk"}
    assert sorted(r.raw_json for r in log.dlq(spark).collect()) == ["plainly no JSON", '{"op":"t"}']


def test_merge_writer_hands_over_each_batch_and_keeps_rejects(spark, raw, tmp_path, monkeypatch):
    """MERGE itself needs a catalog that is not here; what reaches it is checked."""
    merged = []
    monkeypatch.setattr(
        state, "merge_into_table", lambda changes, target: merged.append((target, changes.count()))
    )
    path, dlq = str(tmp_path / "topic"), str(tmp_path / "dlq")
    publish_each(raw, path, change_batches())
    drain(state.merge_writer(topic(spark, path), "shop.products", str(tmp_path / "cp"), dlq))
    assert merged == [("shop.products", n) for n in (4, 3, 1)]
    rejects = ChangeLog(dlq).dlq(spark).collect()
    assert sorted((r.batch_id, r.raw_json) for r in rejects) == [
        (1, '{"op":"t"}'),
        (2, "plainly no JSON"),
    ]


def test_unfinished_base_is_ignored(spark, raw, tmp_path):
    path = str(tmp_path / "topic")
    publish_each(raw, path, change_batches()[:2])
    log = ChangeLog(str(tmp_path / "out"))
    drain(log.writer(topic(spark, path), str(tmp_path / "cp")))
    before = rows(log.current(spark))
    Path(log.log.path, "base", "upto=0").mkdir(parents=True)
    assert rows(log.current(spark)) == before
    log.fold(spark, 0)
    assert rows(log.current(spark)) == before


def test_customers_can_be_joined_by_salted_copies(spark, tmp_path):
    """The events of one user meet several copies of the customer; the rows are the same."""
    stream = feed_stream(spark, SF_DIR, salts=5)
    folder = StreamFolder(str(tmp_path))
    query = drain(folder.appended(stream))
    assert "_salt" in query._jsq.explainInternal(False)
    got, want = folder.read(spark, stream.schema), feed(spark, SF_DIR)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
