"""The same inputs as real streams in several waves; results are read back from the sinks.

Waves are published and drained one after the other and every run resumes from the checkpoint, so that
windows are evicted, copies and late events meet state of earlier batches, and versions replace others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidemark.functions.times import instant
from tidemark.operators.changes import (
    applicable_changes,
    flatten_changes,
    latest_change_per_key,
)
from tidemark.operators.decode import parse_cdc_events, parse_events
from tidemark.operators.dedup import dedup_events
from tidemark.operators.repair import DAY, differing_days, repaired_parts, with_day
from tidemark.operators.revenue import (
    revenue_sliding,
    revenue_sliding_closed,
    revenue_table,
    revenue_tumbling,
)
from tidemark.operators.route import split_valid_invalid
from tidemark.operators.state import live_rows
from tidemark.plans.change_queries import CHANGES_SQL, folded_sql, latest_sql
from tidemark.plans.event_queries import FIRST_COPIES_SQL, presented, sent_repeatedly
from tidemark.plans.event_sql import EARLY_SEGMENTS, FEED, WAVE_DELAY_DAYS, sliding, tumbling
from tidemark.schemas import CHANGE_FIELDS, KEY, REVENUE_FIELDS
from tidemark.sources.tables import change_topic, feed
from tidemark.sources.topics import publish, read_file_topic
from tidemark.streaming.balance import Balance, audited_events
from tidemark.streaming.buckets import BucketedState
from tidemark.streaming.folders import Snapshots, Versions
from tidemark.streaming.offsets import OffsetLedger
from tidemark.streaming.routed import RoutedTables
from tidemark.streaming.scratch import scratch_dir
from tidemark.streaming.sinks import StreamFolder, drain, each_batch
from tidemark.streaming.state import LOG_FIELDS, ChangeLog

_WINDOW_KEYS = ("window_start", "window_end", "category")
_REVENUE_FIELDS = {
    "window_start": "timestamp",
    "window_end": "timestamp",
    "category": "string",
    "revenue": "double",
    "orders": "bigint",
}
# Where the waves of the feed are cut; one segment's events of the first part arrive in the last wave.
FIRST_CUT, SECOND_CUT = "2024-01-11T00:00:00Z", "2024-01-21T00:00:00Z"
STRAGGLERS = "BUILDING"
SENT_TWICE = "MACHINERY"
# Offsets of the feed are dealt to three waves in pieces of this length.
PIECE = 300


def by_time() -> list[Column]:
    """Conditions of three waves of the feed, the last with events that come far too late."""
    first, second = instant(FIRST_CUT), instant(SECOND_CUT)
    early = F.col("sent_at") < first
    straggles = early & (F.col("segment") == STRAGGLERS)
    later = (F.col("sent_at") >= first) & (F.col("sent_at") < second)
    return [early & ~straggles, later, straggles | (F.col("sent_at") >= second)]


def in_waves(
    waves: Iterable[DataFrame],
    spark: SparkSession,
    out: str,
    writer: Callable[[DataFrame], DataStreamWriter],
    between: Callable[[int], None] = lambda wave: None,
    after: Callable[[StreamingQuery], None] = lambda query: None,
) -> list[int]:
    """Publish and drain one wave after the other; input rows of every micro-batch that had some."""
    rows = []
    for number, wave in enumerate(waves):
        publish(wave, f"{out}/topic")
        query = drain(writer(read_file_topic(spark, f"{out}/topic")))
        rows += [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        between(number)
        after(query)
    return rows


def feed_waves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    records = feed(spark, sf_dir, "segment", "sent_at")
    return [records.filter(wave) for wave in by_time()]


def _appended(spark, sf_dir, label: str, stream_of, waves) -> DataFrame:
    """Drain waves into a parquet table in append mode."""
    folder = StreamFolder(scratch_dir(spark, label))
    schema = {}

    def writer(topic):
        rows = stream_of(topic)
        schema["of"] = rows.schema
        return folder.appended(rows)

    in_waves(waves, spark, folder.path, writer)
    return folder.read(spark, schema["of"])


def _updated(spark, label: str, stream_of, waves, fields, keys) -> DataFrame:
    """Drain waves of an aggregate into versions of its rows and fold the older ones."""
    out = scratch_dir(spark, label)
    versions = Versions(out, fields, tuple(keys))

    def writer(topic):
        return each_batch(stream_of(topic), versions.apply, f"{out}/checkpoint", "update")

    in_waves(waves, spark, out, writer, lambda wave: wave and versions.fold(spark, wave - 1))
    return versions.current(spark)


def _completed(spark, label: str, stream_of, waves, fields) -> DataFrame:
    """Drain waves of an aggregate into snapshots of all of it."""
    out = scratch_dir(spark, label)
    snapshots = Snapshots(out, fields)

    def writer(topic):
        return each_batch(stream_of(topic), snapshots.apply, f"{out}/checkpoint", "complete")

    in_waves(waves, spark, out, writer)
    return snapshots.current(spark)


def _hourly(topic: DataFrame) -> DataFrame:
    return revenue_tumbling(parse_events(topic, REVENUE_FIELDS), "1 hour")


def _stream_source_count(spark, sf_dir):
    def counts(topic):
        return topic.agg(
            F.count("*").alias("records"), F.sum(F.octet_length("value")).alias("payload_bytes")
        )

    fields = {"records": "bigint", "payload_bytes": "bigint"}
    return _completed(spark, "source", counts, feed_waves(spark, sf_dir), fields)


def _stream_revenue_append(spark, sf_dir):
    return presented(_appended(spark, sf_dir, "append", _hourly, feed_waves(spark, sf_dir)))


def _stream_revenue_update(spark, sf_dir):
    waves = feed_waves(spark, sf_dir)
    return presented(_updated(spark, "update", _hourly, waves, _REVENUE_FIELDS, _WINDOW_KEYS))


def _stream_revenue_complete(spark, sf_dir):
    waves = feed_waves(spark, sf_dir)
    return presented(_completed(spark, "complete", _hourly, waves, _REVENUE_FIELDS))


def _stream_revenue_sliding(spark, sf_dir):
    def five_hours(topic):
        return revenue_sliding(parse_events(topic, REVENUE_FIELDS), "5 hours", "1 hour")

    waves = feed_waves(spark, sf_dir)
    return presented(_updated(spark, "sliding", five_hours, waves, _REVENUE_FIELDS, _WINDOW_KEYS))


def _stream_sliding_chained(spark, sf_dir):
    """Buckets, then windows: two aggregates in one append query."""

    def five_hours(topic):
        return revenue_sliding_closed(parse_events(topic, REVENUE_FIELDS), "5 hours", "1 hour")

    return presented(_appended(spark, sf_dir, "chained", five_hours, feed_waves(spark, sf_dir)))


def _stream_conservation(spark, sf_dir):
    """Waves by time, one segment sent twice in each: invalid, kept, copies, dropped behind the watermark."""
    records = feed(spark, sf_dir, "segment", "sent_at")
    twice = records.union(records.filter(F.col("segment") == SENT_TWICE))
    waves = [twice.filter(wave) for wave in by_time()]
    folder = StreamFolder(scratch_dir(spark, "balance"))
    balance, ended = Balance(), []
    spark.streams.addListener(balance)
    try:
        in_waves(
            waves,
            spark,
            folder.path,
            lambda topic: folder.appended(audited_events(parse_events(topic, REVENUE_FIELDS))),
            after=ended.append,
        )
        rows = balance.of(spark, ended[-1])
    finally:
        spark.streams.removeListener(balance)
    return rows.withColumn("batch_id", F.rank().over(Window.orderBy("batch_id")).cast("bigint") - 1)


def _by_segment(spark, sf_dir) -> list[DataFrame]:
    """Some segments arrive first; the others follow and are late against what was seen."""
    records = feed(spark, sf_dir, "segment")
    early = F.col("segment").isin(*EARLY_SEGMENTS)
    return [records.filter(early), records.filter(~early)]


def _routed_tables(spark, waves, **settings) -> RoutedTables:
    out = scratch_dir(spark, "routed")
    tables = RoutedTables(out, "1 hour", f"{WAVE_DELAY_DAYS} days", **settings)
    in_waves(waves, spark, out, lambda topic: tables.writer(topic, f"{out}/checkpoint"))
    return tables


def _stream_routed_revenue(spark, sf_dir):
    return presented(_routed_tables(spark, _by_segment(spark, sf_dir)).revenue(spark))


def _stream_dlq(spark, sf_dir):
    return _routed_tables(spark, _by_segment(spark, sf_dir)).dlq(spark)


def _stream_routed_folded(spark, sf_dir):
    """Three waves; after the second and the third all older batches are folded."""
    records = feed(spark, sf_dir, "segment")
    early, middle = F.col("segment").isin(*EARLY_SEGMENTS), F.col("segment") == "FURNITURE"
    waves = [records.filter(early), records.filter(middle), records.filter(~early & ~middle)]
    out = scratch_dir(spark, "folded")
    tables = RoutedTables(out, "1 hour", f"{WAVE_DELAY_DAYS} days")
    in_waves(
        waves,
        spark,
        out,
        lambda topic: tables.writer(topic, f"{out}/checkpoint"),
        lambda wave: wave and tables.fold(spark, wave - 1),
    )
    return presented(tables.revenue(spark))


def _stream_dlq_replay(spark, sf_dir):
    """The late events of the stored dead letters are back in the stored revenue, once."""
    tables = _routed_tables(spark, _by_segment(spark, sf_dir))
    tables.replay(spark)
    tables.replay(spark)
    return presented(tables.sliding(spark, "5 hours", "1 hour"))


def _stream_routed_dedup(spark, sf_dir):
    """All records of the first wave are sent again in the second."""
    first, second = _by_segment(spark, sf_dir)
    waves = [first.union(first), second.union(first)]
    tables = _routed_tables(spark, waves, copies_within="40 days")
    return presented(tables.revenue(spark))


def _stream_repair(spark, sf_dir):
    """The stream leaves late events out; the batch finds the windows they are missing from."""
    tables = _routed_tables(spark, _by_segment(spark, sf_dir))
    archive = scratch_dir(spark, "archive")
    events = with_day(split_valid_invalid(parse_events(feed(spark, sf_dir), REVENUE_FIELDS))[0])
    events.write.partitionBy(DAY).parquet(archive)
    events, parts = spark.read.schema(events.schema).parquet(archive), tables.parts(spark)
    repaired = repaired_parts(events, parts, differing_days(events, parts))
    return presented(revenue_table(repaired, "repaired"))


def _stream_offset_gaps(spark, sf_dir):
    """A topic with a hole in the middle, whose last wave brings a piece of the first again."""
    records = feed(spark, sf_dir)
    third = F.pmod(F.floor(F.col("offset") / PIECE), F.lit(3))
    hole = (F.col("offset") % (3 * PIECE)).between(PIECE + 10, PIECE + 19)
    again = (F.col("offset") % (3 * PIECE)).between(5, 7)
    waves = [
        records.filter(third == 0),
        records.filter((third == 1) & ~hole),
        records.filter((third == 2) | again),
    ]
    out = scratch_dir(spark, "offsets")
    ledger = OffsetLedger(out)
    in_waves(waves, spark, out, lambda topic: ledger.writer(topic, f"{out}/checkpoint"))
    return ledger.findings(spark)


def _stream_dedup(spark, sf_dir):
    """Second and third copies come in later waves."""
    sent = sent_repeatedly(feed(spark, sf_dir, "segment"))
    waves = [sent.filter(F.col("attempt") == n) for n in (1, 2, 3)]

    def once(topic):
        valid = split_valid_invalid(parse_events(topic, REVENUE_FIELDS))[0]
        return dedup_events(valid, delay="40 days")

    return presented(_appended(spark, sf_dir, "dedup", once, waves))


def _stream_cdc_state(spark, sf_dir):
    """Finished orders arrive first, open ones second, so the second wave holds older changes."""
    topic = change_topic(spark, sf_dir, "l_linestatus")
    finished = F.col("l_linestatus") == "F"
    out = scratch_dir(spark, "state")
    log = ChangeLog(out)
    waves = [topic.filter(finished), topic.filter(~finished)]
    in_waves(waves, spark, out, lambda records: log.writer(records, f"{out}/checkpoint"))
    log.fold(spark, upto=0)
    return log.current(spark)


def _stream_cdc_update(spark, sf_dir):
    """The state as a streaming aggregate, without a table to merge into, in three waves."""
    topic = change_topic(spark, sf_dir, "l_linenumber")
    waves = [topic.filter(F.col("l_linenumber") % 3 == n) for n in range(3)]

    def latest(records):
        events = parse_cdc_events(records, CHANGE_FIELDS, keep=("offset",))
        return latest_change_per_key(applicable_changes(flatten_changes(events, keep=("offset",))))

    return live_rows(_updated(spark, "keyed", latest, waves, LOG_FIELDS, [KEY]))


def _stream_cdc_partitioned(spark, sf_dir):
    """Three waves into a state that is rewritten bucket by bucket; the last batch arrives twice."""
    topic = change_topic(spark, sf_dir, "l_linenumber")
    waves = [topic.filter(F.col("l_linenumber") % 3 == n) for n in range(3)]
    out = scratch_dir(spark, "buckets")
    state = BucketedState(out, buckets=16)
    in_waves(waves, spark, out, lambda records: state.writer(records, f"{out}/checkpoint"))
    state.apply(waves[-1], state.commits.newest(spark))
    return state.current(spark)


QUERIES = {
    "stream_source_count": _stream_source_count,
    "stream_revenue_append": _stream_revenue_append,
    "stream_revenue_update": _stream_revenue_update,
    "stream_revenue_complete": _stream_revenue_complete,
    "stream_revenue_sliding": _stream_revenue_sliding,
    "stream_sliding_chained": _stream_sliding_chained,
    "stream_conservation": _stream_conservation,
    "stream_routed_revenue": _stream_routed_revenue,
    "stream_routed_folded": _stream_routed_folded,
    "stream_routed_dedup": _stream_routed_dedup,
    "stream_dlq": _stream_dlq,
    "stream_dlq_replay": _stream_dlq_replay,
    "stream_repair": _stream_repair,
    "stream_offset_gaps": _stream_offset_gaps,
    "stream_dedup": _stream_dedup,
    "stream_cdc_state": _stream_cdc_state,
    "stream_cdc_update": _stream_cdc_update,
    "stream_cdc_partitioned": _stream_cdc_partitioned,
}

_EARLY = ", ".join(f"'{s}'" for s in EARLY_SEGMENTS)
_WAVES = f""", boundary AS (
  SELECT max(event_time) - INTERVAL '{WAVE_DELAY_DAYS} days' AS cutoff
  FROM routed WHERE route <> 'malformed_or_unknown' AND segment IN ({_EARLY})
), placed AS (
  SELECT r.*, CASE WHEN segment IN ({_EARLY}) THEN 0 ELSE 1 END AS batch_id,
    CASE WHEN route = 'malformed_or_unknown' THEN route
      WHEN segment NOT IN ({_EARLY}) AND event_time < cutoff THEN 'late' ELSE 'on_time' END AS place
  FROM routed r, boundary
)
"""

# Waves by time: what the watermark before the last wave lets pass, per tumbling or sliding window.
_BY_TIME = f""", waved AS (
  SELECT *, CASE WHEN event_time < TIMESTAMP '2024-01-11' THEN
      CASE segment WHEN '{STRAGGLERS}' THEN 2 ELSE 0 END
    WHEN event_time < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS wave
  FROM sales
), bound AS (
  SELECT max(event_time) FILTER (wave < 2) - INTERVAL '2 minutes' AS before,
    max(event_time) - INTERVAL '2 minutes' AS after
  FROM waved
), hourly AS (
  SELECT date_trunc('hour', event_time) AS window_start,
    date_trunc('hour', event_time) + INTERVAL '1 hour' AS window_end, category, cents
  FROM waved, bound
  WHERE wave < 2 OR date_trunc('hour', event_time) + INTERVAL '1 hour' > before
), five_hours AS (
  SELECT date_trunc('hour', event_time) - i * INTERVAL '1 hour' AS window_start,
    date_trunc('hour', event_time) + (5 - i) * INTERVAL '1 hour' AS window_end, category, cents
  FROM waved, bound, range(5) steps(i)
  WHERE wave < 2 OR date_trunc('hour', event_time) + (5 - i) * INTERVAL '1 hour' > before
)
"""
_SUMS = (
    "SELECT window_start, window_end, category, CAST(sum(cents) AS DOUBLE) AS revenue, "
    "count(*) AS orders"
)
_THREE_WAVES = f""", waved AS (
  SELECT *, CASE WHEN segment IN ({_EARLY}) THEN 0 WHEN segment = 'FURNITURE' THEN 1 ELSE 2 END AS wave
  FROM routed
), highs AS (
  SELECT max(event_time) FILTER (wave < 1) - INTERVAL '{WAVE_DELAY_DAYS} days' AS cutoff1,
    max(event_time) FILTER (wave < 2) - INTERVAL '{WAVE_DELAY_DAYS} days' AS cutoff2
  FROM waved WHERE route <> 'malformed_or_unknown'
)
SELECT date_trunc('hour', event_time) AS window_start,
  date_trunc('hour', event_time) + INTERVAL '1 hour' AS window_end, category,
  CAST(sum(CAST(unit_price AS DECIMAL(18,2)) * quantity) AS DOUBLE) AS revenue, count(*) AS orders
FROM waved, highs
WHERE event_type = 'sale' AND event_time IS NOT NULL
  AND (wave = 0 OR event_time >= CASE wave WHEN 1 THEN cutoff1 ELSE cutoff2 END)
GROUP BY ALL"""
_ROUTED_SQL = f"""{FEED}{_WAVES}
SELECT date_trunc('hour', event_time) AS window_start,
  date_trunc('hour', event_time) + INTERVAL '1 hour' AS window_end, category,
  CAST(sum(CAST(unit_price AS DECIMAL(18,2)) * quantity) AS DOUBLE) AS revenue, count(*) AS orders
FROM placed WHERE place = 'on_time' AND event_type = 'sale' GROUP BY ALL"""

ORACLES = {
    "stream_source_count": f"""{FEED}
SELECT count(*) AS records, CAST(sum(strlen(value)) AS BIGINT) AS payload_bytes FROM records""",
    "stream_revenue_append": f"""{FEED}{_BY_TIME}
{_SUMS} FROM hourly, bound WHERE window_end <= after GROUP BY ALL""",
    "stream_revenue_update": f"{FEED}{_BY_TIME} {_SUMS} FROM hourly GROUP BY ALL",
    "stream_revenue_complete": tumbling("sales", "1 hour"),
    "stream_revenue_sliding": f"{FEED}{_BY_TIME} {_SUMS} FROM five_hours GROUP BY ALL",
    "stream_sliding_chained": f"""{FEED}{_BY_TIME}, chained AS (
  SELECT window_start - i * INTERVAL '1 hour' AS window_start,
    window_end + (4 - i) * INTERVAL '1 hour' AS window_end, category, cents
  FROM hourly, range(5) steps(i)
)
{_SUMS} FROM chained, bound WHERE window_end <= after GROUP BY ALL""",
    "stream_conservation": f"""{FEED}, wired AS (
  SELECT d.*, f.sec FROM decoded d JOIN fields f
    ON f.n = CAST(regexp_extract(coalesce(d.event_id, d.raw_json), '[0-9]+$') AS BIGINT)
), sent AS (
  SELECT *, event_type IN ('sale', 'stock') AND event_time IS NOT NULL AS valid,
    CASE WHEN segment = '{SENT_TWICE}' THEN 2 ELSE 1 END AS times,
    CASE WHEN sec < TIMESTAMP '2024-01-11' THEN CASE segment WHEN '{STRAGGLERS}' THEN 2 ELSE 0 END
      WHEN sec < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS wave
  FROM wired
), passed AS (
  SELECT wave, max(event_time) FILTER (valid) - INTERVAL '2 minutes' AS high FROM sent GROUP BY wave
), judged AS (
  SELECT s.*, coalesce(event_time <= (SELECT max(high) FROM passed p WHERE p.wave < s.wave), false) AS gone
  FROM sent s
)
SELECT CAST(wave AS BIGINT) AS batch_id, CAST(sum(times) AS BIGINT) AS n_in,
  CAST(coalesce(sum(times) FILTER (valid IS NOT TRUE), 0) AS BIGINT) AS n_invalid,
  count(*) FILTER (valid AND NOT gone) AS n_kept,
  CAST(coalesce(sum(times - 1) FILTER (valid AND NOT gone), 0) AS BIGINT) AS n_copies,
  CAST(coalesce(sum(times) FILTER (valid AND gone), 0) AS BIGINT) AS n_dropped, true AS conserved
FROM judged GROUP BY wave""",
    "stream_routed_revenue": _ROUTED_SQL,
    "stream_routed_folded": f"{FEED}{_THREE_WAVES}",
    "stream_routed_dedup": _ROUTED_SQL,
    "stream_dlq_replay": sliding("sales", "5 hours", "1 hour", 5),
    "stream_dlq": f"""{FEED}{_WAVES}
SELECT coalesce(event_id, 'unknown') AS event_id, raw_json, place AS dlq_reason,
  CAST(batch_id AS BIGINT) AS batch_id
FROM placed WHERE place <> 'on_time'""",
    "stream_repair": f"""{FEED}{_WAVES}, sold AS (
  SELECT date_trunc('hour', event_time) AS window_start, category, place,
    CAST(unit_price AS DECIMAL(18,2)) * quantity AS cents
  FROM placed WHERE event_type = 'sale' AND event_time IS NOT NULL
), wrong AS (
  SELECT DISTINCT window_start FROM sold WHERE place = 'late'
)
SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, category,
  CAST(sum(cents) AS DOUBLE) AS revenue, count(*) AS orders,
  window_start IN (SELECT window_start FROM wrong) AS repaired
FROM sold GROUP BY ALL""",
    "stream_offset_gaps": f"""{FEED}, placed AS (
  SELECT n, n // {PIECE} % 3 AS wave, n % {3 * PIECE} AS spot FROM records
), sent AS (
  SELECT n, wave FROM placed WHERE wave <> 1 OR spot NOT BETWEEN {PIECE + 10} AND {PIECE + 19}
  UNION ALL SELECT n, 2 FROM placed WHERE spot BETWEEN 5 AND 7
), runs AS (
  SELECT wave, min(n) AS first, max(n) AS last FROM (
    SELECT wave, n, n - row_number() OVER (PARTITION BY wave ORDER BY n) AS run FROM sent) GROUP BY wave, run
), reached AS (
  SELECT *, max(last) OVER (ORDER BY first, wave ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto
  FROM runs
)
SELECT CAST(wave AS BIGINT) AS batch_id, 0 AS partition, 'gap' AS kind, upto + 1 AS first, first - 1 AS last
FROM reached WHERE first > upto + 1
UNION ALL
SELECT wave, 0, 'overlap', first, least(last, upto) FROM reached WHERE first <= upto""",
    "stream_dedup": f"{FEED} {FIRST_COPIES_SQL}",
    "stream_cdc_state": folded_sql("l_linestatus DESC, ts_ms DESC"),
    "stream_cdc_partitioned": folded_sql("l_linenumber % 3 DESC, ts_ms DESC"),
    "stream_cdc_update": f"""{CHANGES_SQL}, latest AS ({latest_sql("ts_ms DESC")})
SELECT sku, category, unit_price, stock, updated_at FROM latest WHERE op <> 'd'""",
}
