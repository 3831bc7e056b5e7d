"""Event branch: decode, route, dead letters, windowed revenue, lateness, copies, replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import event_time, utc_wall_clock, wire_text
from tidemark.operators.audit import conservation, reason_counts
from tidemark.operators.decode import decode_with_raw, parse_events
from tidemark.operators.dedup import dedup_events
from tidemark.operators.fields import field_error_counts
from tidemark.operators.encode import build_events, encode_records, event_key
from tidemark.operators.lateness import mark_late
from tidemark.operators.replay import replay_late
from tidemark.operators.revenue import (
    in_window_order,
    revenue_parts,
    revenue_sliding,
    revenue_table,
    revenue_tumbling,
    sale_revenue,
)
from tidemark.operators.route import (
    as_dlq,
    dead_letters,
    on_time,
    split_on_time_late,
    split_valid_invalid,
    with_route,
)
from tidemark.plans.event_sql import (
    CUTOFF,
    CUTOFF_SQL,
    EVENT_COLUMNS,
    FEED,
    LATE_DELAY_DAYS,
    sliding,
    tumbling,
)
from tidemark.schemas import EVENT_FIELDS, REASON_MALFORMED, REVENUE_FIELDS, SALE
from tidemark.sources.tables import bulk_sales, feed, spoiled_records, table, typed_feed

_TIMES = ("event_time", "window_start", "window_end", "cutoff")


def presented(df: DataFrame) -> DataFrame:
    """Instants as UTC wall clocks, which every SQL engine shows alike."""
    return df.withColumns({c: utc_wall_clock(c) for c in _TIMES if c in df.columns})


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_route(decode_with_raw(feed(spark, sf_dir), REVENUE_FIELDS), CUTOFF)


def _bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bulk_sales(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"))


def routed_revenue(spark, sf_dir):
    """Raw records to revenue per category and hour of the on-time sales."""
    return presented(revenue_tumbling(on_time(_routed(spark, sf_dir)), "1 hour"))


def _encode_records(spark, sf_dir):
    return encode_records(typed_feed(spark, sf_dir)).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def _event_key(spark, sf_dir):
    return typed_feed(spark, sf_dir).select("event_id", event_key().alias("key"))


def _build_events(spark, sf_dir):
    sales = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    sales = sales.select(
        F.concat_ws("-", F.lit("sale"), "l_orderkey", "l_linenumber").alias("event_id"),
        wire_text("l_shipdate").alias("ts"),
        F.concat(F.lit("O"), "l_orderkey").alias("order_id"),
        F.col("p_brand").alias("category"),
        F.col("l_quantity").alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
    )
    moves = typed_feed(spark, sf_dir).filter(F.col("event_type") == "stock")
    moves = moves.select("event_id", "ts", "sku", "category", "warehouse", "quantity_delta")
    return build_events(sales, moves)


def _decode_with_raw(spark, sf_dir):
    return presented(decode_with_raw(feed(spark, sf_dir)))


def _parse_events(spark, sf_dir):
    return presented(parse_events(feed(spark, sf_dir)))


def _valid_events(spark, sf_dir):
    return presented(split_valid_invalid(parse_events(feed(spark, sf_dir)))[0])


def _invalid_events(spark, sf_dir):
    invalid = split_valid_invalid(decode_with_raw(feed(spark, sf_dir)))[1]
    return presented(invalid.select("raw_json", "event_type", "event_id", "event_time"))


def _on_time_events(spark, sf_dir):
    valid = split_valid_invalid(parse_events(feed(spark, sf_dir)))[0]
    return presented(split_on_time_late(valid, CUTOFF)[0])


def _late_events(spark, sf_dir):
    valid = split_valid_invalid(parse_events(feed(spark, sf_dir)))[0]
    return presented(split_on_time_late(valid, CUTOFF)[1])


def _dlq_records(spark, sf_dir):
    return dead_letters(_routed(spark, sf_dir))


def _dlq_reencoded(spark, sf_dir):
    """Rejects whose payload was not kept: the row is encoded, then read back field by field."""
    invalid = split_valid_invalid(parse_events(feed(spark, sf_dir)))[1]
    dlq = as_dlq(invalid, REASON_MALFORMED).withColumnRenamed("event_id", "dlq_event_id")
    again = parse_events(
        dlq.withColumn("value", F.col("raw_json")), keep=("dlq_event_id", "dlq_reason")
    )
    return again.select("dlq_event_id", "dlq_reason", *EVENT_FIELDS)


def _dlq_reason_counts(spark, sf_dir):
    return reason_counts(dead_letters(_routed(spark, sf_dir)))


def _conservation_audit(spark, sf_dir):
    return conservation(_routed(spark, sf_dir))


def _sale_revenue(spark, sf_dir):
    sales = sale_revenue(parse_events(feed(spark, sf_dir), REVENUE_FIELDS))
    return presented(sales.select("event_id", "category", "event_time", "revenue"))


def _revenue_tumbling(spark, sf_dir):
    events = parse_events(feed(spark, sf_dir), REVENUE_FIELDS)
    return presented(revenue_tumbling(events, "1 hour"))


def _revenue_tumbling_sorted(spark, sf_dir):
    events = parse_events(feed(spark, sf_dir), REVENUE_FIELDS)
    return presented(in_window_order(revenue_tumbling(events, "1 minute")))


def _revenue_sliding(spark, sf_dir):
    events = parse_events(feed(spark, sf_dir), REVENUE_FIELDS)
    return presented(revenue_sliding(events, "5 hours", "1 hour"))


def _bulk_revenue_tumbling(spark, sf_dir):
    return presented(revenue_tumbling(_bulk(spark, sf_dir), "7 days"))


def _bulk_revenue_sliding(spark, sf_dir):
    return presented(revenue_sliding(_bulk(spark, sf_dir), "28 days", "7 days"))


def _late_by_microbatch(spark, sf_dir):
    arrivals = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("o_orderkey div 1000").alias("batch_id"),
        F.col("o_orderdate").alias("event_time"),
    )
    return presented(mark_late(arrivals, delay=f"{LATE_DELAY_DAYS} days"))


def sent_repeatedly(records: DataFrame) -> DataFrame:
    """One segment's records arrive three times each, a tenth of a second later each time."""
    sends = F.when(F.col("segment") == "BUILDING", 3).otherwise(1)
    copies = records.select("*", F.explode(F.sequence(F.lit(1), sends)).alias("attempt"))
    later = F.concat(F.lit("."), F.col("attempt").cast("string"), F.lit('Z"'))
    text = F.replace(F.col("value").cast("string"), F.lit('Z"'), later)
    return copies.withColumn("value", text.cast("binary"))


def _dedup_events(spark, sf_dir):
    sent = sent_repeatedly(feed(spark, sf_dir, "segment"))
    valid = split_valid_invalid(parse_events(sent, REVENUE_FIELDS))[0]
    return presented(dedup_events(valid))


def _wire_times(spark, sf_dir):
    """Times in all forms a producer may send; half of them are no full date and time."""
    form = F.col("event_id") % 6
    clock = F.substring(wire_text("ts"), 1, 19)
    text = (
        F.when(form == 0, F.concat(clock, F.lit("Z")))
        .when(form == 1, clock)
        .when(form == 2, F.concat(clock, F.lit("+02:00")))
        .when(form == 3, F.substring(clock, 11, 9))
        .when(form == 4, F.substring(clock, 1, 10))
        .otherwise(F.substring(clock, 12, 5))
    )
    sent = table(spark, sf_dir, "events").select("event_id", text.alias("sent"))
    return presented(sent.select("event_id", "sent", event_time("sent").alias("event_time")))


def _fractional_revenue(spark, sf_dir):
    """Prices with many decimals and ties at half a cent."""
    line = table(spark, sf_dir, "lineitem")
    price = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_extendedprice") / 8).otherwise(
        F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    )
    sales = line.select(
        F.lit(SALE).alias("event_type"),
        F.col("l_returnflag").alias("category"),
        F.col("l_linenumber").alias("quantity"),
        price.alias("unit_price"),
        F.col("l_shipdate").alias("event_time"),
    )
    return presented(revenue_tumbling(sales, "28 days"))


def _dlq_replay_revenue(spark, sf_dir):
    routed = _routed(spark, sf_dir)
    parts = revenue_parts(on_time(routed), "1 day")
    return presented(revenue_table(replay_late(parts, dead_letters(routed), "1 day")))


def _decode_field_errors(spark, sf_dir):
    return field_error_counts(spoiled_records(feed(spark, sf_dir)))


QUERIES = {
    "routed_revenue": routed_revenue,
    "decode_field_errors": _decode_field_errors,
    "encode_records": _encode_records,
    "event_key": _event_key,
    "build_events": _build_events,
    "decode_with_raw": _decode_with_raw,
    "parse_events": _parse_events,
    "valid_events": _valid_events,
    "invalid_events": _invalid_events,
    "on_time_events": _on_time_events,
    "late_events": _late_events,
    "dlq_records": _dlq_records,
    "dlq_reencoded": _dlq_reencoded,
    "dlq_reason_counts": _dlq_reason_counts,
    "conservation_audit": _conservation_audit,
    "sale_revenue": _sale_revenue,
    "revenue_tumbling": _revenue_tumbling,
    "revenue_tumbling_sorted": _revenue_tumbling_sorted,
    "revenue_sliding": _revenue_sliding,
    "bulk_revenue_tumbling": _bulk_revenue_tumbling,
    "bulk_revenue_sliding": _bulk_revenue_sliding,
    "late_by_microbatch": _late_by_microbatch,
    "dedup_events": _dedup_events,
    "dlq_replay_revenue": _dlq_replay_revenue,
    "wire_times": _wire_times,
    "fractional_revenue": _fractional_revenue,
}

FIRST_COPIES_SQL = """
SELECT event_type, event_id, replace(ts, 'Z', '.1Z') AS ts, category, quantity, unit_price,
  event_time + INTERVAL '100 milliseconds' AS event_time
FROM routed WHERE route <> 'malformed_or_unknown'"""
_NO_TIME = EVENT_COLUMNS.removesuffix(", event_time")

_EVENT_NAMES = f"[{', '.join(repr(name) for name in EVENT_FIELDS)}]"

ORACLES = {
    "decode_field_errors": f"""{FEED}, spoiled AS (
  SELECT CASE n % 11
    WHEN 1 THEN regexp_replace(value, '"quantity":([0-9]+)', '"quantity":"\\1"')
    WHEN 2 THEN regexp_replace(value, '^\\{{', '{{"coupon":"none",')
    WHEN 3 THEN regexp_replace(value, '"category":"[^"]*"', '"category":null')
    WHEN 4 THEN regexp_replace(value, '"event_id":"[^"]*",', '') ELSE value END AS value
  FROM records
), judged AS (
  SELECT CASE WHEN json_valid(value) THEN value::JSON END AS body FROM spoiled
), looked AS (
  SELECT body, field, json_type(body, '$.' || field) AS kind
  FROM judged, (SELECT unnest({_EVENT_NAMES}) AS field) WHERE body IS NOT NULL
), errors AS (
  SELECT field, CASE WHEN kind IS NULL THEN
      CASE WHEN field IN ('event_type', 'event_id', 'ts') THEN 'absent' END
    WHEN kind = 'NULL' THEN 'null'
    WHEN field IN ('quantity', 'quantity_delta') THEN
      CASE WHEN kind NOT IN ('BIGINT', 'UBIGINT') THEN 'wrong_type' END
    WHEN field = 'unit_price' THEN CASE WHEN kind NOT IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'wrong_type' END
    WHEN kind <> 'VARCHAR' THEN 'wrong_type' END AS error
  FROM looked
  UNION ALL
  SELECT field, 'unknown_field' FROM (SELECT unnest(json_keys(body)) AS field FROM judged)
  WHERE NOT list_contains({_EVENT_NAMES}, field)
  UNION ALL
  SELECT NULL, 'not_an_object' FROM judged WHERE body IS NULL
)
SELECT field, error, count(*) AS records FROM errors WHERE error IS NOT NULL GROUP BY ALL""",
    "routed_revenue": tumbling("sales", "1 hour", "route = 'on_time'"),
    "encode_records": f"{FEED} SELECT key, body AS value FROM records",
    "event_key": f"{FEED} SELECT event_id, coalesce(order_id, sku, event_id) AS key FROM fields",
    "build_events": f"""{FEED}
SELECT 'sale' AS event_type, concat_ws('-', 'sale', l_orderkey, l_linenumber) AS event_id,
  strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS ts, 'O' || l_orderkey AS order_id,
  CAST(NULL AS VARCHAR) AS customer_id, p_brand AS category, CAST(l_quantity AS INTEGER) AS quantity,
  p_retailprice AS unit_price, CAST(NULL AS VARCHAR) AS sku, CAST(NULL AS VARCHAR) AS warehouse,
  CAST(NULL AS INTEGER) AS quantity_delta
FROM lineitem JOIN part ON l_partkey = p_partkey
UNION ALL
SELECT event_type, event_id, ts, NULL, NULL, category, NULL, NULL, sku, warehouse, quantity_delta
FROM fields WHERE event_type = 'stock'""",
    "decode_with_raw": f"{FEED} SELECT raw_json, {EVENT_COLUMNS} FROM decoded",
    "parse_events": f"{FEED} SELECT {EVENT_COLUMNS} FROM decoded",
    "valid_events": f"{FEED} SELECT {EVENT_COLUMNS} FROM routed WHERE route IN ('on_time', 'late')",
    "invalid_events": f"""{FEED} SELECT raw_json, event_type, event_id, event_time
FROM routed WHERE route = 'malformed_or_unknown'""",
    "on_time_events": f"{FEED} SELECT {EVENT_COLUMNS} FROM routed WHERE route = 'on_time'",
    "late_events": f"{FEED} SELECT {EVENT_COLUMNS} FROM routed WHERE route = 'late'",
    "dlq_records": f"""{FEED}
SELECT coalesce(event_id, 'unknown') AS event_id, raw_json, route AS dlq_reason
FROM routed WHERE route <> 'on_time'""",
    "dlq_reencoded": f"""{FEED}
SELECT coalesce(event_id, 'unknown') AS dlq_event_id, 'malformed_or_unknown' AS dlq_reason, {_NO_TIME}
FROM routed WHERE route = 'malformed_or_unknown'""",
    "dlq_reason_counts": f"""{FEED}
SELECT route AS dlq_reason, count(*) AS records FROM routed WHERE route <> 'on_time' GROUP BY 1""",
    "conservation_audit": f"""{FEED}, counts AS (
  SELECT (SELECT count(*) FROM records) AS n_in,
    count(*) FILTER (event_type IN ('sale', 'stock') AND event_id IS NOT NULL
      AND event_time IS NOT NULL) AS n_valid,
    count(*) FILTER (event_type IS NULL OR event_type NOT IN ('sale', 'stock')
      OR event_id IS NULL OR event_time IS NULL) AS n_invalid,
    count(*) FILTER (event_time >= {CUTOFF_SQL} AND event_type IN ('sale', 'stock')) AS n_on_time,
    count(*) FILTER (event_time < {CUTOFF_SQL} AND event_type IN ('sale', 'stock')) AS n_late,
    count(*) FILTER (route <> 'on_time') AS n_dlq
  FROM routed
)
SELECT *, n_in = n_valid + n_invalid AND n_valid = n_on_time + n_late
  AND n_in = n_on_time + n_dlq AS conserved
FROM counts""",
    "sale_revenue": f"""{FEED}
SELECT event_id, category, event_time,
  CAST(CAST(unit_price AS DECIMAL(18,2)) * quantity AS DOUBLE) AS revenue
FROM decoded WHERE event_type = 'sale'""",
    "revenue_tumbling": tumbling("sales", "1 hour"),
    "revenue_tumbling_sorted": tumbling("sales", "1 minute")
    + " ORDER BY window_start, category",
    "revenue_sliding": sliding("sales", "5 hours", "1 hour", 5),
    "bulk_revenue_tumbling": tumbling("bulk", "7 days"),
    "bulk_revenue_sliding": sliding("bulk", "28 days", "7 days", 4),
    "late_by_microbatch": f"""
WITH highs AS (
  SELECT o_orderkey // 1000 AS batch_id, max(o_orderdate) AS high FROM orders GROUP BY 1
), cutoffs AS (
  SELECT batch_id, max(high) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING) - INTERVAL '{LATE_DELAY_DAYS} days' AS cutoff FROM highs
)
SELECT o_orderkey, batch_id, o_orderdate AS event_time, cutoff,
  coalesce(o_orderdate < cutoff, false) AS is_late
FROM orders JOIN cutoffs ON batch_id = o_orderkey // 1000""",
    "dedup_events": f"{FEED} {FIRST_COPIES_SQL}",
    "wire_times": """
WITH clocks AS (
  SELECT event_id, event_id % 6 AS form, date_trunc('second', ts) AS sec,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS clock FROM events
)
SELECT event_id,
  CASE form WHEN 0 THEN clock || 'Z' WHEN 1 THEN clock WHEN 2 THEN clock || '+02:00'
    WHEN 3 THEN substr(clock, 11, 9) WHEN 4 THEN substr(clock, 1, 10)
    ELSE substr(clock, 12, 5) END AS sent,
  CASE WHEN form < 2 THEN sec WHEN form = 2 THEN sec - INTERVAL '2 hours' END AS event_time
FROM clocks""",
    "fractional_revenue": """
WITH amounts AS (
  SELECT l_returnflag AS category, l_shipdate, l_linenumber * CASE WHEN l_linenumber % 2 = 0
    THEN l_extendedprice / 8 ELSE l_extendedprice * (1 - l_discount) * (1 + l_tax) END AS amount
  FROM lineitem
)
SELECT time_bucket(INTERVAL '28 days', l_shipdate, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL '28 days', l_shipdate, TIMESTAMP '1970-01-01') + INTERVAL '28 days'
    AS window_end, category,
  CAST(sum(round(CAST(CAST(amount AS VARCHAR) AS DECIMAL(38, 16)), 2)) AS DOUBLE) AS revenue,
  count(*) AS orders
FROM amounts GROUP BY ALL""",
    "dlq_replay_revenue": f"""{FEED}, daily AS (
  SELECT date_trunc('day', event_time) AS window_start, category,
    CAST(sum(cents) AS DOUBLE) AS revenue, count(*) AS orders,
    count(*) FILTER (route = 'late') AS late
  FROM sales GROUP BY 1, 2
)
SELECT window_start, window_start + INTERVAL '1 day' AS window_end, category, revenue, orders
FROM daily WHERE late > 0""",
}
