"""Change branch: envelopes, flat changes, compaction, merge, folding of batches, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.chains import chain_breaks
from tidemark.operators.changes import (
    applicable_changes,
    change_dead_letters,
    flatten_changes,
    latest_change_per_key,
    value_changes,
)
from tidemark.operators.decode import parse_cdc_events
from tidemark.operators.state import fold_changes, merge_changes
from tidemark.schemas import CHANGE_FIELDS
from tidemark.sources.tables import LOSSES, chained_records, change_topic, product_state, table

CHANGES_SQL = """
WITH lines AS (
  SELECT *, CASE l_returnflag WHEN 'R' THEN 'd' WHEN 'A' THEN 'u' ELSE 'c' END AS line_op,
    CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN 'text'
      WHEN l_discount = 0.1 AND l_tax = 0.0 THEN 'truncate' ELSE 'change' END AS kind,
    (l_orderkey * 8 + l_linenumber) * 1000000000 + l_partkey AS "offset",
    CASE l_linenumber WHEN 7 THEN 'NEW' ELSE 'SKU' END || l_partkey AS line_sku,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS shipped
  FROM lineitem
), envelopes AS (
  SELECT line_op AS op, epoch_ms(l_shipdate) AS ts_ms, "offset", l_linenumber, l_linestatus,
    line_sku AS key,
    CASE WHEN line_op <> 'c' THEN line_sku END AS before_sku,
    CASE WHEN line_op <> 'c' THEN l_extendedprice * (1 - l_discount) END AS before_price,
    CASE WHEN line_op <> 'd' THEN line_sku END AS after_sku,
    CASE WHEN line_op <> 'd' THEN l_extendedprice END AS after_price,
    CASE WHEN line_op <> 'd' THEN 'S' || l_suppkey END AS category,
    CASE WHEN line_op <> 'd' THEN CAST(l_quantity AS INTEGER) END AS stock,
    CASE WHEN line_op <> 'd' THEN shipped END AS updated_at
  FROM lines WHERE kind = 'change'
  UNION ALL
  SELECT 't', NULL, "offset", l_linenumber, l_linestatus, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    NULL
  FROM lines WHERE kind = 'truncate'
), changes AS (
  SELECT key AS sku, category, after_price AS unit_price, stock, updated_at, op, ts_ms, "offset",
    l_linenumber, l_linestatus
  FROM envelopes WHERE op <> 't'
)
"""

_TIES = '"offset" DESC, category DESC NULLS LAST, op DESC, stock DESC NULLS LAST, unit_price DESC'


def latest_sql(order: str) -> str:
    """The last row of ``changes`` per key in an order, deletes included."""
    return f"""SELECT * FROM changes QUALIFY row_number() OVER (
  PARTITION BY sku ORDER BY {order}, {_TIES}) = 1"""


def folded_sql(order: str) -> str:
    """The state after folding ``changes`` in an order."""
    return f"""{CHANGES_SQL}, latest AS ({latest_sql(order)})
SELECT sku, category, unit_price, stock, updated_at FROM latest WHERE op <> 'd'"""


def _changes(spark, sf_dir, *extra):
    topic = change_topic(spark, sf_dir, *extra)
    events = parse_cdc_events(topic, CHANGE_FIELDS, keep=("offset", *extra))
    return flatten_changes(events, keep=("offset", *extra))


def _cdc_parse(spark, sf_dir):
    return parse_cdc_events(change_topic(spark, sf_dir)).select(
        "op",
        "ts_ms",
        F.col("before.sku").alias("before_sku"),
        F.col("before.unit_price").alias("before_price"),
        F.col("after.sku").alias("after_sku"),
        F.col("after.unit_price").alias("after_price"),
    )


def _cdc_flatten(spark, sf_dir):
    return _changes(spark, sf_dir)


def _cdc_latest_per_key(spark, sf_dir):
    return latest_change_per_key(applicable_changes(_changes(spark, sf_dir)))


def _cdc_merge(spark, sf_dir):
    state = product_state(table(spark, sf_dir, "part"))
    return merge_changes(state, _changes(spark, sf_dir))


def _cdc_fold_batches(spark, sf_dir):
    return fold_changes(_changes(spark, sf_dir, "l_linenumber"), "l_linenumber")


def _cdc_fold_guarded(spark, sf_dir):
    log = _changes(spark, sf_dir, "l_linenumber")
    return fold_changes(log, "l_linenumber", guard_stale=True)


def _cdc_price_changes(spark, sf_dir):
    events = parse_cdc_events(change_topic(spark, sf_dir), keep=("offset",))
    return value_changes(events, "unit_price", keep=("offset",))


def _cdc_dead_letters(spark, sf_dir):
    return change_dead_letters(change_topic(spark, sf_dir))


def _cdc_chain_breaks(spark, sf_dir):
    records = chained_records(table(spark, sf_dir, "lineitem"))
    return chain_breaks(parse_cdc_events(records, keep=("offset",)))


QUERIES = {
    "cdc_parse": _cdc_parse,
    "cdc_flatten": _cdc_flatten,
    "cdc_latest_per_key": _cdc_latest_per_key,
    "cdc_merge": _cdc_merge,
    "cdc_fold_batches": _cdc_fold_batches,
    "cdc_fold_guarded": _cdc_fold_guarded,
    "cdc_price_changes": _cdc_price_changes,
    "cdc_dead_letters": _cdc_dead_letters,
    "cdc_chain_breaks": _cdc_chain_breaks,
}

ORACLES = {
    "cdc_parse": f"""{CHANGES_SQL}
SELECT op, ts_ms, before_sku, before_price, after_sku, after_price FROM envelopes""",
    "cdc_flatten": f"""{CHANGES_SQL}
SELECT key AS sku, category, after_price AS unit_price, stock, updated_at, op, ts_ms, "offset"
FROM envelopes""",
    "cdc_latest_per_key": f"""{CHANGES_SQL}, latest AS ({latest_sql("ts_ms DESC")})
SELECT sku, category, unit_price, stock, updated_at, op, ts_ms, "offset" FROM latest""",
    "cdc_merge": f"""{CHANGES_SQL}, latest AS ({latest_sql("ts_ms DESC")}), state AS (
  SELECT 'SKU' || p_partkey AS sku, p_brand AS category, p_retailprice AS unit_price,
    p_size AS stock, '1995-01-01T00:00:00Z' AS updated_at
  FROM part
)
SELECT * FROM state WHERE sku NOT IN (SELECT sku FROM latest)
UNION ALL
SELECT sku, category, unit_price, stock, updated_at FROM latest WHERE op <> 'd'""",
    "cdc_fold_batches": folded_sql("l_linenumber DESC, ts_ms DESC"),
    "cdc_fold_guarded": folded_sql("ts_ms DESC, l_linenumber DESC"),
    "cdc_price_changes": f"""{CHANGES_SQL}
SELECT key AS sku, op, ts_ms, "offset", before_price AS old_value, after_price AS new_value
FROM envelopes WHERE before_price IS DISTINCT FROM after_price""",
    "cdc_chain_breaks": f"""
WITH lines AS (
  SELECT 'SKU' || l_partkey AS sku, l_orderkey,
    (l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS line, row_number() OVER log AS n,
    lag((l_suppkey, l_extendedprice, l_quantity, l_shipdate)) OVER log AS line_before
  FROM lineitem WINDOW log AS (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber)
), arrived AS (
  SELECT sku, n, CASE WHEN n % 4 <> 1 THEN line_before END AS before,
    CASE WHEN n % 4 <> 0 THEN line END AS after
  FROM lines WHERE l_orderkey % {LOSSES} <> 0
), linked AS (
  SELECT *, lag(after) OVER (PARTITION BY sku ORDER BY n) IS DISTINCT FROM before AS breaks FROM arrived
)
SELECT sku, count(*) AS changes, count(after) - count(before) AS standing
FROM linked GROUP BY sku HAVING bool_or(breaks)""",
    "cdc_dead_letters": f"""{CHANGES_SQL}
SELECT 'unknown' AS event_id,
  CASE kind WHEN 'text' THEN 'no change ' || "offset" ELSE '{{"op":"t"}}' END AS raw_json,
  'malformed_or_unknown' AS dlq_reason
FROM lines WHERE kind <> 'change'""",
}
