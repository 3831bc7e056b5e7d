"""SQL of the event branch, for DuckDB, written from the tables and not from the encoded topic."""

from __future__ import annotations

CUTOFF = "2024-01-15T09:30:00Z"
CUTOFF_SQL = "TIMESTAMP '2024-01-15 09:30:00'"
LATE_DELAY_DAYS = 730
WAVE_DELAY_DAYS = 10
EARLY_SEGMENTS = ("AUTOMOBILE", "BUILDING")

FEED = """
WITH base AS (
  SELECT e.event_id AS n, e.event_type AS kind, e.user_id, e.value, c.c_mktsegment, c.c_nationkey,
    CAST(regexp_extract(e.props, '[0-9]+') AS INTEGER) AS k,
    date_trunc('second', e.ts) AS sec,
    CASE e.event_type WHEN 'purchase' THEN 'sale' WHEN 'view' THEN 'stock'
      WHEN 'click' THEN 'stock' ELSE e.event_type END AS wire_type
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
), fields AS (
  SELECT n, kind, k, sec, c_mktsegment AS segment, wire_type AS event_type,
    wire_type || '-' || n AS event_id,
    CASE WHEN k = 0 THEN 'around noon' ELSE strftime(sec, '%Y-%m-%dT%H:%M:%SZ') END AS ts,
    CASE WHEN wire_type = 'sale' THEN 'O' || n END AS order_id,
    CASE WHEN wire_type = 'sale' THEN 'C' || user_id END AS customer_id,
    CASE WHEN wire_type IN ('sale', 'stock') THEN c_mktsegment END AS category,
    CASE WHEN wire_type = 'sale' THEN k END AS quantity,
    CASE WHEN wire_type = 'sale' THEN value END AS unit_price,
    CASE WHEN wire_type = 'stock' THEN 'SKU' || user_id END AS sku,
    CASE WHEN wire_type = 'stock' THEN 'W' || c_nationkey END AS warehouse,
    CASE WHEN wire_type = 'stock' THEN k END AS quantity_delta
  FROM base
), records AS (
  SELECT n, segment, body, coalesce(order_id, sku, event_id) AS key,
    CASE WHEN kind = 'error' THEN 'error ' || n ELSE body END AS value
  FROM (SELECT *, '{' || concat_ws(',',
      '"category":"' || category || '"', '"customer_id":"' || customer_id || '"',
      '"event_id":"' || event_id || '"', '"event_type":"' || event_type || '"',
      '"order_id":"' || order_id || '"', '"quantity":' || quantity,
      '"quantity_delta":' || quantity_delta, '"sku":"' || sku || '"', '"ts":"' || ts || '"',
      '"unit_price":' || unit_price, '"warehouse":"' || warehouse || '"') || '}' AS body
    FROM fields)
), decoded AS (
  SELECT r.value AS raw_json, r.segment, f.event_type, f.event_id, f.ts, f.order_id, f.customer_id,
    f.category, f.quantity, f.unit_price, f.sku, f.warehouse, f.quantity_delta,
    CASE WHEN f.k > 0 THEN f.sec END AS event_time
  FROM records r LEFT JOIN fields f ON r.n = f.n AND f.kind <> 'error'
), routed AS (
  SELECT *, CASE WHEN coalesce(event_type IN ('sale', 'stock'), false) AND event_id IS NOT NULL
      AND event_time IS NOT NULL THEN
    CASE WHEN event_time < {cutoff} THEN 'late' ELSE 'on_time' END
    ELSE 'malformed_or_unknown' END AS route
  FROM decoded
), sales AS (
  SELECT *, CAST(unit_price AS DECIMAL(18,2)) * quantity AS cents
  FROM routed WHERE event_type = 'sale' AND event_time IS NOT NULL
), bulk AS (
  SELECT p_brand AS category, l_shipdate AS event_time,
    CAST(p_retailprice AS DECIMAL(18,2)) * CAST(l_quantity AS INTEGER) AS cents
  FROM lineitem JOIN part ON l_partkey = p_partkey
)
""".replace("{cutoff}", CUTOFF_SQL)

EVENT_COLUMNS = (
    "event_type, event_id, ts, order_id, customer_id, category, quantity, unit_price, sku, "
    "warehouse, quantity_delta, event_time"
)


def tumbling(source: str, width: str, where: str = "true") -> str:
    """Windowed revenue of a CTE with ``event_time``, ``category`` and ``cents``."""
    start = f"time_bucket(INTERVAL '{width}', event_time, TIMESTAMP '1970-01-01')"
    return f"""{FEED}
SELECT {start} AS window_start, {start} + INTERVAL '{width}' AS window_end, category,
  CAST(sum(cents) AS DOUBLE) AS revenue, count(*) AS orders
FROM {source} WHERE {where} GROUP BY ALL"""


def sliding(source: str, width: str, slide: str, ratio: int, where: str = "true") -> str:
    """As `tumbling`, with ``ratio`` overlapping windows per row."""
    last = f"time_bucket(INTERVAL '{slide}', event_time, TIMESTAMP '1970-01-01')"
    return f"""{FEED}, spread AS (
  SELECT {last} - i * INTERVAL '{slide}' AS window_start, category, cents
  FROM {source}, range({ratio}) steps(i) WHERE {where}
)
SELECT window_start, window_start + INTERVAL '{width}' AS window_end, category,
  CAST(sum(cents) AS DOUBLE) AS revenue, count(*) AS orders
FROM spread GROUP BY ALL"""
