"""Column contracts shared by all operators.

Schemas are plain ``name -> Spark type`` mappings, in wire order, so that a caller can narrow one
(``pick(EVENT_FIELDS, "event_type", "ts")``) and pay for parsing only the fields it reads.
"""

from __future__ import annotations

from collections.abc import Mapping

# The wire contract of the event topic. A field absent from one type stays NULL.
EVENT_FIELDS = {
    "event_type": "string",
    "event_id": "string",
    "ts": "string",
    "order_id": "string",
    "customer_id": "string",
    "category": "string",
    "quantity": "int",
    "unit_price": "double",
    "sku": "string",
    "warehouse": "string",
    "quantity_delta": "int",
}

# Event types that can be used.
SALE = "sale"
STOCK = "stock"
KNOWN_TYPES = (SALE, STOCK)

# One row image of the captured table, and the change envelope around it.
ROW_FIELDS = {
    "sku": "string",
    "category": "string",
    "unit_price": "double",
    "stock": "int",
    "updated_at": "string",
}

# Change operations (create, update, delete, snapshot read).
OP_CREATE = "c"
OP_UPDATE = "u"
OP_DELETE = "d"
OP_READ = "r"
KNOWN_OPS = (OP_CREATE, OP_UPDATE, OP_DELETE, OP_READ)

# Where a record ends up. The two reasons are also the dead-letter reasons.
ON_TIME = "on_time"
REASON_LATE = "late"
REASON_MALFORMED = "malformed_or_unknown"

KEY = "sku"
STATE_COLUMNS = tuple(ROW_FIELDS)


def ddl(fields: Mapping[str, str]) -> str:
    """The mapping as a Spark DDL schema string."""
    return ", ".join(f"{name} {dtype}" for name, dtype in fields.items())


def pick(fields: Mapping[str, str], *names: str) -> dict[str, str]:
    """The named part of a schema, in the schema's own order."""
    missing = set(names) - set(fields)
    if missing:
        raise KeyError(f"unknown fields: {sorted(missing)}")
    return {name: dtype for name, dtype in fields.items() if name in names}


_IMAGE = f"struct<{', '.join(f'{n}: {t}' for n, t in ROW_FIELDS.items())}>"
ENVELOPE_FIELDS = {"before": _IMAGE, "after": _IMAGE, "op": "string", "ts_ms": "bigint"}

# What a flat change needs of an envelope, for a narrow decode: of the old image only the key.
CHANGE_FIELDS = {**ENVELOPE_FIELDS, "before": f"struct<{KEY}: {ROW_FIELDS[KEY]}>"}

DLQ_FIELDS = {"event_id": "string", "raw_json": "string", "dlq_reason": "string"}

# The fields windowed revenue needs, for a narrow decode.
REVENUE_FIELDS = pick(
    EVENT_FIELDS, "event_type", "event_id", "ts", "category", "quantity", "unit_price"
)
