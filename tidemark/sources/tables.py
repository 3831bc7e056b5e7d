"""The driver's tables as inputs of the event branch and the change branch.

Schemas are declared, with ``TIMESTAMP`` where the files hold UTC wall clocks: Spark then reads the
stored microseconds as instants, which a watermark needs and which no session zone can shift.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.times import wire_text
from tidemark.operators.encode import event_key, payload
from tidemark.schemas import EVENT_FIELDS, SALE, STOCK

TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
}

# How the driver's event types map to the wire; "error" is not an event at all.
WIRE_TYPES = {"purchase": SALE, "view": STOCK, "click": STOCK}
UNREADABLE_TS = "around noon"

#: Change offsets are order line times this plus part, so that they tell lines apart.
OFFSET_PARTS = 1_000_000_000
#: Lines with this number change products that the captured table does not have yet.
UNLISTED_LINE = 7
OPS = {"R": "d", "A": "u", "N": "c"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    """A table as a stream. The path is a glob, so it may be one file or a folder of files."""
    return (
        spark.readStream.schema(TABLE_SCHEMAS[name])
        .options(**options)
        .parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")
    )


def _text(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def with_customer(events: DataFrame, customer: DataFrame, salts: int | None = None) -> DataFrame:
    """Events with their customer.

    Spark sizes the join; on a table the adaptive skew join splits hot customers. That does not run
    in a stateful stream: a caller whose stream has customers with very many events, and more
    customers than a broadcast holds, gives a number of ``salts``, over which the events of a
    customer are then dealt, to as many copies of the customer.
    """
    same = F.col("user_id") == F.col("c_custkey")
    if salts is None:
        return events.join(customer, same)
    salt = F.pmod(F.xxhash64("event_id"), F.lit(salts)).cast("int")
    copies = customer.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = events.withColumn("_salt", salt).join(copies, same & (F.col("_salt") == F.col("_copy")))
    return salted.drop("_salt", "_copy")


def feed_events(events: DataFrame, customer: DataFrame, salts: int | None = None) -> DataFrame:
    """Every row of ``events`` as an event of the wire model, in one pass.

    Purchases become sales, views and clicks stock moves; signups keep their unknown type; errors
    carry a text in ``broken`` that is no JSON. A row with ``k = 0`` gets an unreadable time. The
    customer's segment is the category.
    """
    kind = F.col("event_type")
    wire_type = F.create_map(*[F.lit(x) for pair in WIRE_TYPES.items() for x in pair])
    k = F.get_json_object("props", "$.k").cast("int")
    sale, stock = kind == "purchase", kind.isin("view", "click")
    joined = with_customer(events, customer, salts)
    named = F.coalesce(F.element_at(wire_type, kind), kind)
    return joined.select(
        named.alias("event_type"),
        F.concat(named, F.lit("-"), F.col("event_id").cast("string")).alias("event_id"),
        F.when(k == 0, F.lit(UNREADABLE_TS)).otherwise(wire_text("ts")).alias("ts"),
        F.when(sale, _text("O", "event_id")).alias("order_id"),
        F.when(sale, _text("C", "user_id")).alias("customer_id"),
        F.when(sale | stock, F.col("c_mktsegment")).alias("category"),
        F.when(sale, k).alias("quantity"),
        F.when(sale, F.col("value")).alias("unit_price"),
        F.when(stock, _text("SKU", "user_id")).alias("sku"),
        F.when(stock, _text("W", "c_nationkey")).alias("warehouse"),
        F.when(stock, k).alias("quantity_delta"),
        F.when(kind == "error", _text("error ", "event_id")).alias("broken"),
        F.col("event_id").alias("offset"),
        F.col("c_mktsegment").alias("segment"),
        F.col("ts").alias("sent_at"),
    )


def feed_records(
    events: DataFrame, customer: DataFrame, *extra: str, salts: int | None = None
) -> DataFrame:
    """`feed_events` as topic records. ``extra`` columns are carried beside them."""
    rows = feed_events(events, customer, salts)
    return rows.select(
        event_key().cast("binary").alias("key"),
        F.coalesce("broken", payload(list(EVENT_FIELDS))).cast("binary").alias("value"),
        "offset",
        *extra,
    )


def typed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`feed_events` of the driver's tables."""
    return feed_events(table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"))


def feed(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """The event topic as a table."""
    events = table(spark, sf_dir, "events")
    return feed_records(events, table(spark, sf_dir, "customer"), *extra)


def feed_stream(
    spark: SparkSession, sf_dir: str, *extra: str, salts: int | None = None, **options
) -> DataFrame:
    """The event topic as a stream."""
    events = table_stream(spark, sf_dir, "events", **options)
    return feed_records(events, table(spark, sf_dir, "customer"), *extra, salts=salts)


def bulk_sales(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Order lines as typed sale events with the part's brand and list price."""
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.lit(SALE).alias("event_type"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("event_id"),
        F.col("p_brand").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("l_shipdate").alias("event_time"),
    )


def change_records(lineitem: DataFrame, *extra: str) -> DataFrame:
    """Every order line as a change record of its part, with full before and after images.

    Deletes are followed by a tombstone. Lines with the lowest or highest tax at a tenth off carry a
    truncate message or a text instead, which no state may take up.
    """
    op = F.element_at(
        F.create_map(*[F.lit(x) for pair in OPS.items() for x in pair]), F.col("l_returnflag")
    )
    tenth = F.col("l_discount") == 0.1
    kind = (
        F.when(tenth & (F.col("l_tax") == 0.08), "text")
        .when(tenth & (F.col("l_tax") == 0.0), "truncate")
        .otherwise("change")
    )
    sends = F.when((op == "d") & (kind == "change"), F.array(F.lit(False), F.lit(True)))
    lines = lineitem.select(
        "*",
        op.alias("op"),
        kind.alias("kind"),
        wire_text("l_shipdate").alias("updated_at"),
        F.concat(
            F.when(F.col("l_linenumber") == UNLISTED_LINE, F.lit("NEW")).otherwise(F.lit("SKU")),
            F.col("l_partkey").cast("string"),
        ).alias("sku"),
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * OFFSET_PARTS + F.col("l_partkey")).alias(
            "offset"
        ),
        F.explode(F.coalesce(sends, F.array(F.lit(False)))).alias("tombstone"),
    )

    def image(price: Column) -> Column:
        return F.struct(
            "sku",
            _text("S", "l_suppkey").alias("category"),
            price.alias("unit_price"),
            F.col("l_quantity").cast("int").alias("stock"),
            "updated_at",
        )

    new = image(F.col("l_extendedprice"))
    old = image(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    envelope = F.to_json(
        F.struct(
            F.when(F.col("op") != "c", old).alias("before"),
            F.when(F.col("op") != "d", new).alias("after"),
            "op",
            F.unix_millis("l_shipdate").alias("ts_ms"),
        )
    )
    body = (
        F.when(F.col("tombstone"), F.lit(None).cast("string"))
        .when(F.col("kind") == "text", F.concat(F.lit("no change "), F.col("offset")))
        .when(F.col("kind") == "truncate", F.lit('{"op":"t"}'))
        .otherwise(envelope)
    )
    return lines.select(
        F.col("sku").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        "offset",
        *extra,
    )


def change_topic(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """The change topic as a table."""
    return change_records(table(spark, sf_dir, "lineitem"), *extra)


#: One order line in so many has its change lost on the way.
LOSSES = 50
#: Each key's changes run create, update, update, delete, and again.
LIFE = ("c", "u", "u", "d")


def chained_records(lineitem: DataFrame) -> DataFrame:
    """A change topic of parts in which every old image is the last new one, with some records lost.

    A part's order lines by ship date are its changes; ``offset`` counts them per part.
    """
    line = F.struct(
        _text("S", "l_suppkey").alias("category"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_quantity").cast("int").alias("stock"),
        wire_text("l_shipdate").alias("updated_at"),
    )
    log = Window.partitionBy("l_partkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber")
    lines = lineitem.select(
        _text("SKU", "l_partkey").alias("sku"),
        "l_orderkey",
        "l_shipdate",
        line.alias("line"),
        F.lag(line).over(log).alias("line_before"),
        F.row_number().over(log).cast("bigint").alias("offset"),
    )
    op = F.element_at(F.array(*map(F.lit, LIFE)), ((F.col("offset") - 1) % len(LIFE) + 1).cast("int"))

    def image(of: str) -> Column:
        return F.struct("sku", f"{of}.*")

    envelope = F.struct(
        F.when(op != "c", image("line_before")).alias("before"),
        F.when(op != "d", image("line")).alias("after"),
        op.alias("op"),
        F.unix_millis("l_shipdate").alias("ts_ms"),
    )
    arrived = lines.filter(F.col("l_orderkey") % LOSSES != 0)
    return arrived.select(
        F.col("sku").cast("binary").alias("key"),
        F.to_json(envelope).cast("binary").alias("value"),
        "offset",
    )


def spoiled_records(records: DataFrame) -> DataFrame:
    """A feed in which some records have a number as text, a further field, a NULL or no id."""
    text = F.col("value").cast("string")
    kind = F.col("offset") % 11
    spoiled = (
        F.when(kind == 1, F.regexp_replace(text, '"quantity":([0-9]+)', '"quantity":"$1"'))
        .when(kind == 2, F.regexp_replace(text, "^\\{", '{"coupon":"none",'))
        .when(kind == 3, F.regexp_replace(text, '"category":"[^"]*"', '"category":null'))
        .when(kind == 4, F.regexp_replace(text, '"event_id":"[^"]*",', ""))
        .otherwise(text)
    )
    return records.withColumn("value", spoiled.cast("binary"))


def product_state(part: DataFrame) -> DataFrame:
    """The captured table before the changes: all parts."""
    return part.select(
        _text("SKU", "p_partkey").alias("sku"),
        F.col("p_brand").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("p_size").alias("stock"),
        F.lit("1995-01-01T00:00:00Z").alias("updated_at"),
    )
