"""Record keys and payloads, the unified event table, sources and session settings."""

import json
from types import SimpleNamespace

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tidemark.functions.times import utc_wall_clock, wire_text
from tidemark.operators.decode import parse_events
from tidemark.operators.encode import build_events, encode_records, event_key
from tidemark.schemas import EVENT_FIELDS, ddl
from tidemark.sources import topics
from tidemark.sources.catalogs import configure, iceberg_configs, kafka_configs
from tidemark.sources.tables import feed, table
from tidemark.streaming.scratch import scratch_dir


def events(spark, *rows):
    return spark.createDataFrame(
        [tuple(r.get(c) for c in EVENT_FIELDS) for r in rows], ddl(EVENT_FIELDS)
    )


def test_key_is_order_then_sku_then_id(spark):
    rows = events(
        spark,
        {"event_id": "1", "order_id": "O1", "sku": "S1"},
        {"event_id": "2", "order_id": "", "sku": "S2"},
        {"event_id": "3"},
    )
    keys = {r.event_id: r.key for r in rows.select("event_id", event_key().alias("key")).collect()}
    assert keys == {"1": "O1", "2": "S2", "3": "3"}


def test_payload_is_compact_sorted_and_survives_the_round_trip(spark):
    row = {"event_type": "sale", "event_id": "é1", "category": "books", "quantity": 2, "unit_price": 5.0}
    source = events(spark, row)
    (record,) = encode_records(source).collect()
    text = record.value.decode()
    assert json.loads(text) == row
    assert list(json.loads(text)) == sorted(row) and ": " not in text
    again = parse_events(encode_records(source)).drop("event_time")
    assert again.collect() == source.collect()


def test_unified_table_from_two_sources(spark):
    sales = spark.createDataFrame([("a", "t", 2.0)], "event_id string, ts string, quantity double")
    moves = spark.createDataFrame([("b", "t", "S")], "event_id string, ts string, sku string")
    both = build_events(sales, moves)
    assert both.dtypes == [(n, t) for n, t in EVENT_FIELDS.items()]
    rows = {r.event_type: r for r in both.collect()}
    assert rows["sale"].quantity == 2 and rows["stock"].sku == "S"


@pytest.mark.parametrize("hour", range(5, 9))
def test_utc_text_in_the_hours_a_zone_skips_or_repeats(spark, hour):
    """New York has no 02:30 on 2024-03-10 and two 01:30 on 2024-11-03."""
    for day in ("2024-03-10", "2024-11-03"):
        for text in (f"{day}T{hour:02d}:30:00Z", f"{day}T0{hour - 4}:30:00Z"):
            (row,) = (
                spark.range(1)
                .select(F.to_timestamp(F.lit(text)).alias("t"))
                .select(wire_text("t").alias("text"), utc_wall_clock("t").cast("string").alias("clock"))
                .collect()
            )
            assert row.text == text
            assert row.clock == text.replace("T", " ").removesuffix("Z")


def test_tables_are_read_as_utc_instants(spark):
    import duckdb

    want = duckdb.sql(f"SELECT max(epoch_us(ts)) FROM '{SF_DIR}/events.parquet'").fetchall()[0][0]
    (row,) = table(spark, SF_DIR, "events").agg(F.max(F.unix_micros("ts")).alias("m")).collect()
    assert row.m == want


def test_feed_reads_only_what_it_needs(spark):
    plan = feed(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_mktsegment:string>" in plan


def test_file_topic_appends(spark, tmp_path):
    path = str(tmp_path / "topic")
    records = spark.createDataFrame([(bytearray(b"k"), bytearray(b"v"))], "key binary, value binary")
    assert topics.publish(records, path) == 1
    assert topics.publish(records.withColumn("offset", F.lit(7).cast("bigint")), path) == 1
    rows = spark.read.schema(topics.RECORD_FIELDS).parquet(path).collect()
    assert sorted(r.offset or 0 for r in rows) == [0, 7]
    assert topics.read_file_topic(spark, path, maxFilesPerTrigger=1).isStreaming


def test_broker_source_names_the_missing_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        topics.read_kafka_stream(spark, "localhost:9092", "events")


def test_session_settings():
    settings = iceberg_configs("lake", "/data/lake")
    assert settings["spark.sql.catalog.lake.type"] == "hadoop"
    assert settings["spark.sql.catalog.lake.warehouse"] == "/data/lake"
    assert settings["spark.sql.catalog.lake"].endswith("SparkCatalog")
    assert len(settings) == 5

    class Builder(dict):
        def config(self, name, value):
            self[name] = value
            return self

    for parts in ((settings, kafka_configs()), (kafka_configs(), settings)):
        packages = configure(Builder(), *parts)["spark.jars.packages"].split(",")
        assert sorted(p.split(":")[1] for p in packages) == [
            "iceberg-spark-runtime-4.0_2.13",
            "spark-sql-kafka-0-10_2.13",
        ]


def test_scratch_uses_the_shared_folder_if_there_is_one(spark, tmp_path):
    def session(**settings):
        return SimpleNamespace(conf=settings)

    shared = session(**{"spark.checkpoint.dir": f"{tmp_path}/", "spark.master": "spark://host:1"})
    first, second = scratch_dir(shared, "a"), scratch_dir(shared, "a")
    assert first.startswith(f"{tmp_path}/a-") and first != second
    for master in ("local[2]", "spark://host:1"):
        plain = session(**{"spark.master": master, "spark.sql.warehouse.dir": "hdfs://warehouse/"})
        assert scratch_dir(plain, "a").startswith("hdfs://warehouse/scratch/a-")


@pytest.mark.parametrize(
    "master, shared, warehouse, ok",
    [
        ("local[4]", "", "/tmp/w", True),
        ("spark://host:7077", "", "file:/tmp/w", False),
        ("yarn", "", "/tmp/w", False),
        ("yarn", "", "hdfs://n/w", True),
        ("yarn", "hdfs://n/c", "/tmp/w", True),
    ],
)
def test_scratch_is_shared_or_refused(master, shared, warehouse, ok):
    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                known = {"spark.master": master, "spark.sql.warehouse.dir": warehouse}
                return shared if key == "spark.checkpoint.dir" else known.get(key, default)

    if ok:
        assert scratch_dir(Session, "x").startswith(shared or warehouse)
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_dir(Session, "x")
