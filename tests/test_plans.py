"""What the plans must and must not contain, so that they hold on large and skewed tables."""

import re

import pytest
from conftest import SF_DIR

from tidemark.plans import change_queries, event_queries

TABLE_QUERIES = {**event_queries.QUERIES, **change_queries.QUERIES}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(run(spark, SF_DIR)) for name, run in TABLE_QUERIES.items()}


def shuffles(plan):
    """All exchanges but broadcasts, whoever asked for them."""
    return re.findall(r"Exchange (\w+partitioning|SinglePartition|RoundRobin\w*)\b", plan)


def test_no_cross_joins_and_no_python(plans):
    for name, plan in plans.items():
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "RDDScan"):
            assert bad not in plan, (name, bad)


def test_only_single_values_meet_in_one_task(plans):
    single = {name for name, plan in plans.items() if "SinglePartition" in shuffles(plan)}
    assert single == {"conservation_audit", "late_by_microbatch"}


@pytest.mark.parametrize(
    "name", ["parse_events", "valid_events", "dlq_records", "sale_revenue", "cdc_flatten", "cdc_parse"]
)
def test_row_by_row_operators_do_not_shuffle(plans, name):
    assert shuffles(plans[name]) == []


@pytest.mark.parametrize(
    "name,count",
    [
        ("routed_revenue", 1),
        ("revenue_tumbling", 1),
        ("revenue_sliding", 2),
        ("dedup_events", 1),
        ("cdc_latest_per_key", 1),
        ("cdc_merge", 1),
        ("cdc_fold_batches", 1),
    ],
)
def test_aggregates_combine_before_few_shuffles(plans, name, count):
    assert shuffles(plans[name]) == ["hashpartitioning"] * count
    assert "partial_" in plans[name]


@pytest.mark.parametrize(
    "name",
    [n for n in TABLE_QUERIES if n not in ("dlq_reencoded", "dlq_replay_revenue")],
)
def test_records_are_parsed_at_most_once(plans, name):
    assert plans[name].count("from_json") <= 1


def test_sliding_expands_buckets_and_not_rows(plans):
    above, below = plans["revenue_sliding"].split("Expand", 1)
    assert "partial_sum(cents" in above
    assert "HashAggregate" in below


def test_scans_read_only_needed_columns(plans):
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_shipdate:timestamp>" in (
        plans["bulk_revenue_tumbling"]
    )
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp>" in (
        plans["late_by_microbatch"]
    )


def test_batch_maxima_are_computed_once(spark):
    late = TABLE_QUERIES["late_by_microbatch"](spark, SF_DIR)
    late.collect()
    assert "ReusedExchange" in plan_of(late)
