"""What the physical plans must show."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from helpers import plan
from rowloom import plans
from rowloom.operators import joins, ordering, shape, windows
from rowloom.plans import joining
from rowloom.sources import files

QUERIES = plans.all_queries()


@pytest.mark.parametrize("name, node", [("join_sort_merge", "SortMergeJoin"), ("join_shuffle_hash", "ShuffledHashJoin"),
                                        ("join_broadcast", "BroadcastHashJoin"),
                                        ("join_auto_broadcast", "BroadcastHashJoin")])
def test_join_strategy(spark, name, node):
    assert node in plan(QUERIES[name](spark, SMALL))


def test_lookup_as_case_has_no_shuffle(spark):
    text = plan(QUERIES["lookup_as_case"](spark, SMALL))
    assert "Exchange" not in text and "Join" not in text


@pytest.mark.parametrize("name", ["indicator_columns", "bin_two", "derived_ratio", "str_pad", "iterative_columns",
                                  "split_modulo", "map_lookup", "math_distance"])
def test_narrow_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, SMALL))


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["filter_and"](spark, SMALL))
    assert "EqualTo(l_returnflag,R)" in text and "GreaterThan(l_quantity,40.0)" in text
    assert "l_extendedprice" not in text and "l_shipdate" not in text


def test_partition_filter(spark):
    text = plan(QUERIES["partitioned_write_prune"](spark, SMALL))
    assert "PartitionFilters: [isnotnull(o_year" in text or "PartitionFilters: [o_year" in text


def test_top_k_limits_before_the_shuffle(tables):
    text = plan(windows.top_per_group(tables.orders, ["o_orderpriority"],
                                      [F.desc("o_totalprice"), F.col("o_orderkey")], 3))
    assert text.count("WindowGroupLimit") == 2
    dedup = plan(shape.dedupe(tables.orders, ["o_custkey"], [F.col("o_orderkey")]))
    assert dedup.count("WindowGroupLimit") == 2


def test_top_n_does_not_sort_everything(tables):
    assert "TakeOrderedAndProject" in plan(ordering.top_n(tables.orders, ["-o_totalprice", "o_orderkey"], 5))


def test_redundant_sorts_collapse(tables):
    df = tables.orders
    for _ in range(4):
        df = df.orderBy("o_totalprice", "o_orderkey")
    assert plan(df).count("Exchange rangepartitioning") == 1


def test_totals_are_a_window_or_with_hot_keys_aggregate_and_join(tables):
    plain = plan(windows.partition_totals(tables.orders, ["o_custkey"], "o_totalprice", total="t"))
    assert "Window" in plain and "Join" not in plain
    hot = plan(windows.partition_totals(tables.orders, ["o_orderpriority"], "o_totalprice", total="t", max_rows=100))
    assert "Window" not in hot and "HashAggregate" in hot and "Join" in hot


def test_ordered_window_without_hot_keys_is_one_plain_window(tables):
    text = plan(windows.lag_lead(tables.events, ["user_id"], "ts", "event_id", "value", "before"))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_salted_join_spreads_the_hot_key(tables):
    """More than one task gets rows of the key that holds nearly all rows."""
    left = joining.skewed_events(tables)
    salted = left.withColumn("_salt", joins.spread_by_hash(left.columns, 10))
    largest = salted.filter("skew_key = 'D'").groupBy("_salt").count().agg(F.max("count"), F.sum("count")).first()
    assert largest[0] < largest[1] / 5


def test_exact_sample_is_a_narrow_filter(spark):
    for name in ("sample_exact", "sample_exact_stratified"):
        assert "Exchange" not in plan(QUERIES[name](spark, SMALL))


def test_pivot_values_need_no_extra_job(spark, tables):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("pivot", "pivot")
    from rowloom.operators.aggregate import pivot_agg
    pivot_agg(tables.orders, ["o_custkey"], "o_orderstatus", ["F", "O"], [F.sum("o_totalprice")])
    jobs = tracker.getJobIdsForGroup("pivot")
    spark.sparkContext.setJobGroup("", "")
    # Opening the Parquet file is the only job.
    assert len(jobs) <= 1


def test_persisted_filter_comes_before_the_cache(spark, tables):
    kept = tables.orders.filter(F.col("o_orderstatus") == "F").persist()
    try:
        text = plan(kept.groupBy("o_orderpriority").count())
        assert "InMemoryTableScan" in text and "PushedFilters: [IsNotNull(o_orderstatus)" in text
    finally:
        kept.unpersist()


def test_orc_pushes_filters(spark, tables, tmp_path):
    files.write_orc(tables.supplier, str(tmp_path / "o"))
    text = plan(files.read_orc(spark, str(tmp_path / "o")).filter("s_acctbal > 100").select("s_suppkey"))
    assert "GreaterThan(s_acctbal,100.0)" in text and "s_name" not in text
