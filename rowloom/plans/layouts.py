"""Layout and persistence (survey 2.10) and pandas functions (2.11)."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rowloom.operators import aggregate, joins, layout, pandas_ops, windows
from rowloom.operators.ordering import top_n
from rowloom.plans.joining import SKEWED_SQL, skewed_events
from rowloom.plans.registry import Tables, query
from rowloom.session import scratch
from rowloom.sources.tables import staged


@query("SELECT count(*) AS n_rows FROM lineitem")
def partition_profile(t: Tables) -> DataFrame:
    """All rows are in some partition, however they are spread."""
    profile = layout.partition_profile(layout.spread_partitions(t.lineitem, None, "l_orderkey"))
    return profile.agg(F.sum("n").alias("n_rows"))


@query("SELECT count(*) AS n, true AS fewer FROM lineitem")
def shrink_sample(t: Tables) -> DataFrame:
    """Half the rows need half the partitions; the other half is put back, so all rows are counted."""
    spread = layout.spread_partitions(t.lineitem.select("l_orderkey", "l_linenumber"), 6)
    half = layout.shrink_partitions(spread.filter("l_linenumber % 2 = 0"), 0.5)
    fewer = half.rdd.getNumPartitions() < spread.rdd.getNumPartitions()
    return (half.union(spread.filter("l_linenumber % 2 <> 0")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("fewer", F.lit(fewer)))


@query("""(SELECT 'top' AS report, CAST(o_orderkey AS VARCHAR) AS item, o_totalprice AS value FROM orders
             ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
          UNION ALL (SELECT 'mean', o_orderpriority, round(avg(o_totalprice), 4) FROM orders GROUP BY o_orderpriority)
          UNION ALL (SELECT 'highest', o_orderpriority, max(o_totalprice) FROM orders GROUP BY o_orderpriority)""")
def reuse_clean_table(t: Tables) -> DataFrame:
    """Three reports read one kept frame; the small result is staged before it is let go."""
    clean = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    with layout.reused(clean) as kept:
        best = top_n(kept, ["-o_totalprice", "o_orderkey"], 10).select(
            F.lit("top").alias("report"), F.col("o_orderkey").cast("string").alias("item"),
            F.col("o_totalprice").alias("value"))
        summary = aggregate.group_summary(kept, ["o_orderpriority"], "o_totalprice")
        means = summary.select(F.lit("mean"), "o_orderpriority", F.round("average", 4))
        highs = summary.select(F.lit("highest"), "o_orderpriority", "highest")
        return staged(best.union(means).union(highs), "reports")


COLUMNS = 11


def _iterated_sql() -> str:
    inner = "SELECT o_orderkey, CAST((o_orderkey * 7919) % 12 + 1 AS BIGINT) AS col_0 FROM orders"
    for i in range(1, COLUMNS + 1):
        inner = f"SELECT *, CASE WHEN col_{i - 1} > {i} THEN col_{i - 1} ELSE 0 END AS col_{i} FROM ({inner})"
    return inner


def _start_column(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", (F.pmod(F.col("o_orderkey") * 7919, F.lit(12)) + 1).alias("col_0"))


def _keep_larger(previous, i):
    return F.when(previous > i, previous).otherwise(0)


@query(_iterated_sql())
def iterative_columns(t: Tables) -> DataFrame:
    """Twelve columns, each from the one before, as one narrow stage."""
    return layout.iterate_columns(_start_column(t), "col_0", COLUMNS, _keep_larger)


@query(_iterated_sql())
def iterative_columns_checkpoint(t: Tables) -> DataFrame:
    """The same with the lineage cut every three steps."""
    return layout.iterate_columns(_start_column(t), "col_0", COLUMNS, _keep_larger, checkpoint_every=3)


@query("""SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
          GROUP BY o_orderpriority""")
def staging_table(t: Tables) -> DataFrame:
    """The report's plan starts at the scan of the staged table."""
    kept = staged(t.orders.select("o_orderpriority", "o_totalprice"))
    return kept.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"),
                                               F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT o_orderpriority, count(*) AS n_customers, CAST(sum(n) AS BIGINT) AS n_orders FROM
          (SELECT o_orderpriority, o_custkey, count(*) AS n FROM orders GROUP BY o_orderpriority, o_custkey)
          WHERE n > 1 GROUP BY o_orderpriority""")
def staging_released(t: Tables) -> DataFrame:
    """A staged table with two readers, dropped as soon as the report is stored."""
    with scratch(t.spark) as own:
        kept = staged(t.orders.groupBy("o_orderpriority", "o_custkey").agg(F.count(F.lit(1)).alias("n")))
        often = kept.filter("n > 1")
        report = (often.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_customers"))
                  .join(often.groupBy("o_orderpriority").agg(F.sum("n").alias("n_orders")), "o_orderpriority"))
        return own.hand_over(report, "report")


@query(f"SELECT skew_key, count(*) AS n, max(event_id) AS last_id FROM {SKEWED_SQL} GROUP BY skew_key")
def skew_group_by(t: Tables) -> DataFrame:
    """Grouping is not hurt by skew: rows are combined before the shuffle."""
    return skewed_events(t).groupBy("skew_key").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"))


@query(f"SELECT *, row_number() OVER (PARTITION BY skew_key ORDER BY event_id) AS row_number FROM {SKEWED_SQL}")
def skew_window(t: Tables) -> DataFrame:
    """A window over a key that holds nearly all rows, cut into slices."""
    return (windows.ranked(skewed_events(t), ["skew_key"], "event_id", "event_id", descending=False)
            .drop("rank", "dense_rank"))


@query("""SELECT p_partkey, round(sqrt((p_retailprice - 1000) * (p_retailprice - 1000)
                 + (p_size - 25) * (p_size - 25)) / 1000, 9) AS distance FROM part""")
def udf_scalar_distance(t: Tables) -> DataFrame:
    """The pandas form of ``math_distance``; the native form is the one to use."""
    away = pandas_ops.distance_km(F.col("p_retailprice"), F.col("p_size").cast("double"), F.lit(1000.0), F.lit(25.0))
    return t.part.select("p_partkey", F.round(away, 9).alias("distance"))


@query("SELECT event_id, round((value - event_id % 7) / 10.0, 9) AS scaled FROM events")
def udf_scalar_iterator(t: Tables) -> DataFrame:
    away = pandas_ops.scaled(F.col("value"), (F.col("event_id") % 7).cast("double"))
    return t.events.select("event_id", F.round(away, 9).alias("scaled"))


@query("""SELECT event_id, event_type, value, round((value - avg(value) OVER w) / avg(value) OVER w * 100, 6) AS deviation
          FROM events WINDOW w AS (PARTITION BY event_type)""")
def group_pct_deviation(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "event_type", "value")
    return (pandas_ops.pct_deviation(events, ["event_type"], "value", "deviation")
            .withColumn("deviation", F.round("deviation", 6)))


@query("SELECT event_type, round(avg(value), 6) AS mean_value FROM events GROUP BY event_type")
def udaf_group_mean(t: Tables) -> DataFrame:
    means = pandas_ops.group_mean(t.events, ["event_type"], "value", "mean_value")
    return means.withColumn("mean_value", F.round("mean_value", 6))


@query("""SELECT event_id, event_type, round(avg(value) OVER (PARTITION BY event_type), 6) AS mean_value FROM events""")
def udaf_over_window(t: Tables) -> DataFrame:
    """The pandas means of ``udaf_group_mean`` put on every row."""
    means = pandas_ops.group_mean(t.events, ["event_type"], "value", "mean_value")
    rows = joins.join_back(t.events.select("event_id", "event_type"), means, ["event_type"], ["mean_value"])
    return rows.withColumn("mean_value", F.round("mean_value", 6))


@query("SELECT event_id, value * 2 AS doubled FROM events WHERE value > 50")
def map_in_pandas(t: Tables) -> DataFrame:
    def double_large(batch: pd.DataFrame) -> pd.DataFrame:
        large = batch[batch["value"] > 50]
        return pd.DataFrame({"event_id": large["event_id"], "doubled": large["value"] * 2})
    return pandas_ops.map_batches(t.events.select("event_id", "value"), double_large, "event_id long, doubled double")


@query("SELECT event_id, event_type, floor(value / 10) * 10 AS value FROM events")
def map_partitions_round(t: Tables) -> DataFrame:
    """The step is an argument of the function, not a global."""
    def down_to_step(batch: pd.DataFrame, column: str, step: float) -> pd.DataFrame:
        return batch.assign(**{column: np.floor(batch[column] / step) * step})
    return pandas_ops.map_batches(t.events.select("event_id", "event_type", "value"), down_to_step,
                                  "event_id long, event_type string, value double", column="value", step=10.0)


@query("""SELECT o_orderkey, c_custkey, o_totalprice - c_acctbal AS above_balance
          FROM orders JOIN customer ON o_custkey = c_custkey""")
def cogroup_in_pandas(t: Tables) -> DataFrame:
    def compare(orders: pd.DataFrame, customers: pd.DataFrame) -> pd.DataFrame:
        both = orders.merge(customers, on="c_custkey")
        return both.assign(above_balance=both["o_totalprice"] - both["c_acctbal"])[
            ["o_orderkey", "c_custkey", "above_balance"]]
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    return pandas_ops.cogroup_unique(orders, t.customer.select("c_custkey", "c_acctbal"), "c_custkey", compare,
                                     "o_orderkey long, c_custkey long, above_balance double")


@query("""SELECT event_type, round(sum(value) FILTER (WHERE value > 20), 2) AS total FROM events
          WHERE value > 20 GROUP BY event_type""")
def group_apply_sum(t: Tables) -> DataFrame:
    """A filtered sum per group; the threshold is passed in."""
    def large_sums(batch: pd.DataFrame, above: float) -> pd.DataFrame:
        large = batch[batch["value"] > above]
        return large.groupby("event_type", as_index=False, dropna=False)["value"].sum()
    return pandas_ops.grouped_totals(t.events.select("event_type", "value"), ["event_type"], large_sums,
                                     "event_type string, value double", [F.round(F.sum("value"), 2).alias("total")],
                                     above=20.0)
