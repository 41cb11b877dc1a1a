"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Each query
is run once to warm up and then ``BENCH_RUNS`` times; the median counts.
Results go to Spark's no-op sink, so every row is computed and none is fetched.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowloom import plans
from rowloom.operators import joins, layout, sampling
from rowloom.plans.registry import Tables
from rowloom.session import build_session
from rowloom.sources.generators import id_range, random_ints, skew_lookup, skewed_key

HEADLINE = """revenue_by_nation_year group_summary pivot_sum_values crosstab cramers_v quantiles group_median
    join_sort_merge join_broadcast join_salted_supplier join_skew_auto agg_join_back group_count pivot_count window_total window_mean_max
    window_rank_topn window_rank_compare global_row_number topk_per_group window_lag_default interpolate_linear
    densify dedupe_keys except_all union_distinct sample_exact sample_exact_stratified random_split
    array_explode udaf_group_mean group_pct_deviation cogroup_in_pandas corr_matrix iterative_columns
    bucketed_join parquet_roundtrip_modes csv_roundtrip_schema dq_profile""".split()


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def iterated(spark: SparkSession, checkpoint_every: int | None) -> DataFrame:
    """1,000 rows, 11 iterations: the one workload with a published time."""
    start = id_range(spark, 1_000).withColumn("col_0", random_ints(12, 42))
    return layout.iterate_columns(start, "col_0", 11, lambda before, i: F.when(before > i, before).otherwise(0),
                                  checkpoint_every=checkpoint_every)


def skewed_rows(t: Tables) -> DataFrame:
    """Order lines with a key that is the same for nearly all of them."""
    return t.lineitem.select("l_orderkey", "l_partkey", skewed_key("l_orderkey", 0.01).alias("skew_key"))


def workloads(spark: SparkSession, folder: str):
    t, queries = Tables(spark, folder), plans.all_queries()
    for name in HEADLINE:
        yield name, lambda name=name: run(queries[name](spark, folder))
    yield "iterate_1000_plain", lambda: iterated(spark, None).collect()
    yield "iterate_1000_checkpoint", lambda: iterated(spark, 3).collect()
    lookup = skew_lookup(spark)
    yield "skewed_merge_join", lambda: run(joins.sort_merge_join(skewed_rows(t), lookup, ["skew_key"], "left"))
    yield "skewed_broadcast_join", lambda: run(joins.broadcast_join(skewed_rows(t), lookup, ["skew_key"], "left"))
    yield "skewed_salted_join", lambda: run(joins.salted_join(skewed_rows(t), lookup, ["skew_key"], 10, "left"))
    yield "exact_sample_half", lambda: run(sampling.exact_sample(t.events, "event_id", 42, fraction=0.5))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("rowloom-bench", f"local[{cpus}]", **{
        "spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="rowloom-bench-"),
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name, work in workloads(spark, folder):
        work()
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            work()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
    spark.stop()
    print(json.dumps({"metric": "total of median query times", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                      "cpus": int(cpus), "runs": runs}))


if __name__ == "__main__":
    main()
