"""Samples: exact sizes, bounds for the random ones, no dependence on the layout."""

import math

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from rowloom.operators import layout, quality, sampling, setops


@pytest.mark.parametrize("size", [0, 1, 37, 999, 1000, 5000])
def test_exact_size_and_layout(spark, size):
    df = spark.range(1000)
    got = sampling.exact_sample(df, "id", 1, size=size)
    assert got.count() == min(size, 1000)
    again = sampling.exact_sample(df.repartition(13), "id", 1, size=size)
    assert rows(got) == rows(again)
    by_hash = sorted(range(1000), key=lambda i: __import__("hashlib").md5(f"1-{i}".encode()).hexdigest())
    assert rows(got) == [(i,) for i in sorted(by_hash[:size])]


def test_exact_fraction_and_seed(spark):
    df = spark.range(1001)
    assert sampling.exact_sample(df, "id", 1, fraction=0.25).count() == 250
    assert rows(sampling.exact_sample(df, "id", 1, size=50)) != rows(sampling.exact_sample(df, "id", 2, size=50))
    with pytest.raises(ValueError):
        sampling.exact_sample(df, "id", 1)


def test_one_hash_prefix_is_cut_in_the_middle(spark, monkeypatch):
    monkeypatch.setattr(sampling, "PREFIX_DIGITS", 1)
    monkeypatch.setattr(sampling, "EDGE_ROWS", 3)
    for size in (1, 100, 499, 500):
        assert sampling.exact_sample(spark.range(500), "id", 3, size=size).count() == size


def test_stratified_sizes(spark):
    kinds = ["Bird"] * 30 + ["Cat"] * 200 + ["Dog"] * 100 + ["Fox"] * 1 + ["Owl"] * 20 + [None] * 5
    df = spark.createDataFrame(list(enumerate(kinds)), "id long, kind string")
    sizes = {"Bird": 15, "Cat": 20, "Dog": 10, "Fox": 2, "Other": 5}
    got = sampling.exact_stratified_sample(df, "kind", sizes, "id", 42)
    assert rows(got.groupBy("stratum").count()) == [("Bird", 15), ("Cat", 20), ("Dog", 10), ("Fox", 1), ("Other", 5)]
    without = sampling.exact_stratified_sample(df, "kind", {"Cat": 3}, "id", 42, other=None)
    assert rows(without.groupBy("kind").count()) == [("Cat", 3)]


def test_bernoulli_within_bounds(tables):
    n = tables.lineitem.count()
    got = sampling.bernoulli_sample(tables.lineitem, 0.1, 7).count()
    assert abs(got - 0.1 * n) < 6 * math.sqrt(n * 0.09)


def test_replacement_draws_some_rows_twice(tables):
    drawn = sampling.bernoulli_sample(tables.orders, 1.0, 7, with_replacement=True)
    assert drawn.count() > drawn.distinct().count()


def test_sample_by_drops_unlisted(tables):
    got = sampling.sample_by(tables.events, "event_type", {"click": 0.5}, 1)
    assert rows(got.select("event_type").distinct()) == [("click",)]


def test_split_is_complete_and_disjoint(spark):
    df = spark.range(20_000)
    split = sampling.random_split(df, {"a": 6, "b": 3, "c": 1}, "id", 5)
    counts = dict(rows(split.groupBy("part").count()))
    assert sum(counts.values()) == 20_000
    for label, share in (("a", 0.6), ("b", 0.3), ("c", 0.1)):
        assert abs(counts[label] - share * 20_000) < 6 * math.sqrt(20_000 * share * (1 - share))
    assert setops.frames_equal(split, sampling.random_split(df.repartition(3), {"a": 6, "b": 3, "c": 1}, "id", 5))


def test_modulo_split_of_negative_ids(spark):
    got = sampling.modulo_split(spark.range(-4, 5), "id", 3)
    assert rows(got.groupBy("part").count()) == [(0, 3), (1, 3), (2, 3)]


def test_weighted_sample_prefers_weight(spark):
    df = spark.range(2000).withColumn("w", F.when(F.col("id") < 1000, 9.0).otherwise(1.0))
    got = sampling.weighted_sample(df, "id", "w", 200, 11)
    assert got.count() == 200
    assert got.filter("id < 1000").count() > 150
    assert sampling.weighted_sample(df.withColumn("w", F.lit(0.0)), "id", "w", 5, 1).count() == 0


def test_uniform_is_uniform(spark):
    u = spark.range(20_000).select(sampling.hash_uniform("id", 1).alias("u"))
    low, high, mean = u.agg(F.min("u"), F.max("u"), F.mean("u")).first()
    assert 0 < low < 0.001 and 0.999 < high < 1 and abs(mean - 0.5) < 0.01


def test_expected_rows_and_distribution(tables):
    fractions = {"click": 0.5, "view": 0.25}
    drawn = sampling.sample_by(tables.events, "event_type", fractions, 3)
    for r in sampling.expected_rows(tables.events, drawn, "event_type", fractions).collect():
        assert abs(r["n_sample"] - r["n_expected"]) < 6 * math.sqrt(r["n_all"])
    shares = sampling.sample_distribution(tables.events, drawn, ["event_type"]).collect()
    assert sum(r["pct_all"] for r in shares) == pytest.approx(100)
    assert sum(r["pct_sample"] for r in shares) == pytest.approx(100)


def test_validate_sample_of_everything(tables):
    got = sampling.validate_sample(tables.orders, tables.orders, ["o_totalprice"]).first()
    assert got["mean_gap"] == 0 and got["min_all"] == got["min_sample"]


def test_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(i if i % 2 else None,) for i in range(200)], "k long")
    assert sampling.exact_sample(df.filter("k is not null"), "k", 1, size=50).count() == 50
    assert sampling.exact_sample(df, "k", 1, size=200).count() == 200
    with pytest.raises(ValueError, match="must be unique"):
        sampling.exact_sample(spark.createDataFrame([(1,)] * 10, "k long"), "k", 1, size=5)


def test_null_strata_are_counted(spark):
    df = spark.createDataFrame([(None, i) for i in range(6)] + [(0, i) for i in range(2)], "k int, v int")
    got = sampling.sample_distribution(df, df, ["k"])
    assert rows(got, "k", "n_all", "n_sample", "pct_sample") == [(None, 6, 6, 75.0), (0, 2, 2, 25.0)]
    got = sampling.sample_distribution(df, df.filter("k = 0"), ["k"])
    assert rows(got, "k", "n_all", "n_sample") == [(None, 6, 0), (0, 2, 2)]
    got = sampling.expected_rows(df, df.filter("k is null and v < 3"), "k", {None: 0.5, 0: 0.5})
    assert rows(got, "k", "n_all", "n_expected", "n_sample") == [(None, 6, 3, 3), (0, 2, 1, 0)]
    assert rows(sampling.expected_rows(df, df, "k", {0: 1.0}), "k", "n_sample") == [(0, 2)]


def test_checksums_tell_bags_of_rows_apart(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, "b")], "k int, v string")
    same = spark.createDataFrame([(None, "b"), (1, None), (2, "a"), (1, None)], "k int, v string").repartition(3)
    assert setops.frames_equal(df, same) and setops.frames_equal(df.limit(0), same.limit(0))
    quality.assert_same_frame(df, same)
    for other in (df.distinct(), df.withColumn("v", F.coalesce("v", F.lit(""))), df.select(F.col("k") + 1, "v").toDF("k", "v"),
                  df.union(df), df.limit(0)):
        assert not setops.frames_equal(df, other)
        with pytest.raises(AssertionError):
            quality.assert_same_frame(df, other)
    assert setops.frames_equal(df, df.withColumn("k", F.col("k").cast("long")))


@pytest.mark.parametrize("schema, ours, theirs", [
    ("a int, b int", (1, None), (None, 1)), ("a int, b int, c int", (None, 2, None), (2, None, None)),
    ("a array<int>", ([1, None],), ([None, 1],)), ("a struct<x: int, y: int>", ((1, None),), ((None, 1),)),
    ("a struct<x: string>", (("null",),), ((None,),)), ("a string", ("",), (None,))])
def test_checksums_see_where_nulls_stand(spark, schema, ours, theirs):
    """Spark's hashes pass over nulls."""
    left, right = spark.createDataFrame([ours], schema), spark.createDataFrame([theirs], schema)
    assert setops.frames_equal(left, left) and not setops.frames_equal(left, right)
    with pytest.raises(AssertionError, match="rows differ"):
        quality.assert_same_frame(left, right)


def test_equal_values_that_print_differently_are_equal(spark):
    left, right = (spark.createDataFrame([([x],)], "a array<double>") for x in (0.0, -0.0))
    assert setops.frames_equal(left, right)


def test_generated_ids_have_no_gaps_and_stay(spark):
    df = spark.range(10_000, numPartitions=7).filter("id % 7 <> 3 and (id < 1500 or id > 4000)").withColumn("_task", F.col("id") * 2)
    got = layout.numbered_rows(df, first=5)
    n = df.count()
    assert got.columns == ["id", "_task", "row_id"]
    assert [r["row_id"] for r in got.orderBy("row_id").collect()] == list(range(5, n + 5))
    before = rows(got)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # other splits of the files
    try:
        assert rows(got.select("*")) == before
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    # Rows lie as they came: ids follow the order of the frame.
    assert [r["id"] for r in got.orderBy("row_id").collect()] == sorted(r["id"] for r in df.collect())
    assert "SortMergeJoin" not in plan(got) and "hashpartitioning" not in plan(got)


def test_generated_ids_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(layout, "TASKS_PER_BLOCK", 3)
    df = spark.range(500, numPartitions=20).filter("id % 25 > 3 or id > 400").repartition(13, "id")
    got = layout.numbered_rows(df, "n")
    assert sorted(r["n"] for r in got.collect()) == list(range(df.count()))
    assert layout.numbered_rows(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="column ID already"):
        layout.numbered_rows(df, "ID")
    one = layout.numbered_rows(spark.createDataFrame([(None, "")] * 4, "a int, b string"))
    assert rows(one, "row_id") == [(i,) for i in range(4)]


def test_weighted_sample_is_a_filter_for_any_size(spark):
    df = spark.range(3_000).withColumn("w", 1.0 + F.col("id") % 9).repartition(5)
    draw = -F.log(sampling.hash_uniform("id", 7)) / F.col("w")
    order = [r["id"] for r in df.orderBy(draw, "id").collect()]
    for size in (1, 40, 1_500, 2_999, 3_000, 5_000):
        for limit in (100, 10_000):  # narrowed down, and sorted
            got = sampling.weighted_sample(df, "id", "w", size, 7, max_rows=limit)
            assert sorted(r["id"] for r in got.collect()) == sorted(order[:size])
            assert "Exchange" not in plan(got.select("id")).split("Exchange RoundRobin")[0]
    assert sampling.weighted_sample(df, "id", "w", 0, 7).count() == 0
    copies = spark.createDataFrame([(1, 2.0)] * 50 + [(2, 2.0)], "id long, w double")
    for size in (10, 50, 51):
        assert sampling.weighted_sample(copies, "id", "w", size, 7).count() == size
