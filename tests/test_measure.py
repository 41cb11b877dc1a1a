"""Measured sizes: budgets for broadcasts, heavy build keys of hash joins."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from rowloom.operators import joins, measure


def test_row_bytes_of_every_kind(spark):
    df = spark.createDataFrame(
        [(1, "abc", b"12345", [1, 2], ["a", None, "bcd"], {"k": "vv"}, (7, "xy"), dt.date(2024, 1, 1), decimal.Decimal("1.5")),
         (None,) * 9],
        "i long, s string, b binary, n array<int>, t array<string>, m map<string,string>, r struct<p:int,q:string>, d date, e decimal(10,2)")
    own = 8 * (9 + 2)
    want = own + 3 + 5 + 2 * 8 + (3 * 8 + 4) + (8 + 1 + 8 + 2) + (2 * 8 + 2)
    assert sorted(r[0] for r in df.select(measure.row_bytes(df)).collect()) == [own, want]


def test_row_bytes_of_nested_lists_and_odd_names(spark):
    df = spark.createDataFrame([([["ab"], None, []],)], "`a.b` array<array<string>>")
    assert df.select(measure.row_bytes(df)).first()[0] == 8 * 3 + (8 + 8 + 2) + 8 + 8


@pytest.mark.parametrize("parts", [1, 7])
def test_fits_is_exact_at_the_edge(spark, parts):
    df = spark.range(5_000).repartition(parts)
    size = 5_000 * 24
    assert measure.fits(df, 5_000, size)
    assert not measure.fits(df, 4_999, size)
    assert not measure.fits(df, 5_000, size - 1)


def test_fits_moves_sums_only(spark):
    df = spark.range(0, 3_000, 1, 3).withColumn("s", F.repeat(F.lit("x"), 100))
    assert measure.fits(df, 10_000, 10_000_000) and not measure.fits(df, 2_000, 10_000_000)
    text = plan(df.agg(F.count(F.lit(1)), F.sum(measure.row_bytes(df))))
    assert "Python" not in text and text.count("HashAggregate") == 2


def test_fits_of_an_empty_frame(spark):
    assert measure.fits(spark.range(0), 0, 0)


def test_heavy_keys_by_bytes_not_rows(spark):
    """Few long rows are heavy, many short ones aren't; a null is a key."""
    small = spark.range(4_000).select((F.col("id") % 500).cast("string").alias("k"), F.lit("x").alias("s"))
    long_ = spark.range(4).select(F.lit("long").alias("k"), F.repeat(F.lit("y"), 50_000).alias("s"))
    nulls = spark.range(3).select(F.lit(None).cast("string").alias("k"), F.repeat(F.lit("z"), 60_000).alias("s"))
    total, heavy = measure.heavy_keys(small.union(long_).union(nulls), ["k"], 100_000)
    assert {r["k"]: r["_bytes"] for r in heavy.collect()} == {"long": 4 * (32 + 4 + 50_000), None: 3 * (32 + 60_000)}
    assert total == sum((32 + len(str(i % 500)) + 1) for i in range(4_000)) + 4 * (36 + 50_000) + 3 * (32 + 60_000)
    assert measure.heavy_keys(small, ["k"], 100_000)[1] is None
    assert measure.heavy_keys(small.limit(0), ["k"], 10) == (0, None)


@pytest.fixture(scope="module")
def sides(spark):
    """Left: hot keys 1 and null.  Right: key 1 heavy by different rows, 2 by copies of one row, 3 is missing, null is heavy too."""
    left = [(1, i) for i in range(60)] + [(2, i) for i in range(3)] + [(3, 1), (3, 1)] + [(None, i) for i in range(40)] + [(4, 4)]
    right = ([(1, f"r{i}", None) for i in range(80)] + [(2, "copy", 1.5)] * 90 + [(4, "one", 2.0)] + [(5, "none", 2.0)]
             + [(None, f"n{i}", 0.0) for i in range(50)])
    return (spark.createDataFrame(left, "k int, v int").repartition(3).persist(),
            spark.createDataFrame(right, "k int, w string, x double").repartition(3).persist())


@pytest.mark.parametrize("how, max_rows, max_bytes", [
    *[(how, 20, 4_000) for how in ("inner", "left", "left_outer", "leftsemi", "left_anti", "right", "full")],
    *[("left", n, size) for n, size in ((1_000, 4_000), (20, 10**9), (1_000, 10**9))]])
def test_hash_join_equals_plain_join(sides, how, max_rows, max_bytes):
    left, right = sides
    got = joins.shuffle_hash_join(left, right, ["k"], how, max_rows, max_bytes)
    want = left.join(right, ["k"], how)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert rows(got) == rows(want)


def test_build_key_is_cut_into_bounded_parts(spark, sides):
    """One key holds nearly all build rows; no part of the build side goes beyond the limit."""
    left, right = sides
    build = right.filter("k is not null")
    total, heavy = measure.heavy_keys(build, ["k"], 1_000)
    assert {r["k"] for r in heavy.collect()} == {1, 2}
    met, dealt = joins._split_build(left, build, ["k"], heavy, 4_000)
    sizes = dealt.groupBy("k", "_build_part").agg(F.sum(measure.row_bytes(dealt)).alias("b"))
    assert sizes.agg(F.max("b")).first()[0] <= 4_000 and sizes.filter("k = 1").count() > 1
    assert dealt.agg(F.sum("_build_copies")).first()[0] == build.count()
    assert met.filter("k = 3").count() == 2 and met.filter("k = 1").count() > 60


def test_copies_of_one_build_row_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(joins, "COPIES_PER_TASK", 10)
    right = spark.range(300).select(F.lit(1).alias("k"), F.lit("same").alias("w"))
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    got = joins.shuffle_hash_join(left, right, ["k"], "left", max_bytes=2_000)
    assert {tuple(r): n for *r, n in got.groupBy("k", "v", "w").count().collect()} == {(1, "a", "same"): 300, (2, "b", None): 1}


def test_more_build_bytes_get_more_partitions(spark, sides):
    left, right = sides
    text = plan(joins.shuffle_hash_join(left, right.filter("k is not null"), ["k"], "inner", max_bytes=900))
    assert "ShuffledHashJoin" in text and "REPARTITION_BY_NUM" in text and text.count("Exchange hashpartitioning(k") >= 1


def test_several_keys_and_clashing_other_columns(spark):
    left = spark.createDataFrame([(1, None, "l"), (1, "b", "l"), (2, "b", "m")], "a int, b string, x string")
    right = spark.createDataFrame([(1, None, "r")] * 30 + [(1, "b", f"r{i}") for i in range(30)], "a int, b string, x string")
    got = joins.shuffle_hash_join(left, right, ["a", "b"], "left", max_bytes=2_000)
    want = left.join(right, ["a", "b"], "left")
    assert got.columns == want.columns == ["a", "b", "x", "x"]
    assert rows(got.toDF("a", "b", "x", "y")) == rows(want.toDF("a", "b", "x", "y"))
