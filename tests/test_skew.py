"""Cutting hot groups must never show: sliced windows and salted joins equal the plain ones."""

import random

import pytest
from pyspark.sql import Window, functions as F

from helpers import plan, rows
from rowloom.operators import aggregate, joins, narrowing, setops, skew, windows


def awkward_rows():
    """Hot keys, each with its own kind of awkward order values, and some small keys."""
    r = random.Random(3)
    rows = []
    for i in range(150):
        rows += [("spread", r.randint(0, 400), r.choice([None, float(r.randint(0, 9))])),
                 ("ties", r.choice([None, 5, 5, 5, 6]), float(i % 4)),
                 (None, r.choice([5, 5, 5, 6]), float(i % 4)),
                 ("clumped", 10**9 if i == 0 else i % 12, None if i % 5 else 1.0),
                 ("constant", 7, float(i)),
                 ("unknown", None, None),
                 (f"k{i % 40}", i, float(i))]
    r.shuffle(rows)
    return [(k, o, i, v) for i, (k, o, v) in enumerate(rows)]


HOT = ["spread", "ties", "clumped", "constant", "unknown"]


@pytest.fixture(scope="module")
def frame(spark):
    df = spark.createDataFrame(awkward_rows(), "k string, o long, id long, v double")
    return df.repartition(5).persist()


def ordered(descending=False):
    first = F.col("o").desc_nulls_last() if descending else F.col("o").asc_nulls_first()
    return Window.partitionBy("k").orderBy(first, "id")


@pytest.mark.parametrize("descending", [True, False])
def test_ranked_equals_plain_window(frame, descending):
    w = ordered(descending)
    by_value = Window.partitionBy("k").orderBy(F.col("o").desc_nulls_last() if descending
                                               else F.col("o").asc_nulls_first())
    want = frame.select("id", F.row_number().over(w), F.rank().over(by_value), F.dense_rank().over(by_value))
    got = windows.ranked(frame, ["k"], "o", "id", descending, max_rows=10)
    assert rows(got, "id", "row_number", "rank", "dense_rank") == rows(want)


def test_slices_are_used_and_bounded(frame):
    sliced, names = skew.range_slices(frame, ["k"], "o", "id", max_rows=10)
    assert names
    sizes = sliced.groupBy("k", *names).count()
    assert sizes.agg(F.max("count")).first()[0] <= 15
    assert {r["k"] for r in sizes.groupBy("k").count().filter("count > 5").collect()} == {*HOT, None}


def test_any_number_of_hot_keys(spark):
    df = spark.range(4_000).select((F.col("id") % 200).alias("k"), "id")
    assert skew.find_hot(df, ["k"], 10).count() == 200
    want = df.select("id", F.row_number().over(Window.partitionBy("k").orderBy("id")))
    assert rows(windows.ranked(df, ["k"], "id", "id", False, max_rows=10), "id", "row_number") == rows(want)


@pytest.mark.parametrize("kind", ["decimal(38,0)", "double", "binary", "struct", "array", "text"])
def test_any_order_column_is_cut(spark, kind):
    base = spark.range(600).withColumn("m", F.col("id") % 211)
    made = {"decimal(38,0)": F.lit(2**62).cast("decimal(38,0)") * 1000 + F.col("m"), "double": F.pow(F.lit(10.0), F.col("m") % 31 - 15) * F.col("m"),
            "binary": F.unhex(F.hex("m")), "struct": F.struct(F.lit(1), "m"), "array": F.array(F.lit(0), "m"),
            "text": F.concat(F.repeat(F.lit("long prefix "), 300), F.col("m").cast("string"))}[kind]
    df = base.select("id", made.alias("o"))
    sliced, names = skew.range_slices(df, [], "o", "id", max_rows=60)
    assert sliced.groupBy(*names).count().agg(F.max("count")).first()[0] <= 90
    want = df.select("id", F.row_number().over(Window.orderBy("o", "id")), F.rank().over(Window.orderBy("o")),
                     F.dense_rank().over(Window.orderBy("o")))
    assert rows(windows.ranked(df, [], "o", "id", False, max_rows=60), "id", "row_number", "rank", "dense_rank") == rows(want)


def test_top_k_beyond_the_group_limit(spark):
    df = spark.range(9_000).select((F.col("id") % 2).alias("k"), "id")
    got = windows.top_per_group(df, ["k"], [F.col("id")], 1_500)
    assert rows(got, "id", "row_number") == sorted((i, i // 2 + 1) for i in range(3_000))


@pytest.mark.parametrize("hot", [10**6, 4_000])
def test_top_k_beyond_the_group_limit_is_one_shuffle_or_equal(spark, hot):
    df = spark.range(9_000).select(F.when(F.col("id") % 3 > 0, "hot").alias("k"), "id")
    got = windows.top_per_group(df, ["k"], [F.col("id").desc()], 1_001, max_rows=hot)
    w = Window.partitionBy("k").orderBy(F.col("id").desc())
    want = df.withColumn("row_number", F.row_number().over(w)).filter("row_number <= 1001")
    if hot == 10**6:
        assert plan(got).count("Exchange") == 1
    assert rows(got) == rows(want)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("k, max_rows", [(1, 10), (7, 10), (60, 10), (149, 10), (1_000, 10), (7, None), (7, 10_000)])
def test_top_by_value_equals_plain_window(frame, descending, k, max_rows):
    """Ties, nulls, clumps, keys of nulls only and a null key, with the cut in each of them."""
    got = windows.top_by_value(frame, ["k"], "o", "id", k, "n", descending, max_rows)
    want = frame.withColumn("n", F.row_number().over(ordered(descending)).cast("long")).filter(F.col("n") <= k)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_top_by_value_of_a_whole_table(frame):
    w = Window.orderBy(F.col("o").desc_nulls_last(), "id")
    want = frame.withColumn("n", F.row_number().over(w).cast("long")).filter("n <= 40")
    assert rows(windows.top_by_value(frame, [], "o", "id", 40, "n", max_rows=50)) == rows(want)


def test_top_by_value_of_text(frame):
    df = frame.withColumn("o", F.col("o").cast("string"))
    w = Window.partitionBy("k").orderBy(F.col("o").desc_nulls_last(), "id")
    want = df.withColumn("n", F.row_number().over(w).cast("long")).filter("n <= 5")
    assert rows(windows.top_by_value(df, ["k"], "o", "id", 5, "n", max_rows=10)) == rows(want)


def test_no_hot_group_no_slices(frame):
    assert skew.range_slices(frame, ["k"], "o", "id")[1] == []


def test_global_row_number(frame):
    w = Window.orderBy(F.col("o").asc_nulls_first(), "id")
    want = frame.select("id", F.row_number().over(w))
    assert rows(windows.global_row_number(frame, "o", "id", max_rows=10), "id", "row_number") == rows(want)


def test_lag_lead_equals_plain_window(frame):
    w = ordered()
    want = frame.select("id", F.lag("v", 1, -1.0).over(w), F.lead("v", 1, -1.0).over(w))
    got = windows.lag_lead(frame, ["k"], "o", "id", "v", "before", "after", default=-1.0, max_rows=10)
    assert rows(got, "id", "before", "after") == rows(want)


def test_fill_equals_plain_window(frame):
    w = ordered()
    to_here = w.rowsBetween(Window.unboundedPreceding, 0)
    from_here = w.rowsBetween(0, Window.unboundedFollowing)
    want = frame.select("id", F.last("v", True).over(to_here), F.first("v", True).over(from_here))
    got = windows.fill_gaps(frame, ["k"], "o", "id", "v", "ff", "bf", max_rows=10)
    assert rows(got, "id", "ff", "bf") == rows(want)


def test_running_total_equals_plain_window(frame):
    w = ordered().rowsBetween(Window.unboundedPreceding, 0)
    want = frame.select("id", F.sum("id").over(w))
    got = windows.running_total(frame, ["k"], "o", "id", "id", "upto", max_rows=10)
    assert rows(got, "id", "upto") == rows(want)


def test_partition_totals_equal_plain_window(frame):
    w = Window.partitionBy("k")
    want = frame.select("id", F.sum("id").over(w), F.max("id").over(w), F.count(F.lit(1)).over(w))
    got = windows.partition_totals(frame, ["k"], "id", total="t", highest="m", rows="n", max_rows=10)
    assert rows(got, "id", "t", "m", "n") == rows(want)


def test_top_ranked_keeps_all_ties(frame):
    w = Window.partitionBy("k").orderBy(F.col("o").desc_nulls_last())
    want = frame.withColumn("rank", F.rank().over(w)).filter("rank <= 3").select("id", "rank")
    assert rows(windows.top_ranked(frame, ["k"], "o", 3), "id", "rank") == rows(want)


@pytest.mark.parametrize("max_rows", [50, 1_000_000])
def test_exact_median_and_quantiles(frame, max_rows):
    want = frame.filter("v is not null").groupBy("k").agg(F.median("v"))
    assert rows(aggregate.exact_median(frame, ["k"], "v", max_rows=max_rows)) == rows(want)
    at = [0.0, 0.1, 0.5, 1.0]
    got = aggregate.exact_quantiles(frame, [], "id", {f"q{i}": p for i, p in enumerate(at)}, max_rows=max_rows)
    assert list(got.first()) == frame.approxQuantile("id", at, 0.0)


def heavy_values(kind):
    """Values with heavy ties at the ends of what lies between, extremes, and a few of everything."""
    r = random.Random(9)
    values = [0.0] * 700 + [1.0] * 900 + [r.random() for _ in range(400)] + [-1e308, 1e308, float("inf"), float("-inf")] + [float("nan")] * 60
    values += [r.gauss(0, 1e6) for _ in range(500)] + [None] * 50
    if kind == "long":
        values = [None if v is None or v != v or abs(v) > 1e9 else int(v * 1000) for v in values] + [2**62 + i % 7 for i in range(300)]
    r.shuffle(values)
    return [(("a", "b", None)[i % 3] if i % 5 else f"k{i % 50}", v) for i, v in enumerate(values)]


@pytest.mark.parametrize("kind, max_rows, tracked", [("double", 5, 32_768), ("long", 100, 32_768), ("long", 40, 16)])
def test_elements_are_found_by_narrowing(spark, monkeypatch, kind, max_rows, tracked):
    monkeypatch.setattr(narrowing, "KLL", 30)
    monkeypatch.setattr(narrowing, "GRID", 20)
    monkeypatch.setattr(skew, "TRACKED", tracked)
    df = spark.createDataFrame(heavy_values(kind), f"k string, v {kind}").repartition(4)
    at = {f"p{i}": (lambda n, p=p: F.greatest(F.ceil(F.lit(p) * n), F.lit(1))) for i, p in enumerate((0.0, 0.3, 0.5, 0.97, 1.0))}
    for keys in (["k"], []):
        assert str(rows(narrowing.elements_at(df, keys, "v", at, max_rows))) == str(rows(narrowing.elements_at(df, keys, "v", at, None)))


@pytest.mark.parametrize("kind", ["decimal(30,2)", "date", "timestamp", "string"])
def test_quantiles_of_other_types(spark, kind):
    numbers = spark.range(500).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 503).alias("n"))
    made = {"date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("n").cast("int")),
            "timestamp": F.timestamp_seconds(F.col("n") * 1_000_000), "string": F.format_string("t%04d", F.col("n"))}
    df = numbers.select("k", made.get(kind, F.col("n").cast(kind)).alias("v"))
    want = aggregate.exact_quantiles(df, ["k"], "v", {"a": 0.1, "b": 0.5}, None)
    assert rows(aggregate.exact_quantiles(df, ["k"], "v", {"a": 0.1, "b": 0.5}, 20)) == rows(want)
    assert want.schema["a"].dataType == df.schema["v"].dataType


def test_looking_for_hot_keys_shuffles_no_keys(spark):
    df = spark.range(5_000).withColumn("k", F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")))
    text = plan(skew.frequent_hashes(df, ["k"]))
    assert "hashpartitioning(_task" in text or "hashpartitioning(_groupingexpression" in text
    assert "hashpartitioning(k" not in text and "hashpartitioning(_key" not in text
    hot = skew.find_hot(df, ["k"], 1_000)
    assert rows(hot, "k", "_n") == [(-1, 2_500)]
    assert skew.find_hot(df.limit(0), ["k"], 10) is None


def test_missed_hot_keys_cost_no_result(spark, monkeypatch):
    """More hot keys than a sketch holds: some are missed, all results stay."""
    monkeypatch.setattr(skew, "TRACKED", 16)
    df = spark.range(4_000).select((F.col("id") % 200).alias("k"), "id")
    want = rows(df.select("id", F.row_number().over(Window.partitionBy("k").orderBy("id"))))
    assert rows(windows.ranked(df, ["k"], "id", "id", False, max_rows=10), "id", "row_number") == want
    totals = df.select("id", F.sum("id").over(Window.partitionBy("k")))
    assert rows(windows.partition_totals(df, ["k"], "id", total="t", max_rows=10), "id", "t") == rows(totals)


def test_heavy_keys_are_exact(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 10 == 1, "x").otherwise(F.col("id").cast("string")).alias("k"))
    assert rows(aggregate.heavy_keys(df, ["k"], 0.05)) == [(None, 2_500, 25.0), ("x", 1_000, 10.0)]
    with pytest.raises(ValueError):
        aggregate.heavy_keys(df, ["k"], 1e-6)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_forms_equal_plain_join(spark, frame, how):
    right = spark.createDataFrame([("ties", 1), ("ties", 2), ("k1", 3), (None, 4)], "k string, x int")
    want = rows(frame.join(right, ["k"], how), "k", "id", "x")
    assert rows(joins.salted_join(frame, right, ["k"], 8, how), "k", "id", "x") == want
    assert rows(joins.salted_join(frame, right, ["k"], 8, how, hot=["ties"]), "k", "id", "x") == want
    assert rows(joins.skew_join(frame, right, ["k"], how, max_rows=10), "k", "id", "x") == want
    assert rows(joins.skew_join(frame, right, ["k"], how), "k", "id", "x") == want
    assert rows(joins.split_hot_join(frame, right, "k", ["ties"], how), "k", "id", "x") == want


def test_broadcast_join_falls_back_when_too_large(spark, frame):
    right = spark.createDataFrame([("ties", 1), ("k1", 3)], "k string, x int")
    want = rows(frame.join(right, ["k"]), "id", "x")
    assert rows(joins.broadcast_join(frame, right, ["k"]), "id", "x") == want
    assert rows(joins.broadcast_join(frame, right, ["k"], max_rows=1), "id", "x") == want
    assert not joins.is_small(right, max_bytes=3)


def test_salt_is_the_same_in_any_partitioning(frame):
    salt = skew.spread_by_hash(frame.columns, 8)
    assert rows(frame.repartition(2).select("id", salt)) == rows(frame.repartition(9).select("id", salt))


def test_strings_and_dates_can_be_sliced(spark):
    data = [(f"w{i % 97}", f"2024-01-{i % 28 + 1:02d}", i) for i in range(400)]
    df = spark.createDataFrame(data, "s string, d string, id long").withColumn("d", F.to_date("d"))
    for column in ("s", "d"):
        w = Window.orderBy(column, "id")
        want = df.select("id", F.row_number().over(w))
        got = windows.global_row_number(df, column, "id", max_rows=20)
        assert rows(got, "id", "row_number") == rows(want)


@pytest.mark.parametrize("descending", [True, False])
def test_infinities_nan_and_null_keep_their_place(spark, descending):
    odd = [float("nan"), float("inf"), float("-inf"), None, 0.0, -0.0]
    data = [(odd[i % 12] if i % 12 < 6 else float(i % 50 - 25), i) for i in range(400)]
    df = spark.createDataFrame(data, "o double, id long")
    first = F.col("o").desc_nulls_last() if descending else F.col("o").asc_nulls_first()
    want = df.select("id", F.row_number().over(Window.orderBy(first, "id")), F.rank().over(Window.orderBy(first)))
    got = windows.ranked(df, [], "o", "id", descending, max_rows=10)
    assert rows(got, "id", "row_number", "rank") == rows(want)


def test_copies_survive_collapse_and_expand(spark):
    df = spark.createDataFrame([("a", 1)] * 25 + [("b", None)] * 3 + [("c", 2)], "k string, v int")
    packed = setops.collapse_copies(df)
    assert packed.count() == 3
    assert rows(setops.expand_copies(packed, chunk=4)) == rows(df)


def test_except_all_and_diff(spark):
    a = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    assert rows(setops.except_all(a, b)) == rows(a.exceptAll(b)) == [(1,), (1,), (2,)]
    assert rows(setops.frame_diff(a, b)) == [(1, "left"), (1, "left"), (2, "left"), (3, "right")]
    assert setops.frames_equal(a, a.repartition(3)) and not setops.frames_equal(a, b)
    assert not setops.frames_equal(a, a.withColumnRenamed("x", "y"))


def test_densify_gives_every_key_its_own_calendar(spark):
    df = spark.createDataFrame([("a", 3, 1.0), ("a", 6, 2.0), (None, 5, 3.0), ("b", None, 4.0)], "k string, y int, v double")
    assert rows(joins.densify(df, ["k"], "y", ["v"], 0.0)) == [
        (None, 5, 3.0), ("a", 3, 1.0), ("a", 4, 0.0), ("a", 5, 0.0), ("a", 6, 2.0)]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
@pytest.mark.parametrize("max_rows", [1, 1_000])
def test_broadcast_join_is_the_same_at_any_size(spark, frame, how, max_rows):
    right = spark.createDataFrame([("ties", 1), ("k1", 3), (None, 4), ("nowhere", 5)], "k string, x int")
    assert rows(joins.broadcast_join(frame, right, ["k"], how, max_rows=max_rows)) == rows(frame.join(right, ["k"], how))


def test_skew_join_of_frames_that_share_a_column(spark, frame):
    right = spark.createDataFrame([("ties", 1), (None, 4)], "k string, v int")
    assert joins.skew_join(frame, right, ["k"], "left", max_rows=10).count() == frame.join(right, ["k"], "left").count()


def test_fanout_guard(spark):
    left = spark.range(50).withColumn("k", F.lit(1))
    right = spark.range(20).select(F.lit(1).alias("k"))
    with pytest.raises(ValueError, match="1000 rows from 50"):
        joins.assert_join_fanout(left, right, ["k"], max_ratio=10)
    joins.assert_join_fanout(left, right.distinct(), ["k"], max_ratio=1)
