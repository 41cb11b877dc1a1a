"""Small inputs with hand-checked results."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import plan, rows
from rowloom.functions import scalars
from rowloom.operators import aggregate, joins, layout, quality, setops, shape, windows
from rowloom.sources import generators

# 16 periods in two areas with gaps, and the filled result.
SERIES = [("A", "20210101", 100), ("A", "20210106", None), ("A", "20210111", None), ("A", "20210116", 130),
          ("A", "20210121", 100), ("A", "20210126", 120), ("A", "20210131", None), ("A", "20210205", 130),
          ("B", "20210101", None), ("B", "20210111", 85), ("B", "20210119", 82), ("B", "20210131", 75),
          ("B", "20210210", None), ("B", "20210215", 85), ("B", "20210220", None), ("B", "20210225", 75)]
FILLED = [100, 110, 120, 130, 100, 120, 125, 130, None, 85, 82, 75, 81.667, 85, 80, 75]


@pytest.mark.parametrize("max_rows", [1_000_000, 2])
def test_interpolation_golden(spark, max_rows):
    df = (spark.createDataFrame(SERIES, "area string, period string, n int")
          .withColumn("period", F.to_date("period", "yyyyMMdd")))
    got = windows.interpolate(df, ["area"], "period", "n", max_rows=max_rows).orderBy("area", "period").collect()
    assert [None if r["filled"] is None else round(r["filled"], 3) for r in got] == FILLED
    assert [r["imputed"] for r in got] == [int(n is None) for _, _, n in SERIES]


def test_interpolation_gives_the_same_on_timestamps(spark):
    df = spark.createDataFrame(SERIES, "area string, period string, n int")
    for kind in ("timestamp", "timestamp_ntz"):
        typed = df.withColumn("period", F.to_timestamp("period", "yyyyMMdd").cast(kind))
        got = windows.interpolate(typed, ["area"], "period", "n").orderBy("area", "period").collect()
        assert [None if r["filled"] is None else round(r["filled"], 3) for r in got] == FILLED


@pytest.mark.parametrize("label, n", [("Cat", 3), ("Dog", 1), ("Hamster", 0), ("cat", 0), ("CAT", 0)])
def test_count_by_label(spark, label, n):
    df = spark.createDataFrame([(1, "cat"), (2, "Cat"), (3, "CAT"), (4, "dog")], "id int, animal string")
    assert shape.count_by_label(df, "animal", label).first()["n"] == n


def test_group_count_title_case(spark):
    df = spark.createDataFrame([("cat",), ("CAT",), ("Dog",), ("dOG",), ("hamster",)], "animal string")
    assert rows(aggregate.group_count(df, ["animal"], ["animal"])) == [("Cat", 2), ("Dog", 2), ("Hamster", 1)]


def test_format_columns_order_types_and_missing(spark):
    names = {"Number": "number", "Animal": "animal", "Pumps": "engines", "Text": "text"}
    df = spark.createDataFrame([("x", 2.0, "some WORDS", "t")], "Number string, Pumps double, Animal string, Text string")
    out = shape.format_columns(df, names, ["Animal"])
    assert out.dtypes == [("number", "string"), ("animal", "string"), ("engines", "double"), ("text", "string")]
    assert out.first()["animal"] == "Some Words"
    with pytest.raises(AnalysisException):
        shape.format_columns(df.withColumnRenamed("Pumps", "wrong"), names)


@pytest.mark.parametrize("value, square", [(4.0, 16.0), (0.5, 0.25), (-7.0, 49.0), (0.0, 0.0), (20001.0, 400040001.0),
                                           (None, None)])
def test_square(spark, value, square):
    df = spark.createDataFrame([(value,)], "x double")
    assert scalars.add_square(df, "x", "y").first()["y"] == square


def test_rounding_of_halves(spark):
    df = spark.createDataFrame([(i / 2,) for i in range(-7, 8, 2)], "x double").orderBy("x")
    got = df.select(F.round("x"), F.bround("x")).collect()
    assert [r[0] for r in got] == [-4, -3, -2, -1, 1, 2, 3, 4]
    assert [r[1] for r in got] == [-4, -2, -2, 0, 0, 2, 2, 4]


def test_padding(spark):
    df = spark.createDataFrame([("955141", "146647151")], "a string, b string")
    got = df.select(F.lpad("b", 3, "0"), F.lpad("a", 9, "0"), F.lpad("a", 14, "xyz"), F.rpad("a", 9, "0")).first()
    assert tuple(got) == ("146", "000955141", "xyzxyzxy955141", "955141000")


def test_wrap_and_safe_casts(spark):
    df = spark.range(5).select((F.col("id") * 1_000_000_000).alias("n"))
    assert [r[0] for r in df.select(shape.wrap_to_int("n")).collect()] == [
        0, 1_000_000_000, 2_000_000_000, -1_294_967_296, -294_967_296]
    assert [r[0] for r in shape.cast_columns(df, {"n": "int"}).collect()][3:] == [None, None]


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(6.0, 2.0), (6.0, 0.0), (None, 2.0)], "a double, b double")
    assert [r["q"] for r in shape.ratio(df, "a", "b", "q").collect()] == [3.0, None, None]


def test_bins_are_contiguous(spark):
    df = spark.createDataFrame([(1,), (9,), (10,), (19,), (29,), (None,)], "age int")
    got = shape.bin_values(df, "age", [9, 19], ["young", "older", "oldest"], "band").collect()
    assert [r["band"] for r in got] == ["young", "young", "older", "older", "oldest", None]
    with pytest.raises(ValueError):
        shape.bin_values(df, "age", [19, 9], ["a", "b", "c"], "band")


def test_clean_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Cost(£)", "Fire Brigade-No."])
    assert shape.clean_names(df, {"(£)": "GBP"}).columns == ["CostGBP", "Fire_Brigade_No"]
    with pytest.raises(ValueError, match="collide"):
        shape.clean_names(spark.createDataFrame([(1, 2)], ["a b", "a-b"]))


def test_dates(spark):
    df = spark.createDataFrame([("01/01/2009 03:01",), ("nonsense",)], "s string")
    days = df.select(scalars.parse_date("s", "dd/MM/yyyy HH:mm").alias("d"))
    assert [r["d"] for r in days.collect()] == [dt.date(2009, 1, 1), None]
    moved = days.select(F.expr("d - interval 13 days"), F.expr("d + interval 1 year 3 months")).first()
    assert tuple(moved) == (dt.date(2008, 12, 19), dt.date(2010, 4, 1))


def test_epoch_does_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2022-03-27 01:30:00' AS at")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        found = set()
        for other in ("UTC", "Europe/London", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            found.add(df.select(scalars.epoch_seconds(df, "at")).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == {1_648_344_600}


def test_calendar_counts(spark):
    df = spark.createDataFrame([(dt.date(2019, 12, 25),), (dt.date(2019, 12, 25),), (dt.date(2020, 1, 7),),
                                (dt.date(2020, 2, 1),)], "d date")
    days = {"Dec-25": "Christmas Day"}
    assert rows(scalars.calendar_counts(df, "d", days)) == [(dt.date(2019, 12, 25), "Christmas Day", 2)]
    assert rows(scalars.calendar_counts(df, "d", days, 13)) == [(dt.date(2020, 1, 7), "Christmas Day", 1)]


def test_arrays(spark):
    df = spark.createDataFrame([(1, ["6-3", "6-1"]), (2, None)], "id int, score array<string>")
    assert [r[0] for r in df.select(scalars.array_size("score")).collect()] == [2, -1]
    assert df.select(F.explode("score")).count() == 2 and df.select(F.explode_outer("score")).count() == 3
    assert [r[0] for r in df.select(F.concat_ws(", ", "score")).collect()] == ["6-3, 6-1", ""]


def test_top_two_gap(spark):
    ages = {0: (7, 9, 10), 1: (9, 5, 6), 2: (4, 3, 10), 3: (1, 4, 10), 4: (8, 7, 3)}
    df = spark.createDataFrame([(g, float(a), g * 10 + i) for g, vs in ages.items() for i, a in enumerate(vs)],
                               "g int, age double, id int")
    got = windows.top_two_gap(df, ["g"], "age", "id", 5)
    assert rows(got.filter("gap_flag = 1"), "g", "top_two_gap") == [(2, 6.0), (3, 6.0)]
    assert rows(got.filter("top_two_gap > 0"), "g", "top_two_gap") == [(0, 1.0), (1, 3.0), (2, 6.0), (3, 6.0), (4, 1.0)]


def test_union_by_name(spark):
    a = spark.createDataFrame([(2017, "x", "p")], "year int, event string, champion string")
    b = spark.createDataFrame([("y", 2018)], "event string, year int")
    c = spark.createDataFrame([(2019,), (2019,)], "year int")
    got = setops.union_by_name([a, b, c])
    assert got.columns == ["year", "event", "champion"]
    assert rows(got) == [(2017, "x", "p"), (2018, "y", None), (2019, None, None), (2019, None, None)]
    assert setops.union_distinct([c, c]).count() == 1


def test_lookup_case_with_null_target(spark):
    df = spark.createDataFrame([("999",), ("coastguard",), ("other",), (None,)], "origin string")
    got = joins.lookup_case(df, "origin", {"999": "phone", "coastguard": None}, "how", default="unknown")
    assert [r["how"] for r in got.collect()] == ["phone", None, "unknown", "unknown"]


def test_null_is_a_level_of_its_own(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "null"), (None, "x")], "p string, q string")
    assert rows(aggregate.contingency(df, "p", "q")) == [(None, "x", 1), ("a", None, 1), ("a", "x", 1), ("b", "null", 1)]
    with pytest.raises(Exception, match="not listed: y"):
        aggregate.pivot_agg(spark.createDataFrame([(1, "x"), (1, "y")], "k int, q string"), ["k"], "q", ["x"], [F.count("k")]).collect()


def test_cramers_v(spark):
    table = {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 30, ("b", "y"): 0}
    df = spark.createDataFrame([k for k, n in table.items() for _ in range(n)], "p string, q string")
    total, r, c = 60, {"a": 30, "b": 30}, {"x": 40, "y": 20}
    chi2 = sum((n - r[a] * c[b] / total) ** 2 / (r[a] * c[b] / total) for (a, b), n in table.items())
    assert aggregate.cramers_v(df, "p", "q").first()[0] == pytest.approx((chi2 / total) ** 0.5)
    assert aggregate.cramers_v(df.withColumn("q", F.lit("one")), "p", "q").first()[0] is None


def test_label_collisions(spark):
    df = spark.createDataFrame([("cat",), ("Cat",), ("dog",), (None,)], "a string")
    assert rows(aggregate.label_collisions(df, "a")) == [("cat", 2, "Cat", "cat")]


def test_quantile_error_is_bounded(tables):
    error = aggregate.quantile_error(tables.orders, "o_totalprice", 0.5, 100).first()
    ranks = tables.orders.filter(F.col("o_totalprice") <= error["estimate"]).count() / tables.orders.count()
    assert abs(ranks - 0.5) <= 0.02


def test_filtered_sum_without_rows_is_null(spark):
    df = spark.range(5)
    assert aggregate.filtered_sum(df, F.col("id") > 9, "id", "s").first()["s"] is None


def test_distinct_count_of_missing_column(spark):
    assert aggregate.distinct_count(spark.range(5), "id").first()[0] == 5
    assert aggregate.distinct_count(spark.range(5), "nope").first()[0] == 0


def test_skew_generator_shares(spark):
    df = spark.range(1_000_000).select(generators.skewed_key("id").alias("k"))
    assert rows(shape.share_of_total(df, ["k"])) == [("A", 100, 0.01), ("B", 900, 0.09), ("C", 9000, 0.9),
                                                     ("D", 90000, 9.0), ("E", 900000, 90.0)]


def test_edge_cases_keep_rows_and_repeat(tables):
    a = generators.edge_cases(tables.orders.drop("o_orderdate"), "o_orderkey")
    assert a.count() == tables.orders.count()
    assert a.filter("o_totalprice is null").count() > 0 and a.filter("o_orderstatus = ''").count() > 0
    b = generators.edge_cases(tables.orders.drop("o_orderdate").repartition(7), "o_orderkey")
    assert setops.frames_equal(a, b)


def test_frame_assertion(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, s string")
    quality.assert_same_frame(a, a.orderBy(F.desc("id")))
    with pytest.raises(AssertionError, match="columns differ"):
        quality.assert_same_frame(a, a.select("s", "id"))
    with pytest.raises(AssertionError, match="rows differ"):
        quality.assert_same_frame(a, a.union(a.limit(1)))


def test_safe_read(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no such path"):
        quality.safe_read_parquet(spark, str(tmp_path / "missing"))
    spark.range(3).write.parquet(str(tmp_path / "there"))
    assert quality.safe_read_parquet(spark, str(tmp_path / "there")).count() == 3


def test_dq_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b"), (None, "b")], "n int, s string")
    got = quality.dq_profile(df, ["n", "s"], {"n": F.col("n") > 1})
    assert rows(got, "column", "n_rows", "n_null", "n_distinct", "lowest", "highest") == [
        ("n", 4, 1, 2, "1", "2"), ("s", 4, 1, 2, "a", "b")]
    assert {r["column"]: r["pass_pct"] for r in got.collect()} == {"n": pytest.approx(200 / 3), "s": None}


def test_dq_profile_counts_each_column_by_itself(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0.0, None, "x"), (-0.0, None, "x"), (nan, None, None), (nan, None, "y"), (None, None, "y")],
                               "`a.b` double, n int, s string")
    rules = {"a.b": F.col("s") == "x", "n": F.col("n") > 0}
    exact = quality.dq_profile(df, ["a.b", "n", "s"], rules)
    assert "Expand" not in plan(exact) and plan(exact).count("Scan") == 3
    want = [("a.b", 5, 1, 2, "NaN", 50.0), ("n", 5, 5, 0, None, None), ("s", 5, 1, 2, "y", None)]
    parts = ["column", "n_rows", "n_null", "n_distinct", "highest", "pass_pct"]
    assert [tuple(r) for r in exact.select(parts).orderBy("column").collect()] == want
    sketched = quality.dq_profile(df, ["a.b", "n", "s"], rules, approximate=["a.b", "s"])
    assert [tuple(r) for r in sketched.select(parts).orderBy("column").collect()] == want
    for approximate in ([], ["s"]):
        empty = quality.dq_profile(df.limit(0), ["s"], {"s": F.col("s") == "x"}, approximate).first()
        assert tuple(empty) == ("s", 0, 0, 0, None, None, None)


def test_dq_profile_keeps_the_sign_of_zero(spark):
    for kind in ("double", "float"):
        for approximate in ([], ["x"]):
            for values, want in ([(-0.0, 2.5), ("-0.0", "2.5")], [(0.0, 2.5), ("0.0", "2.5")], [(-1.0, -0.0), ("-1.0", "-0.0")],
                                 [(0.0, -0.0, None), ("-0.0", "0.0")], [(None,), (None, None)]):
                df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
                assert tuple(quality.dq_profile(df, ["x"], approximate=approximate).select("lowest", "highest").first()) == want


def test_reuse_releases_the_frame(spark):
    with layout.reused(spark.range(10)) as kept:
        assert kept.storageLevel.useMemory and kept.count() == 10
    assert not kept.storageLevel.useMemory


def test_iterated_columns_agree_with_checkpoints(spark):
    df = spark.range(100).withColumn("col_0", F.col("id") % 12 + 1)

    def step(previous, i):
        return F.when(previous > i, previous).otherwise(0)

    plain = layout.iterate_columns(df, "col_0", 11, step)
    cut = layout.iterate_columns(df, "col_0", 11, step, checkpoint_every=3)
    assert setops.frames_equal(plain, cut) and len(plain.columns) == 13


def test_partition_helpers(spark):
    df = spark.range(1000, numPartitions=8)
    profile = layout.partition_profile(df)
    assert profile.count() == 8 and profile.agg(F.sum("n")).first()[0] == 1000
    assert layout.shrink_partitions(df, 0.25).rdd.getNumPartitions() == 2
    assert layout.spread_partitions(df, 5).rdd.getNumPartitions() == 5
