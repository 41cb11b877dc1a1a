"""What operators write on their way must go when their scratch does."""

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import leftovers
from helpers import rows
from rowloom import session
from rowloom.operators import skew, windows
from rowloom.sources import tables as catalog


def test_everything_goes_with_the_scratch(spark):
    before = leftovers(spark)
    with session.scratch(spark) as own:
        kept = session.stored(spark.range(5), "some-name")
        view, table = catalog.fresh_name("v", spark), catalog.fresh_name("t", spark)
        catalog.create_view(spark, view, "SELECT 1 AS one")
        catalog.save_table(spark.range(3), table, session.scratch_path(spark, "t"))
        spark.range(2).write.csv(session.scratch_path(spark, "csv"))
        assert kept.count() == 5 and spark.table(table).count() == 3
        assert len(os.listdir(own.folder.removeprefix("file://"))) == 3
        assert len(leftovers(spark)) == len(before) + 2
    assert leftovers(spark) == before


def test_errors_release_too(spark):
    before = leftovers(spark)
    with pytest.raises(ZeroDivisionError):
        with session.scratch(spark):
            session.stored(spark.range(5), "kept")
            raise ZeroDivisionError
    assert leftovers(spark) == before


def test_results_are_handed_over(spark):
    with session.scratch(spark) as outer:
        with session.scratch(spark) as inner:
            kept = session.stored(spark.range(5), "kept")
            result = inner.hand_over(kept.filter("id > 2"), "result")
        assert rows(result) == [(3,), (4,)]
        assert not os.path.exists(inner.folder.removeprefix("file://"))
        assert len(os.listdir(outer.folder.removeprefix("file://"))) == 1
        session.release(result, spark.range(1))
        assert os.listdir(outer.folder.removeprefix("file://")) == []


def test_without_a_scratch_the_session_keeps_it(spark):
    opened = session._open.set(())
    try:
        kept = session.stored(spark.range(4), "kept")
        folder = session.current_scratch(spark).folder.removeprefix("file://")
        assert kept.count() == 4 and os.path.exists(folder)
        session.release_all(spark)
        assert not os.path.exists(folder)
        session.release_all(spark)
    finally:
        session._open.reset(opened)


def test_no_hot_keys_leave_nothing(spark):
    with session.scratch(spark) as own:
        df = spark.range(100).withColumn("k", F.col("id") % 7)
        assert skew.find_hot(df, ["k"], 50) is None
        windows.ranked(df, ["k"], "id", "id").count()
        folder = own.folder.removeprefix("file://")
        assert not os.path.exists(folder) or os.listdir(folder) == []
        sliced, names = skew.range_slices(df, [], "id", "id", max_rows=30)
        assert names and len(os.listdir(folder)) == 1  # the slices only


def test_shuffle_files_go_with_the_write_that_made_them(spark):
    def shuffle_files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f.getName() for f in (found.apply(i) for i in range(found.size())) if f.getName().endswith(".data")}

    before, setting = shuffle_files(), spark.conf.get(session.SHUFFLE_CLEANUP, None)
    counts = spark.range(50_000).groupBy((F.col("id") % 1_000).alias("k")).count()
    kept = session.stored(counts.repartition(3, "count"), "counts")
    for _ in range(50):  # files are removed in the background
        left = shuffle_files() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(session.SHUFFLE_CLEANUP, None) == setting
    assert kept.count() == 1_000 and counts.count() == 1_000 and counts.count() == 1_000

    fails = spark.range(10).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        session.stored(fails, "fails")
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == setting
