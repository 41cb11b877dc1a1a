"""Files, tables and the scratch folder."""

import glob
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from rowloom import session
from rowloom.operators import pandas_ops, setops
from rowloom.sources import files, tables as catalog


class FakeContext:
    """As much of a SparkContext as the scratch folder asks for."""

    def __init__(self, master, checkpoint_dir=None):
        self.master, self.checkpoint_dir, self.applicationId = master, checkpoint_dir, "fake"

    def getCheckpointDir(self):
        return self.checkpoint_dir

    def setCheckpointDir(self, path):
        self.checkpoint_dir = path


def fake_session(master, setting=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting or default),
                           sparkContext=FakeContext(master), sql=lambda text: None)


def test_scratch_follows_the_setting():
    spark = fake_session("spark://cluster", "hdfs:///shared/")
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert re.match("hdfs:///shared/rowloom/[0-9a-f]{32}/x-", a) and a != b
    session.ensure_checkpoint_dir(spark)
    assert spark.sparkContext.checkpoint_dir == "hdfs:///shared/"


def test_scratch_is_the_checkpoint_folder_or_the_warehouse():
    unset = fake_session("yarn")
    unset.conf.get = lambda key, *default: {"spark.sql.warehouse.dir": "hdfs://x/warehouse"}.get(key, *default)
    assert session.scratch_root(unset) == "hdfs://x/warehouse"


def test_csv_without_inference_is_text(spark, tables, tmp_path):
    files.write_csv(tables.nation, str(tmp_path / "n"))
    assert {t for _, t in files.read_csv(spark, str(tmp_path / "n")).dtypes} == {"string"}
    assert files.read_csv(spark, str(tmp_path / "n"), infer=True).dtypes[0] == ("n_nationkey", "int")
    assert files.read_csv(spark, str(tmp_path / "n"), header=False).columns[0] == "_c0"


def test_sized_csv(spark, tmp_path):
    files.write_sized_csv(spark.range(100, numPartitions=5), str(tmp_path / "one"), 1_000)
    files.write_sized_csv(spark.range(100, numPartitions=5), str(tmp_path / "more"), 30)
    assert len(glob.glob(str(tmp_path / "one" / "part-*"))) == 1
    assert len(glob.glob(str(tmp_path / "more" / "part-*"))) == 4
    assert files.read_csv(spark, str(tmp_path / "more"), "id long").count() == 100


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "p")
    files.write_parquet(spark.range(3), path)
    with pytest.raises(Exception, match="already exists"):
        files.write_parquet(spark.range(3), path)
    files.write_parquet(spark.range(9), path, "ignore")
    assert spark.read.parquet(path).count() == 3
    files.write_parquet(spark.range(5), path, "overwrite")
    assert spark.read.parquet(path).count() == 5


def test_json_multi_line_and_encoding(spark, tmp_path):
    path = tmp_path / "k.json"
    path.write_bytes('[{"word": "café",\n "n": 1},\n {"word": "thé", "n": 2}]'.encode("iso-8859-1"))
    got = files.read_json(spark, str(path), multi_line=True, encoding="ISO-8859-1")
    assert rows(got, "word", "n") == [("café", 1), ("thé", 2)]


def test_avro_says_what_is_missing(spark, tmp_path):
    if files.avro_available(spark):
        files.write_avro(spark.range(3), str(tmp_path / "a"))
        assert files.read_avro(spark, str(tmp_path / "a")).count() == 3
    else:
        with pytest.raises(RuntimeError, match="spark-avro"):
            files.write_avro(spark.range(3), str(tmp_path / "a"))
        with pytest.raises(RuntimeError, match="spark-avro"):
            files.read_avro(spark, str(tmp_path / "a"))


def test_insert_by_position(spark):
    name, path = catalog.fresh_name("t", spark), session.scratch_path(spark, "t")
    spark.sql(f"CREATE TABLE {name} (a INT, b INT) USING PARQUET LOCATION '{path}'")
    catalog.insert_positional(spark.createDataFrame([(2, 1)], "b int, a int"), name)
    assert rows(spark.table(name)) == [(1, 2)]
    catalog.insert_positional(spark.createDataFrame([(3, 4)], "a int, b int"), name, overwrite=False)
    assert rows(spark.table(name)) == [(1, 2), (3, 4)]
    with pytest.raises(ValueError, match="do not match"):
        catalog.insert_positional(spark.createDataFrame([(1, 2)], "a int, c int"), name)


def test_dynamic_overwrite_leaves_the_setting(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    name = catalog.fresh_name("d", spark)
    catalog.save_table(spark.createDataFrame([(1, 1), (2, 2)], "v int, p int"), name,
                       session.scratch_path(spark, "table"), partition_by=["p"])
    catalog.insert_positional(spark.createDataFrame([(2, 20)], "p int, v int"), name)
    assert rows(spark.table(name), "p", "v") == [(1, 1), (2, 20)]
    assert spark.conf.get(key) == before


def test_staged_plan_starts_at_a_scan(spark):
    df = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    text = plan(catalog.staged(df))
    assert "FileScan parquet" in text and "Exchange" not in text


def test_bucketed_tables_join_without_a_shuffle(spark, tables):
    a, b = catalog.fresh_name("a", spark), catalog.fresh_name("b", spark)
    x = catalog.save_table(tables.orders, a, session.scratch_path(spark, "table"), buckets=4,
                           bucket_by=["o_orderkey"], sort_by=["o_orderkey"])
    y = catalog.save_table(tables.lineitem, b, session.scratch_path(spark, "table"), buckets=4,
                           bucket_by=["l_orderkey"], sort_by=["l_orderkey"])
    joined = x.join(y.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert joined.count() == tables.lineitem.count()


def test_hot_bucket_key_is_written_by_several_tasks(spark, monkeypatch):
    df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id")
    real = catalog.find_hot
    monkeypatch.setattr(catalog, "find_hot", lambda frame, keys: real(frame, keys, 500))
    name, path = catalog.fresh_name("hot", spark), session.scratch_path(spark, "hot")
    table = catalog.save_table(df, name, path, buckets=4, bucket_by=["k"])
    assert setops.frames_equal(table, df)
    files_of_key = table.filter("k = 7").select(F.input_file_name()).distinct().count()
    assert files_of_key > 3
    cold = catalog.fresh_name("cold", spark)
    monkeypatch.setattr(catalog, "find_hot", real)
    catalog.save_table(df, cold, session.scratch_path(spark, "table"), buckets=4, bucket_by=["k"])
    assert spark.table(cold).select(F.input_file_name()).distinct().count() == 4


def test_pandas_cogroup_with_hot_key(spark):
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)], "k long, v long")
    right = spark.range(0, 300, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    got = pandas_ops.cogroup_unique(left, right, "k", lambda a, b: a.merge(b, on="k")[["k", "v", "w"]],
                                    "k long, v long, w long", max_rows=20)
    assert setops.frames_equal(got, left.join(right, "k").select("k", "v", "w"))


def test_pandas_group_mean(tables):
    got = pandas_ops.group_mean(tables.events.repartition(5), ["event_type"], "value", "m")
    want = tables.events.groupBy("event_type").agg(F.mean("value"))
    for a, b in zip(rows(got), rows(want)):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1])
