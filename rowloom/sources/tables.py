"""Catalog tables and views.

Tables that are not to last have names and paths in the current scratch (see
``rowloom.session``), so they and their files go with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowloom.operators.skew import attach, find_hot, spread_by_hash
from rowloom.session import current_scratch, stored


def fresh_name(prefix: str, spark: SparkSession | None = None) -> str:
    """A table or view name that no other run uses; with a session it lies in the current scratch."""
    return f"{prefix}_{uuid.uuid4().hex}" if spark is None else current_scratch(spark).table_name(prefix)


def save_table(df: DataFrame, name: str, path: str, *, mode: str = "errorifexists",
               partition_by: Sequence[str] = (), buckets: int = 0, bucket_by: Sequence[str] = (),
               sort_by: Sequence[str] = ()) -> DataFrame:
    """Write a table, optionally partitioned and bucketed, and read it back."""
    if buckets:
        df = _by_bucket(df, buckets, bucket_by)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def bucket_count(df: DataFrame, rows_per_bucket: int = 1_000_000) -> int:
    """Buckets of about so many rows each."""
    return max(1, -(-df.count() // rows_per_bucket))


def _by_bucket(df: DataFrame, buckets: int, bucket_by: Sequence[str]) -> DataFrame:
    """Rows brought together by bucket, so that a bucket gets one file and not one per task.

    Rows of a hot key are spread over several tasks and files of their bucket.
    """
    bucket, hot = F.pmod(F.hash(*bucket_by), F.lit(buckets)), find_hot(df, bucket_by)
    if hot is None:
        return df.repartition(buckets, bucket)
    salt = F.coalesce(spread_by_hash(df.columns, F.col("_parts")), F.lit(0))
    parts = buckets + hot.agg(F.sum("_parts")).first()[0]
    return (attach(df, hot, bucket_by, ["_parts"])
            .repartition(parts, bucket, salt).drop("_parts"))


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write the frame and go on from the written table; its plan starts at a scan.

    The table goes with the current scratch, or by ``session.release`` as soon as its last reader has run.
    """
    return stored(df, name)


def insert_positional(df: DataFrame, table: str, overwrite: bool = True) -> None:
    """Insert by position after ordering the columns as the table has them.

    A frame that lacks a column, or has one too many, is an error rather than
    a silent shift.  In a partitioned table only the partitions present in
    ``df`` are replaced.
    """
    spark = df.sparkSession
    columns = spark.table(table).columns
    if set(columns) != set(df.columns):
        raise ValueError(f"columns {sorted(df.columns)} do not match table {sorted(columns)}")
    ordered = df.select(*columns)
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if parts:
        ordered = ordered.hint("rebalance", *parts)
    if overwrite and parts:
        # The insert takes the mode from the session only, so that is changed around it and put back.
        view, key = fresh_name("incoming"), "spark.sql.sources.partitionOverwriteMode"
        ordered.createOrReplaceTempView(view)
        before = spark.conf.get(key)
        spark.conf.set(key, "dynamic")
        try:
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({', '.join(parts)}) SELECT * FROM {view}")
        finally:
            spark.conf.set(key, before)
            spark.catalog.dropTempView(view)
    else:
        ordered.write.insertInto(table, overwrite=overwrite)


def create_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """A persistent view and its rows."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


def sql_over(query: str, **frames: DataFrame) -> DataFrame:
    """Run SQL over frames, each under its own name in braces."""
    spark = next(iter(frames.values())).sparkSession
    return spark.sql(query, **frames)
