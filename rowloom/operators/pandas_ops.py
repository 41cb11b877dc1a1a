"""pandas functions where Spark partitions and shuffles the work.

A pandas function sees one Arrow batch, one slice or one salted group at a
time; nothing here hands it a whole hot group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowloom.operators.joins import group_values, salt_sides
from rowloom.operators.skew import MAX_GROUP_ROWS, find_hot


@F.pandas_udf(T.DoubleType())
def scaled(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """A scalar-iterator function: what is set up before the loop serves all batches of a task."""
    step = 10.0
    for value, offset in batches:
        yield (value - offset) / step


@F.pandas_udf(T.DoubleType())
def distance_km(x: pd.Series, y: pd.Series, to_x: pd.Series, to_y: pd.Series) -> pd.Series:
    """Straight-line distance in kilometres between points in metres."""
    return ((x - to_x) ** 2 + (y - to_y) ** 2) ** 0.5 / 1000


def map_batches(df: DataFrame, function: Callable[..., pd.DataFrame], schema: str, **arguments) -> DataFrame:
    """``function(batch, **arguments)`` per Arrow batch, with an explicit schema."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch, **arguments)
    return df.mapInPandas(run, schema)


def grouped_totals(df: DataFrame, keys: Sequence[str], partial: Callable[..., pd.DataFrame], schema: str,
                   merge: Sequence[Column], **arguments) -> DataFrame:
    """Group-wise pandas aggregate in two steps.

    ``partial`` reduces one batch to few rows (keys and partial results) before
    the shuffle; ``merge`` combines those natively per key.  A hot key thus
    costs one row per batch and is never gathered.
    """
    return map_batches(df, partial, schema, **arguments).groupBy(*keys).agg(*merge)


def sums_and_counts(batch: pd.DataFrame, by: list[str], column: str) -> pd.DataFrame:
    """Per-batch sum and count of a column, for means."""
    grouped = batch.groupby(by, dropna=False)[column]
    return grouped.agg(part_sum="sum", part_n="count").reset_index()


def group_mean(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """D3: mean per key from pandas partial sums."""
    fields = [df.schema[k] for k in keys]
    schema = T.StructType([*fields, T.StructField("part_sum", T.DoubleType()),
                           T.StructField("part_n", T.LongType())])
    mean = F.try_divide(F.sum("part_sum"), F.sum("part_n")).alias(name)
    return grouped_totals(df.select(*keys, F.col(column).cast("double").alias(column)), keys,
                          sums_and_counts, schema, [mean], by=list(keys), column=column)


def mean_over_group(df: DataFrame, keys: Sequence[str], column: str, name: str,
                    max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """The group's mean on every row; native aggregate, hot keys split."""
    return group_values(df, keys, {name: F.mean(column)}, max_rows)


def pct_deviation(df: DataFrame, keys: Sequence[str], column: str, name: str,
                  max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Percentage above or below the group's mean."""
    mean = F.col("_mean")
    return (mean_over_group(df, keys, column, "_mean", max_rows)
            .withColumn(name, F.try_divide(F.col(column) - mean, mean) * 100).drop("_mean"))


def cogroup_unique(left: DataFrame, right: DataFrame, key: str,
                   function: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str,
                   max_rows: int = 100_000) -> DataFrame:
    """Cogrouped pandas function against a side that has one row per key.

    Keys are cogrouped in blocks of about ``max_rows`` left rows, so there is
    one call per block and not one per key; the number of blocks grows with the
    table.  Hot keys are split over blocks that each get a copy of the right
    row.  ``function`` gets all rows of its block and must treat left rows
    independently of each other.
    """
    # Every key is salted by its share of a block, so no call gets much more than a block.
    hot = find_hot(left, [key], max_rows)
    if hot is None:
        a, b = left.withColumn("_salt", F.lit(0)), right.withColumn("_salt", F.lit(0))
    else:
        a, b = salt_sides(left, right, [key], hot)
    rows = left.agg(F.count(F.lit(1))).scalar()
    blocks = F.greatest(F.ceil(rows / max_rows), F.lit(1))

    def in_blocks(df: DataFrame) -> DataFrame:
        return df.withColumn("_block", F.pmod(F.xxhash64(key, "_salt"), blocks)).drop("_salt").groupBy("_block")

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        return function(x.drop(columns="_block"), y.drop(columns="_block"))

    return in_blocks(a).cogroup(in_blocks(b)).applyInPandas(run, schema)
