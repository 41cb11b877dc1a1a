"""Checks, safe reads and cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType

from rowloom.operators.setops import frame_diff, frames_equal, union_all


def assert_same_frame(left: DataFrame, right: DataFrame, show: int = 10) -> None:
    """Q1: same columns in the same order and the same bag of rows, or an error with examples."""
    if left.columns != right.columns:
        raise AssertionError(f"columns differ: {left.columns} and {right.columns}")
    if frames_equal(left, right):
        return
    examples = frame_diff(left, right).take(show)
    if examples:
        raise AssertionError("rows differ, for example:\n" + "\n".join(map(str, examples)))


def safe_read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Q2: clear errors for a stopped session and for a missing path."""
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        raise RuntimeError("the Spark session has stopped; start a new one")
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such path: {path}") from error
        raise


def dq_profile(df: DataFrame, columns: Sequence[str], rules: Mapping[str, Column] | None = None,
               approximate: Sequence[str] = ()) -> DataFrame:
    """Q4: completeness, uniqueness and validity, one row per column.

    ``rules`` gives a condition per column; ``pass_pct`` is the share of its
    non-null values that meet it (null without a rule).

    Each column is counted by value on its own: its distinct values are combined within
    tasks and only these are shuffled, and a file that is stored by columns is
    read once in all.  Store a frame that is costly to derive first, as each column derives it again.
    Columns named in ``approximate`` get a distinct count from a sketch (about 1 % off) and no shuffle of values.

    Zeros of both signs are one value; ``lowest`` and ``highest`` show the sign, -0.0 below 0.0.
    """
    rules = rules or {}
    return union_all([_column_profile(df, c, rules.get(c), c in approximate) for c in columns])


def _column_profile(df: DataFrame, column: str, rule: Column | None, approximate: bool) -> DataFrame:
    value = F.col(f"`{column}`")
    one = df.select(value.alias("_v"), (F.lit(None).cast("boolean") if rule is None else rule).alias("_ok"))
    counts = [F.count(F.lit(1)).alias("n_rows"), F.count("_v").alias("_known"),
              F.count_if(F.col("_v").isNotNull() & F.col("_ok")).alias("_valid")]
    least, most = F.min("_v").cast("string"), F.max("_v").cast("string")
    if isinstance(one.schema["_v"].dataType, (FloatType, DoubleType)):
        # Grouping makes -0.0 and 0.0 one value, so the signs are kept as texts, which sort like them.
        zero = F.when(F.col("_v") == 0, F.col("_v").cast("string"))
        signs = [F.min(zero).alias("_zero_low"), F.max(zero).alias("_zero_high")]
        least = F.when(F.min("_v") == 0, F.min(zero if approximate else F.col("_zero_low"))).otherwise(least)
        most = F.when(F.max("_v") == 0, F.max(zero if approximate else F.col("_zero_high"))).otherwise(most)
    else:
        signs = []
    ends = [least.alias("lowest"), most.alias("highest")]
    if approximate:
        summed = one.agg(*counts, F.approx_count_distinct("_v", 0.01).alias("n_distinct"), *ends)
    else:
        by_value = one.groupBy("_v").agg(*counts, *signs)
        summed = by_value.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_rows", "_known", "_valid")],
                              F.count("_v").alias("n_distinct"), *ends)
    share = F.lit(None).cast("double") if rule is None else F.try_divide(F.col("_valid") * 100.0, F.col("_known"))
    return summed.select(F.lit(column).alias("column"), "n_rows", (F.col("n_rows") - F.col("_known")).alias("n_null"),
                         "n_distinct", "lowest", "highest", share.alias("pass_pct"))


def clean_table(df: DataFrame, *, drop: Sequence[str], names: Mapping[str, str], date_column: str,
                date_format: str, ratio: tuple[str, str, str], required: Sequence[str]) -> DataFrame:
    """Q5: drop, rename, parse a date, derive a ratio, drop incomplete rows; all narrow."""
    top, bottom, name = ratio
    return (df.drop(*drop).withColumnsRenamed(dict(names))
            .withColumn(date_column, F.try_to_timestamp(F.col(date_column), F.lit(date_format)).cast("date"))
            .withColumn(name, F.try_divide(F.col(top), F.col(bottom)))
            .dropna(subset=list(required)))
