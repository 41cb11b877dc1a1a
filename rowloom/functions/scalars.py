"""Scalar column functions that need more than one built-in."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T


def parse_date(column: str, pattern: str) -> Column:
    """date from text by its full pattern; text that does not match gives null."""
    return F.try_to_timestamp(F.col(column), F.lit(pattern)).cast("date")


def parse_timestamp(column: str, pattern: str) -> Column:
    """timestamp without zone from text by its full pattern; text that does not match gives null."""
    return F.try_to_timestamp(F.col(column), F.lit(pattern)).cast("timestamp_ntz")


def text_epoch_seconds(column: str, pattern: str) -> Column:
    """seconds since 1970-01-01 of text by its pattern, counted as it reads; null where it does not match."""
    at = parse_timestamp(column, pattern)
    return F.unix_date(at.cast("date")).cast("long") * 86400 + F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """seconds since 1970-01-01.

    A timestamp without zone is counted as it reads, whatever the session zone.
    """
    col = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return (F.unix_date(col.cast("date")).cast("long") * 86400 + F.hour(col) * 3600
                + F.minute(col) * 60 + F.second(col))
    return F.unix_timestamp(col)


def array_size(column: str | Column, null_size: int = -1) -> Column:
    """elements in the array; a null array gives ``null_size``."""
    return F.coalesce(F.size(column), F.lit(null_size))


def map_lookup(column: str | Column, mapping: Mapping) -> Column:
    """value from a literal map; null if the key is missing."""
    literal = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.try_element_at(literal, F.col(column) if isinstance(column, str) else column)


def euclidean(x: Column, y: Column, to_x: Column, to_y: Column, scale: float = 1000.0) -> Column:
    """straight-line distance, by default metres to kilometres."""
    return F.sqrt(F.pow(x - to_x, F.lit(2.0)) + F.pow(y - to_y, F.lit(2.0))) / scale


def add_square(df: DataFrame, column: str, name: str) -> DataFrame:
    """squared value; null stays null."""
    return df.withColumn(name, F.pow(F.col(column), F.lit(2)))


def calendar_counts(df: DataFrame, date_column: str, days: Mapping[str, str], shift_days: int = 0) -> DataFrame:
    """rows per date on named days of the year, given as ``MMM-dd`` to label.

    ``shift_days`` moves dates back first, for calendars that run behind.
    """
    day = F.date_sub(F.col(date_column).cast("date"), shift_days)
    dated = df.select(F.col(date_column).cast("date").alias("on_date"),
                      map_lookup(F.date_format(day, "MMM-dd"), days).alias("label"))
    return (dated.filter(F.col("label").isNotNull())
            .groupBy("on_date", "label").agg(F.count(F.lit(1)).alias("n")))


def first_of_month(column: str) -> Column:
    """F32: true on the first day of a month."""
    return F.dayofmonth(F.col(column)) == 1
