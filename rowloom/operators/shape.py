"""Projections, filters and conditionals."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def select_renamed(df: DataFrame, names: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """Drop columns, then rename the listed ones, in one projection."""
    return df.drop(*drop).withColumnsRenamed(dict(names))


def format_columns(df: DataFrame, names: Mapping[str, str], title_case: Sequence[str] = ()) -> DataFrame:
    """Exactly the mapped columns, renamed and in that order; some in title case."""
    return df.select(*[
        (F.initcap(F.col(f"`{old}`")) if old in title_case else F.col(f"`{old}`")).alias(new)
        for old, new in names.items()])


def clean_names(df: DataFrame, words: Mapping[str, str] | None = None) -> DataFrame:
    """P5: column names without symbols; ``words`` gives the text for known ones.

    Raises if two names become equal, as one column would be lost on write.
    """
    renames = {}
    for old in df.columns:
        new = old
        for symbol, text in (words or {}).items():
            new = new.replace(symbol, text)
        renames[old] = re.sub(r"\W+", "_", new, flags=re.ASCII).strip("_")
    if len(set(renames.values())) < len(renames):
        raise ValueError(f"cleaned column names collide: {sorted(renames.values())}")
    return df.withColumnsRenamed(renames)


def ratio(df: DataFrame, top: str, bottom: str, name: str) -> DataFrame:
    """Quotient; a zero divisor gives null instead of an error."""
    return df.withColumn(name, F.try_divide(F.col(top), F.col(bottom)))


def replace_values(df: DataFrame, mapping: Mapping, columns: Sequence[str] | None = None) -> DataFrame:
    """Swap values, by default in every column of the mapping's type."""
    return df.replace(dict(mapping), subset=list(columns) if columns else None)


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without nulls in any, or in the listed, columns."""
    return df.dropna(subset=list(columns) if columns else None)


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order, the same in every run.

    The filter on the row number runs before the shuffle too (group limit), so
    a key with very many copies sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") == 1).drop("_n")


def bin_values(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str],
               name: str) -> DataFrame:
    """Contiguous bins; ``edges`` are inclusive upper bounds, last label is open.

    Null stays null rather than falling into the open bin.
    """
    if len(labels) != len(edges) + 1 or list(edges) != sorted(edges):
        raise ValueError("need ascending edges and one more label than edges")
    value = F.col(column)
    case = F.when(value.isNull(), F.lit(None))
    for edge, label in zip(edges, labels):
        case = case.when(value <= edge, F.lit(label))
    return df.withColumn(name, case.otherwise(F.lit(labels[-1])))


def indicator_columns(df: DataFrame, column: str, names: Mapping[str, str]) -> DataFrame:
    """P20: one boolean column per listed category, all in one projection."""
    return df.select("*", *[(F.col(column) == F.lit(value)).alias(name) for value, name in names.items()])


def count_by_label(df: DataFrame, column: str, label: str, name: str = "n") -> DataFrame:
    """Rows whose title-cased value equals ``label``, which is taken as it is."""
    return df.filter(F.initcap(F.col(column)) == label).agg(F.count(F.lit(1)).alias(name))


def share_of_total(df: DataFrame, keys: Sequence[str], name: str = "pct") -> DataFrame:
    """P25: count per key and its percentage of all rows, in one pass over the data.

    The total is a scalar subquery over the small counts, not a second count.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn(name, F.col("n") * 100.0 / total)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts that give null, not an error, for values that do not fit."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def wrap_to_int(column: str | Column) -> Column:
    """32-bit wrap-around of a long, as casts behaved before ANSI mode."""
    col = F.col(column) if isinstance(column, str) else column
    return (F.pmod(col + F.lit(2**31), F.lit(2**32)) - F.lit(2**31)).cast("int")
