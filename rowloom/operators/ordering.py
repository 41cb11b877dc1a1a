"""Sorts and limits with explicit null placement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def order_columns(spec: Sequence[str]) -> list[Column]:
    """``"a"`` ascending, ``"-a"`` descending; nulls last in both directions.  (O3)"""
    return [F.col(s[1:]).desc_nulls_last() if s.startswith("-") else F.col(s).asc_nulls_last() for s in spec]


def top_n(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows; each task keeps its best ``n``, there is no full sort.

    The last order column must be unique so that ties cannot change the result.
    """
    return df.orderBy(*order_columns(order_by)).limit(n)


def bottom_n(df: DataFrame, column: str, tie_break: str, n: int, nulls_first: bool = False) -> DataFrame:
    """O2: lowest ``n`` rows; nulls come first only on request."""
    key = F.col(column).asc_nulls_first() if nulls_first else F.col(column).asc_nulls_last()
    return df.orderBy(key, F.col(tie_break)).limit(n)
