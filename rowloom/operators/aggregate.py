"""Grouped summaries, pivots, crosstabs, association and quantiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowloom.operators.joins import join_back
from rowloom.operators.narrowing import elements_at
from rowloom.operators.skew import MAX_GROUP_ROWS, attach, frequent_hashes, position, with_keys
from rowloom.operators.windows import running_total


def group_count(df: DataFrame, keys: Sequence[str], title_case: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Rows per key; listed keys are title-cased first."""
    return (df.withColumns({k: F.initcap(k) for k in title_case})
            .groupBy(*keys).agg(F.count(F.lit(1)).alias(name)))


def group_summary(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Minimum, mean, maximum and row count in one pass."""
    return df.groupBy(*keys).agg(F.min(column).alias("lowest"), F.mean(column).alias("average"),
                                 F.max(column).alias("highest"), F.count(F.lit(1)).alias("n"))


def distinct_count(df: DataFrame, column: str, name: str = "n_distinct") -> DataFrame:
    """Distinct non-null values; a missing column counts 0 instead of failing."""
    if column not in df.columns:
        return df.limit(0).agg(F.count(F.lit(1)).alias(name))
    return df.agg(F.countDistinct(F.col(f"`{column}`")).alias(name))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column in one pass over all columns."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def filtered_sum(df: DataFrame, condition: Column, column: str, name: str) -> DataFrame:
    """Sum over the rows that pass; null if none does."""
    return df.filter(condition).agg(F.sum(column).alias(name))


def pivot_count(df: DataFrame, keys: Sequence[str], column: str, values: Sequence | None = None) -> DataFrame:
    """A count column per value; missing combinations are null."""
    return df.groupBy(*keys).pivot(column, list(values) if values else None).count()


def _only_listed(column: str, values: Sequence) -> Column:
    """The column; at run time an error for any value that is not listed."""
    col = F.col(f"`{column}`")
    listed = F.coalesce(col.isin([v for v in values if v is not None]), F.lit(None in values))
    return F.when(listed, col).otherwise(F.raise_error(F.concat(
        F.lit(f"{column} has a value that is not listed: "), F.coalesce(col.cast("string"), F.lit("null")))))


def pivot_agg(df: DataFrame, keys: Sequence[str], column: str, values: Sequence,
              aggregates: Sequence[Column], fill=None, others: bool = False) -> DataFrame:
    """Fixed pivot values (no extra job to find them), any aggregates, optional fill.

    A value that is not listed is an error, so that no row vanishes; with
    ``others`` such rows are left out on purpose.
    """
    if not others:
        df = df.withColumn(column, _only_listed(column, values))
    wide = df.groupBy(*keys).pivot(column, list(values)).agg(*aggregates)
    return wide if fill is None else wide.fillna(fill)


def contingency(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Long contingency table ``(row_value, col_value, n)``; null is a level of its own and stays null."""
    return (df.select(F.col(rows).cast("string").alias("row_value"), F.col(columns).cast("string").alias("col_value"))
            .groupBy("row_value", "col_value").agg(F.count(F.lit(1)).alias("n")))


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence[str] | None = None) -> DataFrame:
    """Wide counts, first column ``rows_columns``, empty cells 0.

    Built from the long form, so the wide step handles cells and not raw rows.
    The row of nulls has a null name; listed values must be all there are.
    """
    cells = contingency(df, rows, columns)
    if values:
        cells = cells.withColumn("col_value", _only_listed("col_value", values))
    return (cells.groupBy(F.col("row_value").alias(f"{rows}_{columns}"))
            .pivot("col_value", list(values) if values else None).agg(F.sum("n")).fillna(0))


def label_collisions(df: DataFrame, column: str) -> DataFrame:
    """Labels that differ only by case and would collide as column names."""
    labels = df.select(F.col(column).alias("label")).filter(F.col(column).isNotNull()).distinct()
    grouped = labels.groupBy(F.lower("label").alias("folded")).agg(
        F.count(F.lit(1)).alias("n_labels"), F.min("label").alias("first_label"),
        F.max("label").alias("last_label"))
    return grouped.filter(F.col("n_labels") > 1)


def cramers_v(df: DataFrame, rows: str, columns: str, name: str = "cramers_v") -> DataFrame:
    """Association of two categorical columns, without continuity correction.

    chi2 = n * (sum(o^2 / (r * c)) - 1) needs only the cells that occur, so the
    full matrix is never built.  Margins and level counts come from the cells.  One level on either side gives null.
    """
    cells = contingency(df, rows, columns)
    by_row = cells.groupBy("row_value").agg(F.sum("n").cast("double").alias("r"))
    by_col = cells.groupBy("col_value").agg(F.sum("n").cast("double").alias("c"))
    levels = F.least(by_row.agg(F.count(F.lit(1))).scalar(), by_col.agg(F.count(F.lit(1))).scalar())
    known = attach(attach(cells, by_row, ["row_value"], ["r"]), by_col, ["col_value"], ["c"])
    sums = (known.agg(F.sum(F.col("n") * F.col("n") / (F.col("r") * F.col("c"))).alias("ratio"))
            .withColumn("levels", levels))
    # The identity can fall below zero by rounding when nothing is associated.
    per_level = F.try_divide(F.greatest(F.col("ratio") - 1, F.lit(0.0)), F.col("levels") - 1)
    return sums.select(F.sqrt(per_level).alias(name))


def exact_quantiles(df: DataFrame, keys: Sequence[str], column: str, probabilities: Mapping[str, float],
                    max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Quantiles that are elements of the data, one named column each: the element at ceil(p * n).

    Groups of up to ``max_rows`` rows are sorted; larger ones are narrowed down by sketches and proving counts
    (``rowloom.operators.narrowing``), and their rows are not moved.  For text and
    other columns without a position on a line values are counted, and a running count finds the element.
    """
    def place(p: float):
        return lambda n: F.greatest(F.ceil(F.lit(p) * n), F.lit(1))

    if position(df, column) is None and max_rows is not None:
        known = df.filter(F.col(column).isNotNull())
        return _placed_values(known, keys, column, max_rows).groupBy(*keys).agg(*[
            F.min(F.when(F.col("_upto") >= place(p)(F.col("_n")), F.col(column))).alias(name)
            for name, p in probabilities.items()])
    return elements_at(df, keys, column, {name: place(p) for name, p in probabilities.items()}, max_rows)


def exact_median(df: DataFrame, keys: Sequence[str], column: str, name: str = "median",
                 max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Median per key, the mean of the middle two for an even count; found as G17."""
    middle = {"_lower": lambda n: F.floor((n + 1) / 2), "_upper": lambda n: F.floor((n + 2) / 2)}
    return (elements_at(df, keys, column, middle, max_rows)
            .select(*keys, ((F.col("_lower") + F.col("_upper")) / 2.0).alias(name)))


def _placed_values(df: DataFrame, keys: Sequence[str], column: str, max_rows: int | None) -> DataFrame:
    """Distinct values per key with ``_upto``, the rows up to the value, and ``_n``, all rows."""
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_rows"))
    totals = counts.groupBy(*keys).agg(F.sum("_rows").alias("_n"))
    return running_total(join_back(counts, totals, keys, ["_n"], max_rows), keys, column, None,
                         "_rows", "_upto", max_rows)


def approx_quantiles(df: DataFrame, keys: Sequence[str], column: str, probabilities: Mapping[str, float],
                     accuracy: int = 10_000) -> DataFrame:
    """Quantile sketches; relative rank error 1/accuracy, fixed memory per key."""
    return df.groupBy(*keys).agg(*[F.percentile_approx(column, p, accuracy).alias(name)
                                   for name, p in probabilities.items()])


def quantile_error(df: DataFrame, column: str, p: float, accuracy: int,
                   max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """(exact - estimate) / exact for one quantile."""
    exact = exact_quantiles(df, [], column, {"exact": p}, max_rows)
    estimate = approx_quantiles(df, [], column, {"estimate": p}, accuracy)
    return exact.withColumn("estimate", estimate.scalar()).withColumn(
        "error", F.try_divide(F.col("exact") - F.col("estimate"), F.col("exact")))


def length_histogram(df: DataFrame, column: str) -> DataFrame:
    """Rows per string length."""
    return df.groupBy(F.length(column).alias("length")).agg(F.count(F.lit(1)).alias("n"))


def key_skew(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, share of the table, and ratio to the mean rows per key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("keys"))
    return (attach(counts, whole, [], ["total", "keys"])
            .withColumn("pct", F.col("n") * 100.0 / F.col("total"))
            .withColumn("to_mean", F.col("n") * F.col("keys") / F.col("total"))
            .drop("total", "keys"))


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """The keys that hold more than ``share`` of all rows, with their rows and percentage.

    A sketch names the candidates, which one more narrow pass counts exactly; other keys are not shuffled.
    """
    if share < 1 / 5_000:
        raise ValueError("a sketch finds only keys that hold more than a 5,000th of the rows")
    rows = df.count()
    likely = frequent_hashes(df, keys).filter(F.col("n") > share * rows).select("key")  # fewer than 5,000 longs
    counts = with_keys(df, keys, likely).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > share * rows).withColumn("pct", F.col("n") * 100.0 / rows)
