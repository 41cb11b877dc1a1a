"""Window operators that survive a hot partition.

Hot groups are found by a count (see ``rowloom.operators.skew``); without any,
each operator is the plain window.  With hot groups, windows without an order
become aggregate and join back, and ordered windows run per (key, slice) and take
what they need from other slices from a per-slice summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.operators.joins import group_values, join_back
from rowloom.operators.narrowing import elements_at
from rowloom.operators.skew import (MAX_GROUP_ROWS, attach, earlier_slices, later_slices, likely_hot, ordering, position,
                                    range_slices, spread_by_hash, with_keys)
from rowloom.session import stored

#: Up to this many rows a group Spark limits groups before the shuffle; parts of a key beyond.
GROUP_LIMIT, SALTS = 1_000, 256


def partition_totals(df: DataFrame, keys: Sequence[str], column: str, *, total: str | None = None,
                     mean: str | None = None, highest: str | None = None, rows: str | None = None,
                     max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Sum, mean, maximum or row count of the partition on every row."""
    wanted = [(total, F.sum(column)), (mean, F.mean(column)), (highest, F.max(column)),
              (rows, F.count(F.lit(1)))]
    return group_values(df, keys, {name: agg for name, agg in wanted if name}, max_rows)


def partition_share(df: DataFrame, keys: Sequence[str], column: str, name: str,
                    digits: int | None = 2, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """The row's percentage of its partition's total."""
    share = F.try_divide(F.col(column) * 100.0, F.col("_total"))
    if digits is not None:
        share = F.round(share, digits)
    return (partition_totals(df, keys, column, total="_total", max_rows=max_rows)
            .withColumn(name, share).drop("_total"))


def ranked(df: DataFrame, keys: Sequence[str], order_by: str, tie_break: str,
           descending: bool = True, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """``row_number``, ``rank`` and ``dense_rank`` of every row.

    ``keys=[]`` numbers the whole table without a single-task window, once it
    has more rows than ``max_rows``.  The tie-break must be unique within a key for ``row_number`` to be repeatable.
    """
    sliced, slices = range_slices(df, keys, order_by, tie_break, descending, max_rows)
    window = Window.partitionBy(*keys, *slices).orderBy(*ordering(order_by, tie_break, descending))
    by_value = Window.partitionBy(*keys, *slices).orderBy(*ordering(order_by, None, descending))
    numbered = sliced.select("*", F.row_number().over(window).alias("_rn"),
                             F.rank().over(by_value).alias("_rk"),
                             F.dense_rank().over(by_value).alias("_dr"))
    if not slices:
        return numbered.select(*df.columns, *[F.col(own).cast("long").alias(name) for own, name in
                                              (("_rn", "row_number"), ("_rk", "rank"), ("_dr", "dense_rank"))])
    # Per slice its rows and values, and the rank and value at either end.
    at = F.struct(F.col(f"`{order_by}`").alias("v"))
    summary = numbered.groupBy(*keys, *slices).agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_dr").alias("_values"), F.max("_rk").alias("_last_rank"),
        F.min_by(at, "_rn").alias("_first"), F.max_by(at, "_rn").alias("_last"))
    before, order = earlier_slices(keys, slices), Window.partitionBy(*keys).orderBy(*slices)
    # A value that goes on from the slice before counts once, and its rank is where it began.
    goes_on = F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(order)), F.lit(False))
    summary = (summary.withColumn("_goes_on", goes_on)
               .withColumn("_row_off", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
               .withColumn("_dense_off", F.coalesce(F.sum("_values").over(before), F.lit(0))
                           - F.sum(F.col("_goes_on").cast("long")).over(order))
               .withColumn("_begins", F.when(~F.col("_goes_on") | (F.col("_values") > 1), F.col("_row_off") + F.col("_last_rank")))
               .withColumn("_began", F.last("_begins", ignorenulls=True).over(before)))
    offsets = attach(numbered, summary, [*keys, *slices], ["_row_off", "_dense_off", "_goes_on", "_began"])
    rank = F.when(F.col("_goes_on") & (F.col("_dr") == 1), F.col("_began")).otherwise(F.col("_rk") + F.col("_row_off"))

    def plus(own: str, offset: str) -> Column:
        return F.col(own).cast("long") + F.coalesce(F.col(offset), F.lit(0))

    return offsets.select(*df.columns, plus("_rn", "_row_off").alias("row_number"),
                          rank.cast("long").alias("rank"),
                          plus("_dr", "_dense_off").alias("dense_rank"))


def global_row_number(df: DataFrame, order_by: str, tie_break: str, name: str = "row_number",
                      descending: bool = False, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """1..n over the whole table: numbers per slice plus the slice's offset."""
    return (ranked(df, [], order_by, tie_break, descending, max_rows)
            .drop("rank", "dense_rank").withColumnRenamed("row_number", name))


def top_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], k: int,
                  name: str = "row_number", max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """First ``k`` rows per key; ``order_by`` ends in a unique column.

    Catalyst turns the filter into a group limit that also runs before the
    shuffle, so a hot key sends at most ``k`` rows per task.  It does so for small
    ``k`` only.  Beyond that a frame without hot keys is shuffled once; rows of hot keys are first limited within salted parts of
    the key.  ``top_by_value`` needs no such parts.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    hot = likely_hot(df, keys, max_rows) if k > GROUP_LIMIT and max_rows is not None else None
    if hot is not None:
        cold, large = with_keys(df, keys, hot, "left_anti"), with_keys(df, keys, hot)
        parts = Window.partitionBy(*keys, "_part").orderBy(*order_by)
        limited = (large.withColumn("_part", spread_by_hash(df.columns, SALTS))
                   .withColumn("_place", F.row_number().over(parts)).filter(F.col("_place") <= k).drop("_place", "_part"))
        df = cold.unionByName(limited)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)


def top_by_value(df: DataFrame, keys: Sequence[str], order_by: str, tie_break: str, k: int, name: str = "row_number",
                 descending: bool = True, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """First ``k`` rows per key by one column, for any ``k``; the tie-break must be unique within a key.

    Keys up to ``max_rows`` rows are ranked in one shuffle.  In larger keys the k-th value is found by
    narrowing counts (see ``rowloom.operators.narrowing``) and rows beyond it are filtered out where they lie, so only the
    best rows and those tied with the last of them are moved, in slices if they are many.  Nulls come lowest, as in
    ``ranked``.  ``order_by`` must be a number, date or timestamp if keys may be large; else all their rows are sliced.
    """
    if k < 1:
        raise ValueError("k must be at least 1")

    def first(rows: DataFrame) -> DataFrame:
        numbered = ranked(rows, keys, order_by, tie_break, descending, max_rows).drop("rank", "dense_rank")
        return numbered.filter(F.col("row_number") <= k).withColumnRenamed("row_number", name)

    hot = likely_hot(df, keys, max_rows) if keys and max_rows is not None else None
    if position(df, order_by) is None or (keys and hot is None) or max_rows is None:
        return first(df)
    large = with_keys(df, keys, hot) if keys else df
    value = F.col(f"`{order_by}`")
    # Nulls are lowest: with the highest wanted they count only where values run out, with the lowest they come before all.
    place = (lambda n: F.greatest(n - k + 1, F.lit(1))) if descending else (lambda n: F.least(n, F.lit(k)))
    values = large.groupBy(*keys).agg(F.count(value).alias("_values"))
    cuts = attach(values, elements_at(large, keys, order_by, {"_cut": place}, max_rows), keys, ["_cut"])
    met = attach(large, stored(cuts, "cuts"), keys, ["_values", "_cut"])
    wanted = (value >= F.col("_cut")) | (value.isNull() & (F.col("_values") < k)) if descending else value.isNull() | (value <= F.col("_cut"))
    best = first(met.filter(wanted).select(*[F.col(f"`{c}`") for c in df.columns]))
    return first(with_keys(df, keys, hot, "left_anti")).unionByName(best) if keys else best


def top_ranked(df: DataFrame, keys: Sequence[str], order_by: str, k: int, name: str = "rank") -> DataFrame:
    """Rows with rank <= k by descending value, all ties kept.

    Ranks come from the distinct values with their row counts: at most ``k``
    values per key can qualify, and the group limit removes the others before
    the shuffle.  The qualifying values are joined back, so even a tie that
    holds a third of the table is never gathered in one task.
    """
    values = df.groupBy(*keys, order_by).agg(F.count(F.lit(1)).alias("_ties"))
    by_value = Window.partitionBy(*keys).orderBy(F.col(order_by).desc_nulls_last())
    best = values.withColumn("_place", F.dense_rank().over(by_value)).filter(F.col("_place") <= k)
    above = by_value.rowsBetween(Window.unboundedPreceding, -1)
    best = (best.withColumn(name, (F.coalesce(F.sum("_ties").over(above), F.lit(0)) + 1).cast("int"))
            .filter(F.col(name) <= k))
    return join_back(df, best, [*keys, order_by], [name]).filter(F.col(name).isNotNull())


def running_total(df: DataFrame, keys: Sequence[str], order_by: str, tie_break: str | None,
                  column: str, name: str, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Sum of ``column`` over the rows up to and including this one."""
    sliced, slices = range_slices(df, keys, order_by, tie_break, False, max_rows)
    window = (Window.partitionBy(*keys, *slices).orderBy(*ordering(order_by, tie_break, False))
              .rowsBetween(Window.unboundedPreceding, 0))
    own = sliced.withColumn("_own", F.sum(column).over(window))
    if not slices:
        return own.select(*df.columns, F.col("_own").alias(name))
    summary = sliced.groupBy(*keys, *slices).agg(F.sum(column).alias("_sum"))
    summary = summary.withColumn("_before", F.sum("_sum").over(earlier_slices(keys, slices)))
    return (attach(own, summary, [*keys, *slices], ["_before"])
            .withColumn(name, F.col("_own") + F.coalesce(F.col("_before"), F.lit(0)))
            .select(*df.columns, name))


def lag_lead(df: DataFrame, keys: Sequence[str], order_by: str, tie_break: str, column: str,
             lag_name: str | None = None, lead_name: str | None = None, default=None,
             max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """The value one row before (lag) and after (lead); ``default`` at the ends.

    The first row of a slice takes the last value of the slice before it.
    """
    sliced, slices = range_slices(df, keys, order_by, tie_break, False, max_rows)
    window = Window.partitionBy(*keys, *slices).orderBy(*ordering(order_by, tie_break, False))
    boxed = F.struct(F.col(column).alias("v"))  # a null value is not a missing row
    own = sliced.select("*", F.lag(boxed).over(window).alias("_prev"),
                        F.lead(boxed).over(window).alias("_next"))
    if slices:
        at = F.struct(F.col(f"`{order_by}`"), F.col(f"`{tie_break}`"))
        summary = sliced.groupBy(*keys, *slices).agg(F.min_by(boxed, at).alias("_first"), F.max_by(boxed, at).alias("_last"))
        neighbour = Window.partitionBy(*keys).orderBy(*slices)
        summary = (summary.withColumn("_before", F.lag("_last").over(neighbour))
                   .withColumn("_after", F.lead("_first").over(neighbour)))
        own = attach(own, summary, [*keys, *slices], ["_before", "_after"])

    def value(own_name: str, carried: str) -> Column:
        found = F.coalesce(F.col(own_name), F.col(carried)) if slices else F.col(own_name)
        return F.when(found.isNull(), F.lit(default)).otherwise(found["v"])

    columns = [F.col(f"`{c}`") for c in df.columns]
    if lag_name:
        columns.append(value("_prev", "_before").alias(lag_name))
    if lead_name:
        columns.append(value("_next", "_after").alias(lead_name))
    return own.select(*columns)


def fill_gaps(df: DataFrame, keys: Sequence[str], order_by: str, tie_break: str | None,
              column: str, forward: str | None = None, backward: str | None = None,
              max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Carry the last known value forward and the next known value backward."""
    sliced, slices = range_slices(df, keys, order_by, tie_break, False, max_rows)
    base = Window.partitionBy(*keys, *slices).orderBy(*ordering(order_by, tie_break, False))
    to_here = base.rowsBetween(Window.unboundedPreceding, 0)
    from_here = base.rowsBetween(0, Window.unboundedFollowing)
    own = sliced.select("*", F.last(column, ignorenulls=True).over(to_here).alias("_ff"),
                        F.first(column, ignorenulls=True).over(from_here).alias("_bf"))
    ahead, behind = F.col("_ff"), F.col("_bf")
    if slices:
        tie = F.col(f"`{tie_break}`") if tie_break else F.lit(0)
        known = F.when(F.col(column).isNotNull(), F.struct(F.col(f"`{order_by}`"), tie))
        summary = sliced.groupBy(*keys, *slices).agg(
            F.max_by(F.col(column), known).alias("_last"), F.min_by(F.col(column), known).alias("_first"))
        earlier, later = earlier_slices(keys, slices), later_slices(keys, slices)
        summary = (summary.withColumn("_before", F.last("_last", ignorenulls=True).over(earlier))
                   .withColumn("_after", F.first("_first", ignorenulls=True).over(later)))
        own = attach(own, summary, [*keys, *slices], ["_before", "_after"])
        ahead, behind = F.coalesce("_ff", "_before"), F.coalesce("_bf", "_after")
    columns = [F.col(f"`{c}`") for c in df.columns]
    if forward:
        columns.append(ahead.alias(forward))
    if backward:
        columns.append(behind.alias(backward))
    return own.select(*columns)


def interpolate(df: DataFrame, keys: Sequence[str], order_by: str, value: str, name: str = "filled",
                flag: str = "imputed", max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Straight line in time between the known neighbours of each null.

    One row per (keys, period) is expected; aggregate duplicates first.  Gaps
    before the first or after the last known value stay null.
    """
    place = position(df, order_by)
    if place is None:
        raise TypeError(f"{order_by} is not a number, date or timestamp")
    marked = (df.withColumn("_at", place)
              .withColumn("_known", F.when(F.col(value).isNotNull(),
                                           F.struct(F.col(value).cast("double").alias("y"),
                                                    F.col("_at").alias("x")))))
    filled = fill_gaps(marked, keys, order_by, None, "_known", "_left", "_right", max_rows)
    slope = F.try_divide(F.col("_right.y") - F.col("_left.y"), F.col("_right.x") - F.col("_left.x"))
    line = F.col("_left.y") + slope * (F.col("_at") - F.col("_left.x"))
    return filled.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.when(F.col(value).isNull(), 1).otherwise(0).alias(flag),
        F.when(F.col(value).isNull(), line).otherwise(F.col(value).cast("double")).alias(name))


def top_two_gap(df: DataFrame, keys: Sequence[str], column: str, tie_break: str, threshold: float,
                gap: str = "top_two_gap", flag: str = "gap_flag") -> DataFrame:
    """Per row the gap to the next lower value if it is the group's top row, else 0.

    Only the two best rows per group decide, so they are found with a group
    limit and the winner is marked by its key.
    """
    best = top_per_group(df.select(*keys, column, tie_break), keys,
                         [F.col(column).desc_nulls_last(), F.col(tie_break)], 2, "_place")
    pair = best.groupBy(*keys).agg(
        F.max(F.when(F.col("_place") == 1, F.col(column))).alias("_top"),
        F.max(F.when(F.col("_place") == 2, F.col(column))).alias("_second"),
        F.max(F.when(F.col("_place") == 1, F.col(tie_break))).alias("_winner"))
    marked = join_back(df, pair, keys, ["_top", "_second", "_winner"])
    distance = F.when(F.col(tie_break).eqNullSafe(F.col("_winner")),
                      F.col("_top") - F.col("_second")).otherwise(0.0)
    return (marked.withColumn(gap, distance)
            .withColumn(flag, F.when(F.col(gap) > threshold, 1).otherwise(0))
            .drop("_top", "_second", "_winner"))
