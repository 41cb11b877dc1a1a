"""Hot groups: find them, split them, and put their parts together again.

A window or join sends all rows of one key to one task.  When a key may hold a
third of the table that task never ends, so every operator that groups raw rows
goes through this module:

* ``likely_hot`` keeps a summary of frequent keys per task (Spark's frequent-items
  sketch of key hashes) and merges these in two steps.  No key is shuffled but those that a
  summary holds, so looking costs one narrow pass.
* ``find_hot`` counts the rows of these few keys exactly and keeps the keys above a
  limit in a written table.  It is joined to what needs it and never comes to the driver, and
  whether it is broadcast is decided by Spark's own check of its size.
* ``range_slices`` deals the rows out by Spark's range partitioning over the keys,
  the order column and the tie-break, and freezes the result in a written table,
  so that an ordered window runs per (key, slice) and only a small per-slice
  summary has to be combined per key.  Any type that can be sorted will do.

A sketch holds ``TRACKED`` keys.  With no more different keys than that it is exact; else a key
with more than about 1 / 5,000 of all rows is always found, and one with fewer may be missed.  A miss never changes a
result: the key's rows then meet in one task, which takes its time.

The look is one job when the operator is applied, so operators with a
``max_rows`` are not lazy.  Without hot keys, the usual case, nothing else is added
and the plan is the plain window or join.  ``max_rows=None`` leaves out the count
where groups are known to be small, as the groups of an aggregated table are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rowloom.session import release, stored

MAX_GROUP_ROWS = 1_000_000
#: Keys in a sketch of frequent ones, and tasks that merge those of all tasks.
TRACKED, MERGING_TASKS = 32_768, 64


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of all keys between two aliased frames."""
    condition = F.lit(True)
    for i, key in enumerate(keys):
        equal = F.col(f"{left}.`{key}`").eqNullSafe(F.col(f"{right}.`{key}`"))
        condition = equal if i == 0 else condition & equal
    return condition


def attach(df: DataFrame, table: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Left-join ``values`` of a frame that is unique per key; null keys match.

    Spark picks the strategy from its own size checks.
    """
    right = table.select(*keys, *values)
    if not keys:
        # A single row without a key: one scalar subquery, not a join.
        packed = table.select(F.struct(*values)).scalar()
        return (df.withColumn("_packed", packed)
                .select(*df.columns, *[F.col(f"_packed.`{v}`").alias(v) for v in values]))
    return df.alias("l").join(right.alias("r"), same_keys("l", "r", keys), "left").select(
        "l.*", *[F.col(f"r.`{v}`") for v in values])


def hot_groups(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Keys holding more than ``max_rows`` rows: key columns, ``_n``, ``_parts``.

    ``_parts`` aims at half the limit, so that uneven parts still stay below it.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows)
            .withColumn("_parts", F.ceil(2 * F.col("_n") / max_rows).cast("int")))


def key_hash(keys: Sequence[str]) -> Column:
    """A long that is the same for equal keys, null ones too."""
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def frequent_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key, n): hashes of frequent keys and upper bounds of their rows, at most ``TRACKED`` rows; lazy."""
    hashed = df.select(key_hash(keys).alias("_key"), (F.spark_partition_id() % MERGING_TASKS).alias("_task"))
    sketches = hashed.groupBy("_task").agg(F.expr(f"approx_top_k_accumulate(_key, {TRACKED})").alias("_sketch"))
    merged = sketches.groupBy((F.col("_task") * 0).alias("_all")).agg(F.expr(f"approx_top_k_combine(_sketch, {TRACKED})").alias("_sketch"))
    found = F.expr(f"approx_top_k_estimate(_sketch, {TRACKED})")
    return merged.select(F.inline(found)).toDF("key", "n")


def likely_hot(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame | None:
    """(key): hashes of keys that may hold more than ``max_rows`` rows, at most ``TRACKED`` longs, or None.

    They come to the driver and go back as a local table, so it may be broadcast at any size of the data.
    """
    found = [(r["key"],) for r in frequent_hashes(df, keys).filter(F.col("n") > max_rows).collect()]
    return df.sparkSession.createDataFrame(found, "key long") if found else None


def with_keys(df: DataFrame, keys: Sequence[str], hashes: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose key hash is (``left_semi``) or isn't (``left_anti``) among ``hashes``; narrow."""
    return df.join(F.broadcast(hashes), key_hash(keys) == F.col("key"), how)


def find_hot(df: DataFrame, keys: Sequence[str], max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame | None:
    """``hot_groups`` of the frequent keys as a written table, or None if there are none.

    Written, so the counts are not computed again by each use and all uses see
    the same hot keys.
    """
    if max_rows is None:
        return None
    likely = likely_hot(df, keys, max_rows) if keys else None
    if keys and likely is None:
        return None
    hot = stored(hot_groups(with_keys(df, keys, likely) if keys else df, keys, max_rows), "hot-keys")
    if hot.isEmpty():
        release(hot)
        return None
    return hot


def spread_by_hash(columns: Sequence[str], parts: Column | int) -> Column:
    """Part number in [0, parts) from the row's own values.

    A hash, not ``rand``: a task that is run again after a lost executor gives
    every row the same part, so no row is doubled or dropped.
    """
    parts = F.lit(parts) if isinstance(parts, int) else parts
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), parts.cast("long")).cast("int")


def position(df: DataFrame, column: str) -> Column | None:
    """The column as a double: numbers as they are, days and seconds for dates and timestamps; else None."""
    kind, col = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return (F.unix_date(col.cast("date")) * 86400.0 + F.hour(col) * 3600.0
                + F.minute(col) * 60.0 + F.date_part(F.lit("SECOND"), col).cast("double"))
    return None


def ordering(order_by: str, tie_break: str | None, descending: bool) -> list[Column]:
    """Nulls lowest, as Spark's windows here have them."""
    first = F.col(f"`{order_by}`")
    columns = [first.desc_nulls_last() if descending else first.asc_nulls_first()]
    if tie_break:
        columns.append(F.col(f"`{tie_break}`").asc_nulls_first())
    return columns


def range_slices(df: DataFrame, keys: Sequence[str], order_by: str, tie_break: str | None,
                 descending: bool = False, max_rows: int | None = MAX_GROUP_ROWS) -> tuple[DataFrame, list[str]]:
    """Cut the rows into slices of about ``max_rows`` that follow keys and order; names of the slice column.

    Only if a group is hot; else the frame itself and no names.  Slices hold
    rows that sort next to each other, whatever their keys, so small groups share
    one and a hot group fills many.  Rows equal in key, order and tie-break stay
    together.
    """
    hot = find_hot(df, keys, max_rows)
    if hot is None:
        return df, []
    release(hot)
    slices = 1 + 2 * df.count() // max_rows
    dealt = df.repartitionByRange(slices, *[F.col(f"`{k}`").asc_nulls_first() for k in keys],
                                  *ordering(order_by, tie_break, descending))
    return stored(dealt.withColumn("_slice", F.spark_partition_id()), "slices"), ["_slice"]


def earlier_slices(keys: Sequence[str], slices: Sequence[str]) -> Window:
    """Window over per-slice summaries: all slices of the key before this one."""
    return (Window.partitionBy(*keys).orderBy(*slices)
            .rowsBetween(Window.unboundedPreceding, -1))


def later_slices(keys: Sequence[str], slices: Sequence[str]) -> Window:
    return (Window.partitionBy(*keys).orderBy(*slices)
            .rowsBetween(1, Window.unboundedFollowing))
