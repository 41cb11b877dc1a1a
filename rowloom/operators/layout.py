"""Partition layout, reuse and lineage, from the user's side."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.session import ensure_checkpoint_dir, release, stored

#: Bits of a generated id that count rows within a task, and tasks whose row counts one task adds up.
PLACE_BITS, TASKS_PER_BLOCK = 33, 4_096


def partition_profile(df: DataFrame) -> DataFrame:
    """L1: rows per partition, counted where they lie."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))


def shrink_partitions(df: DataFrame, fraction: float) -> DataFrame:
    """After keeping a fraction of the rows, merge partitions in proportion.

    For frames read from files; asking a shuffled frame for its partitions runs it.
    """
    before = df.rdd.getNumPartitions()
    return df.coalesce(max(1, round(before * fraction)))


def free_name(taken: Collection[str], wish: str) -> str:
    """``wish``, with underscores added until no column has that name in any case."""
    used = {c.lower() for c in taken}
    while wish.lower() in used:
        wish += "_"
    return wish


def numbered_rows(df: DataFrame, name: str = "row_id", first: int = 0) -> DataFrame:
    """Ids ``first``, ``first`` + 1, ... without gaps, in the order in which the rows lie; nothing is sorted.

    Generated ids jump between tasks and change whenever a task runs again on other input.  Here the rows are
    written once, each with its task and its place there; the rows of each task are counted, the counts
    are added up in two levels (no step sees more than a few thousand of them), and a second narrow pass adds the offset to
    the place.  What was written doesn't change, so the ids survive lost executors and other readers' splits.

    An ordered frame (``orderBy``) gets ids in its order; ties are in the order in which they were written.  An
    empty frame stays empty.  An existing column called ``name`` is an error.  The rows stay in the current scratch.
    """
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the frame has a column {name} already")
    generated = free_name([*df.columns, name], "_generated")
    task, start, block = (free_name([*df.columns, name, generated], w) for w in ("_task", "_start", "_block"))
    rows = stored(df.withColumn(generated, F.monotonically_increasing_id()), "numbered-rows")
    task_of = F.shiftright(F.col(f"`{generated}`"), PLACE_BITS)
    counts = stored(rows.groupBy(task_of.alias(task)).agg(F.count(F.lit(1)).alias("_n"))
                    .withColumn(block, F.floor(F.col(task) / TASKS_PER_BLOCK)), "task-rows")
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy(block).agg(F.sum("_n").alias("_all")).select(block, F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_earlier"))
    within = Window.partitionBy(block).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.withColumn("_here", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(blocks, block)
                    .select(task, (F.col("_here") + F.col("_earlier") + first).alias(start)), "task-starts")
    release(counts)
    place = F.col(f"`{generated}`").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    # A few bytes per task; whether it is broadcast is left to Spark's check of the stored size.
    return (rows.join(starts, task_of == F.col(task))
            .select(*[F.col(f"`{c}`") for c in df.columns], (F.col(start) + place).alias(name)))


def spread_partitions(df: DataFrame, n: int | None, *keys: str) -> DataFrame:
    """L3: full shuffle into ``n`` partitions, by key if keys are given; None leaves their number to Spark."""
    return df.repartition(*([] if n is None else [n]), *keys)


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a cleaned, already filtered frame while several reports read it."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def iterate_columns(df: DataFrame, first: str, last: int, step: Callable[[Column, int], Column],
                    prefix: str = "col_", checkpoint_every: int | None = None) -> DataFrame:
    """``col_i = step(col_(i-1), i)`` for i = 1..last.

    ``checkpoint_every`` cuts the lineage in the reliable checkpoint folder,
    for chains so long that planning becomes the cost; without it the chain is
    one narrow stage.
    """
    df = df.withColumnRenamed(first, f"{prefix}0") if first != f"{prefix}0" else df
    for i in range(1, last + 1):
        df = df.withColumn(f"{prefix}{i}", step(F.col(f"{prefix}{i - 1}"), i))
        if checkpoint_every and i % checkpoint_every == 0:
            ensure_checkpoint_dir(df.sparkSession)
            df = df.checkpoint()
    return df
