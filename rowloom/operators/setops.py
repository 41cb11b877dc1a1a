"""Unions, bag differences and frame equality."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

COPIES_PER_TASK = 100_000


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Positional union; column names come from the first frame."""
    return reduce(DataFrame.union, frames)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """N-way union by name; columns missing in a frame become typed nulls."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Union without duplicate rows."""
    return union_all(frames).distinct()


def collapse_copies(df: DataFrame, name: str = "_copies") -> DataFrame:
    """Exact copies of a row become one row with a count, combined before the shuffle."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(name))


def expand_copies(df: DataFrame, name: str = "_copies", chunk: int = COPIES_PER_TASK) -> DataFrame:
    """Inverse of ``collapse_copies``.

    A row with very many copies is first split into chunks that are shuffled
    apart, so no task writes out all copies by itself.
    """
    columns = [c for c in df.columns if c != name]
    chunks = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                                          F.floor((F.col(name) - 1) / chunk))))
    spread = chunks.repartition(*[F.col(f"`{c}`") for c in [*columns, "_chunk"]])
    left = F.least(F.col(name) - F.col("_chunk") * chunk, F.lit(chunk).cast("long"))
    return (spread.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
            .select(*[F.col(f"`{c}`") for c in columns]))


def copy_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows with different copy counts: all columns, ``n_left``, ``n_right``.

    One shuffle of both frames together, with counts combined before it.
    """
    if left.columns != right.columns:
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")
    both = (left.select("*", F.lit(1).alias("_l"), F.lit(0).alias("_r"))
            .union(right.select("*", F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    return (both.groupBy(*[F.col(f"`{c}`") for c in left.columns])
            .agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))
            .filter(F.col("n_left") != F.col("n_right")))


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """U4: rows of ``left`` left over after each row of ``right`` removes one copy."""
    extra = (copy_differences(left, right).filter(F.col("n_left") > F.col("n_right"))
             .withColumn("_copies", F.col("n_left") - F.col("n_right")).drop("n_left", "n_right"))
    return expand_copies(extra)


def frame_diff(left: DataFrame, right: DataFrame, side: str = "side") -> DataFrame:
    """U4: bag difference both ways, marked by the frame the row is extra in."""
    gap = F.col("n_left") - F.col("n_right")
    marked = (copy_differences(left, right)
              .withColumn(side, F.when(gap > 0, "left").otherwise("right"))
              .withColumn("_copies", F.abs(gap)).drop("n_left", "n_right"))
    return expand_copies(marked)


def _hashable(df: DataFrame) -> list[Column]:
    """The columns as hashes can tell them apart, after one text that shows which of them are null.

    Spark's hashes skip nulls, so (1, null) and (null, 1) have one hash, at any depth; nested values are hashed as JSON with nulls.
    """
    columns = [F.col(f"`{f.name}`") if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
               else F.to_json(F.struct(F.col(f"`{f.name}`").alias("v")), {"ignoreNullFields": "false"}) for f in df.schema]
    nulls = F.concat(F.lit(""), *[F.when(F.col(f"`{c}`").isNull(), "0").otherwise("1") for c in df.columns])
    return [nulls, *columns]


def checksum(df: DataFrame) -> tuple:
    """Rows and the sums of two row hashes: equal for equal bags of rows, whatever their order; no rows are shuffled.

    Different bags have equal checksums with a chance of about 2^-128.
    """
    columns = _hashable(df)
    sums = [F.sum(h.cast("decimal(38,0)")) for h in (F.xxhash64(*columns), F.xxhash64(F.lit(len(columns)), *reversed(columns)))]
    return tuple(df.agg(F.count(F.lit(1)), *sums).first())


def frames_equal(left: DataFrame, right: DataFrame) -> bool:
    """Q1: same columns in the same order and the same bag of rows.

    Equal checksums of columns of equal types decide it without a shuffle.  Otherwise copies are counted,
    as values that print differently may be equal: 1 and 1.0, 0.0 and -0.0 within an array.
    """
    if left.columns != right.columns:
        return False
    if [f.dataType for f in left.schema] == [f.dataType for f in right.schema]:
        ours, theirs = checksum(left), checksum(right)
        if ours == theirs or ours[0] != theirs[0]:
            return ours == theirs
    return copy_differences(left, right).isEmpty()
