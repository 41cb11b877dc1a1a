"""Generated columns and frames for skew and edge-case work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Keys with their row counts, the rest of the rows is E; and the
# lookup that goes with them.
SKEW_COUNTS = (("A", 100), ("B", 900), ("C", 9_000), ("D", 90_000))
SKEW_LOOKUP = {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5}


def id_range(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Ids 0..n-1 over a given number of partitions."""
    return spark.range(0, n, 1, partitions)


def random_ints(upper: int, seed: int) -> Column:
    """Integers 1..upper; repeatable only for the same partitioning."""
    return F.ceil(F.rand(seed) * upper)


def hashed_ints(column: str, upper: int, seed: int) -> Column:
    """Integers 1..upper from a hash, the same under any partitioning."""
    return hashed(column, seed) % upper + 1


def hashed(column: str, seed: int) -> Column:
    """52 bits of the md5 of seed and value, as any engine gives them."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}-"), F.col(column).cast("string"))), 1, 13), 16, 10).cast("long")


def skewed_key(column: str, scale: float = 1.0) -> Column:
    """Key by position: the first ids are A, then B, C and D, all others E."""
    upto, case = 0, None
    for key, rows in SKEW_COUNTS:
        upto += rows * scale
        case = (F if case is None else case).when(F.col(column) < upto, key)
    return case.otherwise("E")


def skew_lookup(spark: SparkSession) -> DataFrame:
    """One row per skewed key."""
    return spark.createDataFrame(list(SKEW_LOOKUP.items()), "skew_key string, key_value int")


def edge_cases(df: DataFrame, key: str, every: int = 10, seed: int = 7) -> DataFrame:
    """Rows with nulls, zeros and extreme values, spread by a hash of the key.

    Numeric columns other than the key become null, 0, negative or very large
    in about one row in ``every`` each; strings become empty, padded or null.
    """
    pick = hashed(key, seed) % every
    changed = {}
    for name, kind in df.dtypes:
        col = F.col(name)
        if name == key:
            continue
        if kind in ("double", "float"):
            changed[name] = (F.when(pick == 0, None).when(pick == 1, 0.0).when(pick == 2, -col)
                             .when(pick == 3, col * 1e6).otherwise(col))
        elif kind == "string":
            changed[name] = (F.when(pick == 0, None).when(pick == 1, "")
                             .when(pick == 2, F.concat(F.lit(" "), col, F.lit(" ")))
                             .when(pick == 3, F.upper(col)).otherwise(col))
    return df.withColumns(changed)
