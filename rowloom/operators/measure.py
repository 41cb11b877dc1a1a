"""Sizes measured from the rows: of a frame, and of the keys of one side of a join.

Sizes are those of Spark's row format, added up from the columns by built-in
functions, so any type can be measured and only numbers leave the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowloom.operators.skew import key_hash
from rowloom.session import release, stored

#: Bytes of a column's place in a row; a row begins with two such places.
SLOT = 8
#: Hash buckets per allowed size when heavy keys are searched.
BUCKETS_PER_LIMIT = 8


def _beyond_slot(value: Column, kind: T.DataType) -> Column:
    """Bytes that a value takes outside its slot; a null takes none."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value).cast("long")
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            size = F.aggregate(value, F.lit(0).cast("long"), lambda sum_, v: sum_ + SLOT + _beyond_slot(v, kind.elementType))
        else:
            size = F.array_size(value).cast("long") * SLOT
    elif isinstance(kind, T.MapType):
        size = (_beyond_slot(F.map_keys(value), T.ArrayType(kind.keyType))
                + _beyond_slot(F.map_values(value), T.ArrayType(kind.valueType)))
    elif isinstance(kind, T.StructType):
        size = F.lit(SLOT * len(kind.fields)).cast("long")
        for field in kind.fields:
            size = size + _beyond_slot(value.getField(field.name), field.dataType)
        size = F.when(value.isNotNull(), size)
    else:
        return F.lit(0).cast("long")
    return F.coalesce(size, F.lit(0).cast("long"))


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row, as a long: slots plus what texts, arrays, maps and structs take beside them."""
    size = F.lit(SLOT * (len(df.columns) + 2)).cast("long")
    for field in df.schema.fields:
        size = size + _beyond_slot(F.col(f"`{field.name}`"), field.dataType)
    return size


def fits(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Whether a frame has at most ``max_rows`` rows and ``max_bytes`` bytes.

    One narrow pass inside the JVM: every task adds up its rows and only two sums leave it.
    """
    sums = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("size")).first()
    return sums["n"] <= max_rows and sums["size"] <= max_bytes


def heavy_keys(df: DataFrame, keys: Sequence[str], max_bytes: int) -> tuple[int, DataFrame | None]:
    """Bytes of the frame, and a written table of the keys whose rows have more than ``max_bytes``, or None.

    The second step adds up hash buckets, several per allowed size: no key of a bucket below the limit
    can be heavy, whatever rows it has.  Only keys of the few full buckets are then counted one by one.
    """
    size = row_bytes(df)
    total = df.agg(F.sum(size)).first()[0] or 0
    if total <= max_bytes:
        return total, None
    bucket = F.pmod(key_hash(keys), F.lit(BUCKETS_PER_LIMIT * (total // max_bytes + 1)))
    full = stored(df.groupBy(bucket.alias("_bucket")).agg(F.sum(size).alias("_bytes"))
                  .filter(F.col("_bytes") > max_bytes).select("_bucket"), "full-buckets")
    heavy = None
    if not full.isEmpty():
        suspects = df.join(full, bucket == F.col("_bucket"), "left_semi")
        heavy = stored(suspects.groupBy(*keys).agg(F.sum(size).alias("_bytes"))
                       .filter(F.col("_bytes") > max_bytes), "heavy-keys")
        if heavy.isEmpty():
            release(heavy)
            heavy = None
    release(full)
    return total, heavy
