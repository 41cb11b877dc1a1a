"""Joins: strategy hints, checked broadcasts, salting, hot-key splits, calendars."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.operators.measure import fits, heavy_keys, row_bytes
from rowloom.operators.setops import COPIES_PER_TASK, collapse_copies
from rowloom.operators.skew import MAX_GROUP_ROWS, attach, find_hot, same_keys, spread_by_hash
from rowloom.session import stored

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: Bytes of rows that one task may hash, and the kinds of join that a hash of parts can answer.
BUILD_BYTES = 256 * 1024 * 1024
JOIN_KINDS = {"inner": "inner", "left": "left", "leftouter": "left", "semi": "left_semi", "leftsemi": "left_semi",
              "anti": "left_anti", "leftanti": "left_anti"}


def sort_merge_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Ask for a sort-merge join for this query only, no session change."""
    return left.join(right.hint("merge"), list(on), how)


def shuffle_hash_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                      max_rows: int | None = MAX_GROUP_ROWS, max_bytes: int = BUILD_BYTES) -> DataFrame:
    """Shuffle both sides and hash the right one, in parts of about ``max_bytes`` at most.

    The right side is measured.  It gets as many partitions as its bytes need; a key with too many bytes for one
    task is cut into parts, each of which meets all left rows of the key.  Hot left keys
    (over ``max_rows``) are spread, with their right rows repeated.  Semi and anti joins hash each key once.
    Null keys match nothing and are not hashed.  Right and full joins, which must know all
    left rows of a key in one place, go by a merge join, which spills.
    """
    kind = JOIN_KINDS.get(how.lower().replace("_", ""))
    if kind is None:
        return sort_merge_join(left, right, on, how)
    keys = list(on)
    build = right.filter(reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys]))
    if kind in ("left_semi", "left_anti"):
        build = build.select(*[F.col(f"`{k}`") for k in keys]).distinct()
    total, heavy = heavy_keys(build, keys, max_bytes // 4)
    hot = find_hot(left, keys, max_rows)
    if heavy is not None:
        left, build = _split_build(left, build, keys, heavy, max_bytes)
        keys.append("_build_part")
    if hot is not None:
        left, build = salt_sides(left, build, on, hot)
        keys.append("_salt")
    tasks = 4 * total // max_bytes + 1
    if tasks > int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        columns = [F.col(f"`{k}`") for k in keys]
        left, build = left.repartition(tasks, *columns), build.repartition(tasks, *columns)
    joined = left.join(build.hint("shuffle_hash"), keys, kind)
    if heavy is not None:
        # A heavy key matches in one part at least, so rows of its parts without a match are no result.
        joined = joined.filter(F.col("_build_copies").isNotNull() | ~F.col("_heavy"))
        chunks = F.sequence(F.lit(1).cast("long"), F.coalesce(F.col("_build_copies"), F.lit(1).cast("long")))
        joined = joined.withColumn("_build_copies", F.explode(chunks)).drop("_build_copies", "_heavy", "_build_part")
    return joined.drop("_salt") if hot is not None else joined


def _split_build(left: DataFrame, build: DataFrame, keys: Sequence[str], heavy: DataFrame,
                 max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_build_part``: right rows of heavy keys dealt out to parts, left rows repeated per part.

    Copies of one row become one row with ``_build_copies``, in chunks, so that copies can be dealt out too.
    """
    known = [F.col(f"`{c}`") for c in build.columns]
    rows = collapse_copies(build.join(heavy, list(keys), "left_semi").select(*known), "_build_copies")
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_build_copies") - 1) / COPIES_PER_TASK)))
    rest = F.least(F.col("_build_copies") - F.col("_chunk") * COPIES_PER_TASK, F.lit(COPIES_PER_TASK).cast("long"))
    chunks = stored(rows.withColumn("_chunk", chunk).withColumn("_build_copies", rest), "heavy-rows")
    parts = stored(chunks.groupBy(*keys).agg(F.sum(row_bytes(chunks)).alias("_bytes"))
                   .select(*keys, F.ceil(4 * F.col("_bytes") / max_bytes).cast("int").alias("_build_parts")), "heavy-parts")
    part = spread_by_hash([*build.columns, "_chunk"], F.col("_build_parts"))
    dealt = (attach(chunks, parts, keys, ["_build_parts"]).withColumn("_build_part", part)
             .select(*known, "_build_part", "_build_copies"))
    others = (build.join(heavy, list(keys), "left_anti")
              .select(*known, F.lit(0).alias("_build_part"), F.lit(1).cast("long").alias("_build_copies")))
    met = attach(left, parts, keys, ["_build_parts"])
    repeated = met.withColumn("_heavy", F.col("_build_parts").isNotNull()).withColumn(
        "_build_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_build_parts"), F.lit(1)) - 1))).drop("_build_parts")
    return repeated, others.unionByName(dealt)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure whether a frame is small enough to broadcast: one narrow pass, of which only sums are moved."""
    return fits(df, max_rows, max_bytes)


def broadcast_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                   max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast the right side if it measures small.

    Else the rows are the same by another way: a skew-safe join for inner and left
    joins, Spark's own choice for the other kinds.
    """
    if is_small(right, max_rows, max_bytes):
        return left.join(F.broadcast(right), list(on), how)
    return skew_join(left, right, on, how) if how in ("inner", "left") else left.join(right, list(on), how)


def lookup_case(df: DataFrame, column: str, mapping: Mapping, name: str, default=None) -> DataFrame:
    """A tiny lookup as one CASE expression instead of a join, so no shuffle."""
    pairs = list(mapping.items())
    case = F.when(F.col(column) == F.lit(pairs[0][0]), F.lit(pairs[0][1]))
    for value, target in pairs[1:]:
        case = case.when(F.col(column) == F.lit(value), F.lit(target))
    return df.withColumn(name, case.otherwise(F.lit(default)))


def _salted(left: DataFrame, right: DataFrame, on: Sequence[str], how: str,
            left_salt: Column, right_salts: Column) -> DataFrame:
    if how not in ("inner", "left"):
        raise ValueError("a salted join repeats right rows, so it is inner or left")
    salted_left = left.withColumn("_salt", left_salt)
    salted_right = right.withColumn("_salt", F.explode(right_salts))
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], salts: int,
                how: str = "left", hot: Sequence | None = None) -> DataFrame:
    """Spread each key over ``salts`` tasks; with ``hot`` only those keys.

    The salt is a second integer join key taken from the left row's hash; every
    right row is repeated once per salt, so each left row meets its match in
    exactly one place and the answer equals the plain join.  Null keys match
    nothing, as in the plain join.
    """
    salt, copies = spread_by_hash(left.columns, salts), F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is not None:
        if len(on) != 1:
            raise ValueError("a list of hot values needs a single join key")
        is_hot = F.coalesce(F.col(on[0]).isin(list(hot)), F.lit(False))
        salt = F.when(is_hot, salt).otherwise(0)
        copies = F.when(is_hot, copies).otherwise(F.array(F.lit(0)))
    return _salted(left, right, on, how, salt, copies)


def skew_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
              max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """J13 with the hot keys found from the data, each with its own salt count.

    Keys that are not hot keep one salt and are not repeated.  Null keys match
    nothing; where they are hot, their rows are spread over many salts.
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join repeats right rows, so it is inner or left")
    hot = find_hot(left, on, max_rows)
    if hot is None:
        return left.join(right, list(on), how)
    salted_left, salted_right = salt_sides(left, right, on, hot)
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def salt_sides(left: DataFrame, right: DataFrame, keys: Sequence[str],
               hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: left rows of hot keys spread, right rows repeated per part."""
    spread = attach(left, hot, keys, ["_parts"])
    salt = F.coalesce(spread_by_hash(left.columns, F.col("_parts")), F.lit(0))
    repeated = attach(right, hot, keys, ["_parts"])
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    return (spread.withColumn("_salt", salt).drop("_parts"),
            repeated.withColumn("_salt", F.explode(salts)).drop("_parts"))


def split_hot_join(left: DataFrame, right: DataFrame, key: str, hot: Sequence, how: str = "left") -> DataFrame:
    """Hot keys meet their few right rows by broadcast, the rest by merge.

    The right rows of the listed keys are measured before they are broadcast;
    if they are too many the hot part is salted instead, as are keys that turn out hot without being listed.
    """
    if how not in ("inner", "left"):
        raise ValueError("split_hot_join supports inner and left")
    is_hot = F.coalesce(F.col(key).isin(list(hot)), F.lit(False))
    hot_left, hot_right = left.filter(is_hot), right.filter(F.col(key).isin(list(hot)))
    cold = skew_join(left.filter(~is_hot), right, [key], how)
    return broadcast_join(hot_left, hot_right, [key], how).unionByName(cold)


def join_back(df: DataFrame, table: DataFrame, keys: Sequence[str], values: Sequence[str],
              max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Put per-key values of ``table`` on every row of the key; null keys count as a key.

    Hot keys are split over several tasks with the hash salt of ``skew_join``.
    """
    return _join_back(df, table, keys, values, find_hot(df, keys, max_rows) if keys else None)


def _join_back(df: DataFrame, table: DataFrame, keys: Sequence[str], values: Sequence[str],
               hot: DataFrame | None) -> DataFrame:
    if not keys:
        return attach(df, table, keys, values)
    left, right, on = df, table.select(*keys, *values), list(keys)
    if hot is not None:
        left, right = salt_sides(df, right, keys, hot)
        on.append("_salt")
    return (left.alias("l").join(right.alias("r"), same_keys("l", "r", on), "left")
            .select(*[F.col(f"l.`{c}`") for c in df.columns], *[F.col(f"r.`{v}`") for v in values]))


def group_values(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column],
                 max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Aggregates of the row's group on every row.

    Without hot groups this is a window, one shuffle.  With hot groups it is
    aggregate and join back: partial aggregation makes the totals skew-proof
    and the join back splits hot keys, where a window would gather them.
    """
    hot = find_hot(df, keys, max_rows)
    if hot is None:
        window = Window.partitionBy(*keys)
        return df.select("*", *[agg.over(window).alias(name) for name, agg in aggregates.items()])
    table = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggregates.items()])
    return _join_back(df, table, keys, list(aggregates), hot)


def densify(df: DataFrame, keys: Sequence[str], period: str, measures: Sequence[str], fill=0,
            step: Column | int = 1) -> DataFrame:
    """One row per key and period, from the key's first period to its last; missing measures are filled.

    ``df`` holds one row per key and period already, i.e. it is aggregated first.
    Every key gets a calendar of its own, a sequence of whole numbers, dates or
    timestamps by ``step``, so the result has no more rows than the keys have
    periods.  A null period is no period.
    """
    known = df.filter(F.col(period).isNotNull())
    step = F.lit(step) if isinstance(step, int) else step
    calendar = (known.groupBy(*keys).agg(F.min(period).alias("_from"), F.max(period).alias("_to"))
                .select(*keys, F.explode(F.sequence("_from", "_to", step)).alias(period)))
    return attach(calendar, known, [*keys, period], measures).fillna(fill, subset=list(measures))


def fanout(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows per key on both sides and in their inner join, without running the join."""
    a = left.groupBy(*on).agg(F.count(F.lit(1)).alias("n_left"))
    b = right.groupBy(*on).agg(F.count(F.lit(1)).alias("n_right"))
    return a.join(b, list(on)).withColumn("n_joined", F.col("n_left") * F.col("n_right"))


def assert_join_fanout(left: DataFrame, right: DataFrame, on: Sequence[str], max_ratio: float) -> None:
    """Stop before a join that turns into an accidental cross join."""
    joined = fanout(left, right, on).agg(F.coalesce(F.sum("n_joined"), F.lit(0)).alias("n")).first()["n"]
    rows = left.count()
    if joined > max_ratio * max(rows, 1):
        raise ValueError(f"join on {list(on)} gives {joined} rows from {rows}: over {max_ratio} per row")
