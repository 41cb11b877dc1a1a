"""The elements at given places of each group's order, exactly, without ordering a large group.

Groups of up to ``max_rows`` rows are sorted by a window, in one shuffle.  The
rows of larger groups stay where they are:

1. a KLL sketch of the group gives two values that the wanted element should lie between;
2. one pass counts what lies below, at and between the two, which proves or
   corrects them; while too many rows are between, a sketch of just these narrows further;
3. the few values left are counted, and a running count finds the element.

Only counts and sketches are shuffled in the first two steps, one row per group
and task.  The sketches decide how many passes there are, never the result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.operators.skew import MAX_GROUP_ROWS, attach, likely_hot, position, with_keys
from rowloom.session import release, stored

#: Accuracy of the sketches (ranks are off by about a thousandth), and values that are read off one.
KLL, GRID = 4_000, 1_000
#: Steps of the grid that the bounds keep away from the wanted place.
MARGIN = 2

Places = Mapping[str, Callable[[Column], Column]]


def elements_at(df: DataFrame, keys: Sequence[str], column: str, places: Places,
                max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """One row per group: the keys and, for each name, the value of ``column`` at a place of its ascending order.

    ``places`` gives the place, from 1, as a function of the group's number of rows.
    Nulls are no values, NaN comes last.  ``column`` must be a number, date or timestamp if groups may be large.
    """
    known = df.filter(F.col(f"`{column}`").isNotNull()).select(*keys, column)
    if max_rows is None:
        return _sorted(known, keys, column, places)
    if not keys:
        return (_narrowed if known.count() > max_rows else _sorted)(known, keys, column, places, max_rows)
    hot = likely_hot(known, keys, max_rows)
    if hot is None:
        return _sorted(known, keys, column, places)
    large = _narrowed(with_keys(known, keys, hot), keys, column, places, max_rows)
    return _sorted(with_keys(known, keys, hot, "left_anti"), keys, column, places).unionByName(large)


def _sorted(df: DataFrame, keys: Sequence[str], column: str, places: Places, max_rows: int | None = None) -> DataFrame:
    group = Window.partitionBy(*keys)
    numbered = df.select(*keys, column, F.row_number().over(group.orderBy(F.col(f"`{column}`"))).alias("_at"),
                         F.count(F.lit(1)).over(group).alias("_n"))
    return numbered.groupBy(*keys).agg(*[F.max(F.when(F.col("_at") == place(F.col("_n")), F.col(f"`{column}`"))).alias(name)
                                         for name, place in places.items()])


def _bounds(sketch: Column, rank: Column, n: Column) -> tuple[Column, Column]:
    """Values of the sketch around the place ``rank`` of ``n``, so that the place should lie between them."""
    grid = F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))
    step = F.floor(rank / n * GRID).cast("int")
    return (F.element_at(grid, F.greatest(step - MARGIN, F.lit(0)) + 1),
            F.element_at(grid, F.least(step + MARGIN + 1, F.lit(GRID)) + 1))


def _narrowed(df: DataFrame, keys: Sequence[str], column: str, places: Places, max_rows: int) -> DataFrame:
    inf = float("inf")
    rows = df.select(*keys, F.col(f"`{column}`").alias("_v"), F.nanvl(position(df, column), F.lit(inf)).alias("_x"))
    x, ids = F.col("_x"), range(len(places))
    state = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.kll_sketch_agg_double("_x", F.lit(KLL)).alias("_s"))
    for i, place in enumerate(places.values()):
        rank = place(F.col("_n")).cast("long")
        low, high = _bounds(F.col("_s"), rank, F.col("_n"))
        state = state.withColumns({f"_k{i}": rank, f"_lo{i}": low, f"_hi{i}": high})
    bounds = stored(state.drop("_n", "_s"), "quantile-bounds")
    names = [f"_{c}{i}" for i in ids for c in ("k", "lo", "hi")]
    while True:
        met = attach(rows, bounds, keys, names)
        lo, hi = [F.col(f"_lo{i}") for i in ids], [F.col(f"_hi{i}") for i in ids]
        inner = [(x > lo[i]) & (x < hi[i]) for i in ids]
        counted = met.groupBy(*keys, *names).agg(*[f for i in ids for f in (
            F.count_if(x < lo[i]).alias(f"_below{i}"), F.count_if(x == lo[i]).alias(f"_low{i}"),
            F.count_if(inner[i]).alias(f"_inner{i}"), F.count_if((x == hi[i]) & (lo[i] < hi[i])).alias(f"_high{i}"),
            F.kll_sketch_agg_double(F.when(inner[i], x), F.lit(KLL)).alias(f"_s{i}"))])
        step, open_ = counted, F.lit(False)
        for i in ids:
            k, below, low, middle, high = (F.col(f"_{c}{i}") for c in ("k", "below", "low", "inner", "high"))
            left, at_low = k <= below, k <= below + low
            between, at_high = k <= below + low + middle, k <= below + low + middle + high
            far_lo, far_hi = _bounds(F.col(f"_s{i}"), k - below - low, middle)
            small = middle <= max_rows
            step = step.withColumns({
                f"_open{i}": left | (~at_low & between & ~small) | ~at_high,
                f"_next_lo{i}": F.when(left, -inf).when(at_low | (between & small), lo[i]).when(between, far_lo).otherwise(hi[i]),
                f"_next_hi{i}": F.when(left | at_low, lo[i]).when(between & small, hi[i]).when(between, far_hi)
                .when(at_high, hi[i]).otherwise(inf),
                # Rows below the low bound, where that is settled.
                f"_below{i}": F.when(at_low | between, below).otherwise(below + low + middle)})
            open_ = open_ | F.col(f"_open{i}")
        after = stored(step.withColumn("_open", open_).select(
            *keys, "_open", *[F.col(f"_{c}{i}") for i in ids for c in ("below", "k")],
            *[F.col(f"_next_{c}{i}").alias(f"_{c}{i}") for i in ids for c in ("lo", "hi")]), "quantile-bounds")
        release(bounds)
        bounds = after
        if bounds.filter("_open").isEmpty():
            break
    # What is left between proven bounds.
    met = attach(rows, bounds, keys, [*names, *[f"_below{i}" for i in ids]])
    wanted = F.array(*[F.when(x.between(F.col(f"_lo{i}"), F.col(f"_hi{i}")), F.struct(
        F.lit(i).alias("_i"), F.col(f"_k{i}").alias("_place"), F.col(f"_below{i}").alias("_under"))) for i in ids])
    near = met.select(*keys, "_v", F.inline(F.filter(wanted, lambda w: w.isNotNull())))
    counts = near.groupBy(*keys, "_i", "_place", "_under", "_v").agg(F.count(F.lit(1)).alias("_rows"))
    upto = Window.partitionBy(*keys, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    reached = (counts.withColumn("_upto", F.sum("_rows").over(upto) + F.col("_under")).filter(F.col("_upto") >= F.col("_place")))
    return reached.groupBy(*keys).agg(*[F.min(F.when(F.col("_i") == i, F.col("_v"))).alias(name) for i, name in enumerate(places)])
