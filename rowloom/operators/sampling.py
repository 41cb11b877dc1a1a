"""Samples and splits.

Exact samples order rows by a hash of (seed, key) instead of ``rand``: the same
rows come back for any partitioning, cluster size or retry.  The key must be
unique per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.operators.narrowing import elements_at
from rowloom.operators.skew import MAX_GROUP_ROWS, attach

#: Hash digits by which a stratum's rows are counted at first; and rows of a bucket that are looked at one by one.
PREFIX_DIGITS, EDGE_ROWS = 4, 100_000


def hash_order(key: str | Column, seed: int) -> Column:
    """32 hex digits that depend only on the seed and the key; a null key has digits of its own."""
    col = F.col(key) if isinstance(key, str) else key
    return F.md5(F.coalesce(F.concat(F.lit(f"{seed}-"), col.cast("string")), F.lit(f"{seed} null")))


def hash_uniform(key: str | Column, seed: int) -> Column:
    """A uniform number in (0, 1) from the first 52 bits of the hash."""
    head = F.conv(F.substring(hash_order(key, seed), 1, 13), 16, 10).cast("double")
    return (head + 0.5) / F.lit(float(2**52))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int, with_replacement: bool = False) -> DataFrame:
    """Each row kept (or drawn) independently; narrow, size is approximate."""
    return df.sample(with_replacement, fraction, seed)


def sample_by(df: DataFrame, column: str, fractions: Mapping, seed: int) -> DataFrame:
    """Bernoulli fraction per stratum; strata not listed are dropped."""
    return df.sampleBy(column, dict(fractions), seed)


def _hash_cuts(df: DataFrame, stratum: Column, key: str, seed: int, size: Column) -> dict:
    """Per stratum the hash up to which rows are taken; strata taken whole are left out.

    ``size`` may use the stratum ``_s`` and its row count ``_all``.  Rows are
    counted per stratum and hash prefix, which shows the prefix that the cut lies
    in; while that holds too many rows, longer prefixes of it are counted, so no
    task orders more than EDGE_ROWS hashes of a stratum.  One row per stratum
    comes back, and callers list their strata.

    Raises an error if the cut falls between rows with one key: then no set of
    whole keys has that size.
    """
    whole = Window.partitionBy("_s")
    hashed = df.select(stratum.alias("_s"), hash_order(key, seed).alias("_hash"))
    counts = hashed.groupBy("_s").agg(F.count(F.lit(1)).alias("_all")).withColumn("_take", size.cast("long"))
    open_ = {r["_s"]: ("", r["_take"], r["_all"]) for r in counts.filter("_take < _all").collect()}
    cuts = {s: "" for s, (_, take, _) in open_.items() if take <= 0}
    open_ = {s: v for s, v in open_.items() if v[1] > 0}
    digits = 0
    while open_ and digits < 32:
        digits = min(32, digits + PREFIX_DIGITS) if max(v[2] for v in open_.values()) > EDGE_ROWS else 32
        prefix = F.try_element_at(_literal_map({s: v[0] for s, v in open_.items()}), F.col("_s"))
        left = F.try_element_at(_literal_map({s: v[1] for s, v in open_.items()}), F.col("_s"))
        upto = whole.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
        parts = (hashed.filter(F.startswith(F.col("_hash"), prefix)).withColumn("_prefix", F.substring("_hash", 1, digits))
                 .groupBy("_s", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
                 .withColumn("_left", left - F.coalesce(F.sum("_n").over(upto), F.lit(0)))
                 .filter(F.col("_left") > 0))
        # The last bucket that anything is taken of.
        last = parts.groupBy("_s").agg(F.max_by(F.struct("_prefix", "_left", "_n"), "_prefix").alias("_b")).select("_s", "_b.*")
        found = {r["_s"]: (r["_prefix"], r["_left"], r["_n"]) for r in last.collect()}
        for s, (edge, take, n) in found.items():
            if take == n:  # all of it, and nothing behind it
                cuts[s] = edge.ljust(32, "f")
            elif digits == 32:
                raise ValueError(f"{take} of {n} rows with the same {key} would have to be taken: the key must be unique")
        open_ = {s: v for s, v in found.items() if s not in cuts}
    return cuts


def _literal_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def exact_sample(df: DataFrame, key: str, seed: int, fraction: float | None = None,
                 size: int | None = None) -> DataFrame:
    """Exactly ``size`` rows, or round(count * fraction) rows.

    The result is a narrow filter on the hash; nothing is sorted or moved.
    """
    if (fraction is None) == (size is None):
        raise ValueError("give either a fraction or a size")
    wanted = F.lit(size) if size is not None else F.round(F.col("_all") * fraction).cast("long")
    cuts = _hash_cuts(df, F.lit(0), key, seed, wanted)
    return df.filter(hash_order(key, seed) <= cuts[0]) if cuts else df


def exact_stratified_sample(df: DataFrame, column: str, sizes: Mapping[str, int], key: str, seed: int,
                            other: str | None = "Other", stratum: str = "stratum") -> DataFrame:
    """Exactly the listed number of rows per stratum (or all if it has fewer).

    Values that are not listed go into the ``other`` stratum if that has a size.
    """
    listed = F.col(column).isin([s for s in sizes if s != other])
    named = (df.withColumn(stratum, F.when(F.coalesce(listed, F.lit(False)), F.col(column)).otherwise(other))
             .filter(F.col(stratum).isin(list(sizes))))
    wanted = F.try_element_at(_literal_map(sizes), F.col("_s"))
    cuts = _hash_cuts(named, F.col(stratum), key, seed, wanted)
    if not cuts:
        return named
    cut = F.try_element_at(_literal_map(cuts), F.col(stratum))
    return named.filter(cut.isNull() | (hash_order(key, seed) <= cut))


def weighted_sample(df: DataFrame, key: str, weight: str, size: int, seed: int,
                    max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """``size`` rows without replacement, chance in proportion to the weight.

    Each row draws -ln(u) / weight from its key's hash; the smallest draws win
    (Efraimidis and Spirakis).  Rows without a positive weight cannot be drawn;
    all others are taken if there are no more than ``size``.

    The draw that cuts off ``size`` rows is found by sketches and proving counts
    (``rowloom.operators.narrowing``), so the sample is a narrow filter for any size.  Rows whose draw equals
    the cut, of which unique keys have hardly ever two, are taken by key.
    """
    if size <= 0:
        return df.limit(0)
    draws = (df.filter(F.col(weight) > 0)
             .withColumn("_draw", -F.log(hash_uniform(key, seed)) / F.col(weight)))
    cut = elements_at(draws, [], "_draw", {"cut": lambda n: F.least(F.lit(size), n)}, max_rows).first()
    if cut is None or cut["cut"] is None:
        return draws.select(*df.columns)
    draw, edge = F.col("_draw"), F.lit(cut["cut"])
    below, ties = draws.agg(F.count_if(draw < edge), F.count_if(draw == edge)).first()
    if below + ties <= size:
        return draws.filter(draw <= edge).select(*df.columns)
    taken = draws.filter(draw == edge).orderBy(key).limit(size - below)
    return draws.filter(draw < edge).unionByName(taken).select(*df.columns)


def random_split(df: DataFrame, weights: Mapping[str, float], key: str, seed: int, name: str = "part") -> DataFrame:
    """A label per row with chances in proportion to the weights; narrow.

    Filtering on the label gives complete, disjoint parts.
    """
    total, upto = float(sum(weights.values())), 0.0
    draw, labels = hash_uniform(key, seed), list(weights)
    case = None
    for label in labels[:-1]:
        upto += weights[label] / total
        case = (F if case is None else case).when(draw < upto, F.lit(label))
    return df.withColumn(name, F.lit(labels[-1]) if case is None else case.otherwise(F.lit(labels[-1])))


def modulo_split(df: DataFrame, key: str, parts: int, name: str = "part") -> DataFrame:
    """Part number from the id's remainder; also right for negative ids."""
    return df.withColumn(name, F.pmod(F.col(key), F.lit(parts)).cast("int"))


def sample_distribution(df: DataFrame, sample: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and share per key before and after sampling; a null key is a key and stays null."""
    def shares(frame: DataFrame, tag: str) -> DataFrame:
        counts = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"n_{tag}"))
        total = counts.agg(F.sum(f"n_{tag}")).scalar()
        return counts.withColumn(f"pct_{tag}", F.col(f"n_{tag}") * 100.0 / total)
    added = ["n_sample", "pct_sample"]
    return attach(shares(df, "all"), shares(sample, "sample"), keys, added).fillna(0, subset=added)


def expected_rows(df: DataFrame, sample: DataFrame, column: str, fractions: Mapping[str, float]) -> DataFrame:
    """Per stratum the expected (count * fraction) and the sampled number of rows.

    ``None`` among the fractions is that of the null stratum.
    """
    listed = {s: f for s, f in fractions.items() if s is not None}
    found = F.try_element_at(_literal_map(listed), F.col(column)) if listed else F.lit(None).cast("double")
    lookup = F.when(F.col(column).isNull(), F.lit(fractions.get(None)).cast("double")).otherwise(found)
    expected = (df.groupBy(column).agg(F.count(F.lit(1)).alias("n_all"))
                .withColumn("fraction", lookup)
                .filter(F.col("fraction").isNotNull())
                .withColumn("n_expected", F.round(F.col("n_all") * F.col("fraction")).cast("long")))
    actual = sample.groupBy(column).agg(F.count(F.lit(1)).alias("n_sample"))
    return attach(expected, actual, [column], ["n_sample"]).fillna(0, subset=["n_sample"])


def validate_sample(df: DataFrame, sample: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, spread, minimum and maximum of sample and table, one row per column."""
    def summary(frame: DataFrame, tag: str) -> DataFrame:
        wide = frame.agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in
                           (("mean", F.mean), ("sd", F.stddev), ("min", F.min), ("max", F.max))])
        rows = F.array(*[F.struct(F.lit(c).alias("column"), *[
            F.col(f"{c}_{n}").cast("double").alias(f"{n}_{tag}") for n in ("mean", "sd", "min", "max")])
            for c in columns])
        return wide.select(F.inline(rows))
    return (summary(df, "all").join(summary(sample, "sample"), "column")
            .withColumn("mean_gap", F.try_divide(F.col("mean_sample") - F.col("mean_all"), F.col("mean_all"))))
