"""How far the sources of each language differ in their words, exactly.

A price is a share: of the count of a term in a group (a source of a language, or
the whole language) in all its kept terms, as a whole number.  It depends on the
count alone, so a sum over terms for a pair of sources needs only the pair's joint table: how
many terms stand at count level a in one and at level b in the other.

The tables of all pairs come from one product.  Each term is a row of a matrix
with an indicator column for every (source, level above 0); the matrix times
its own transpose holds every joint table.  The product is taken in blocks of terms
with similar totals, which have few different levels, and of columns; entries are counts
of at most a block's rows, so 32-bit floats hold them exactly, and Spark adds
the blocks up.  Level 0 needs no columns, as its entries follow from the margins:
with c(a, b) the price of the cell,

    sum = all terms * c(0, 0) + sum over a of terms(a) * (c(a, 0) - c(0, 0)) + the same for b
          + sum over a, b of joint(a, b) * (c(a, b) - c(a, 0) - c(0, b) + c(0, 0))

Prices are whole numbers of at most ten digits; the arithmetic is Spark's own on
longs, and overflow is an error.  A term's row lists the sources that have
it; the result has a row for each pair of sources, so such a list is at
most the square root of the result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.llm.common import pieces, scratch, stored, texts, word_slices
from rowloom.operators.joins import salted_join
from rowloom.operators.skew import attach

#: A-Z become a-z; every other ASCII character that is no letter becomes a space.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Counts held by a task before they are passed on; rows and cells of a block; columns of a part of a product.
HELD, BLOCK_ROWS, BLOCK_CELLS, WIDTH = 400_000, 1 << 16, 1 << 21, 2_048
SCALE = 1_000_000_000
COUNTED = "lang string, source string, term binary, n long, docs long"
JOINT = "lang string, left_source string, left_n long, right_source string, right_n long, terms long"


def count_terms(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, added up in each task as far as ``held`` entries go."""
    def flush(found: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, seen) in found.items():
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(n), pa.string()), "source": pa.array([source] * len(n), pa.string()),
                "term": pa.array(list(n), pa.binary()), "n": pa.array(list(n.values()), pa.int64()),
                "docs": pa.array([seen[t] for t in n], pa.int64())})

    def count(batches):
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        added = 0
        for batch in pieces(batches, 1_000):
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), texts(batch["text"])):
                n, seen = found.setdefault((lang, source), (Counter(), Counter()))
                terms: set[bytes] = set()
                for words in word_slices(text.translate(LETTERS)):
                    n.update(words)
                    terms.update(words)
                seen.update(terms)
                added += len(terms)
            if added > held:
                added = sum(len(n) for n, _ in found.values())
                if added > held // 2:
                    yield from flush(found)
                    found, added = {}, 0
        yield from flush(found)

    return docs.mapInArrow(count, COUNTED)


def term_table(counted: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, n, cells) of the kept terms: all occurrences and those of each source.

    One shuffle by language and term serves both groupings.
    """
    by_source = (counted.repartition("lang", "term").groupBy("lang", "term", "source")
                 .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return (by_source.groupBy("lang", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("cells"))
            .filter(F.col("docs") >= least_docs).select("lang", F.col("term").cast("string").alias("term"), "n", "cells"))


def _ranges(order: np.ndarray, starts: np.ndarray, column: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of rows, in ``order``, with few columns: rows and columns of their cells, and the columns' numbers."""
    todo = [order]
    while todo:
        rows = todo.pop()
        sizes = starts[rows + 1] - starts[rows]
        row = np.repeat(np.arange(len(rows)), sizes)
        cell = np.repeat(starts[rows] - np.cumsum(sizes) + sizes, sizes) + np.arange(len(row))
        columns, own = np.unique(column[cell], return_inverse=True)
        if len(rows) > 64 and len(columns) > 512:
            todo += [rows[:len(rows) // 2], rows[len(rows) // 2:]]
        else:
            yield row, own, columns


def joint_levels(totals: np.ndarray, starts: np.ndarray, source: np.ndarray, level: np.ndarray,
                 width: int = WIDTH) -> Iterator[tuple[np.ndarray, ...]]:
    """(source, level, source, level, terms) of sources in ascending order, for the terms of one language.

    Term i has the cells ``starts[i]`` to ``starts[i + 1]``.  Entries of a block are
    exact; the same table entry may come from several blocks.
    """
    kinds, column = np.unique(np.stack((source, level)), axis=1, return_inverse=True)
    for row, own, columns in _ranges(np.argsort(totals, kind="stable"), starts, column.ravel()):
        parts = range(0, len(columns), width)

        def indicators(at: int) -> np.ndarray:
            inside = (own >= at) & (own < at + width)
            matrix = np.zeros((row[-1] + 1, min(width, len(columns) - at)), np.float32)
            matrix[row[inside], own[inside] - at] = 1
            return matrix

        for i in parts:
            left = indicators(i).T
            for k in parts:
                if k >= i:
                    product = left @ (left.T if k == i else indicators(k))
                    a, b = np.nonzero(product)
                    n = product[a, b].astype(np.int64)
                    a, b = columns[a + i], columns[b + k]
                    use = kinds[0, a] < kinds[0, b]
                    a, b = a[use], b[use]
                    yield kinds[0, a], kinds[1, a], kinds[0, b], kinds[1, b], n[use]


def joint_tables(terms: DataFrame, block_rows: int = BLOCK_ROWS, block_cells: int = BLOCK_CELLS, width: int = WIDTH) -> DataFrame:
    """``JOINT``: how many terms stand at both levels, for sources in ascending order, levels above 0."""
    def multiply(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows).combine_chunks()
        lists = table["cells"].chunk(0)
        cells = lists.flatten()
        encoded = cells.field("source").dictionary_encode()
        names = encoded.dictionary.to_pylist()
        order = sorted(range(len(names)), key=lambda i: names[i].encode())
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        names = pa.array([names[i] for i in order], pa.string())
        source, level = place[encoded.indices.to_numpy()], cells.field("n").to_numpy()
        sizes = np.diff(lists.offsets.to_numpy())
        langs = table["lang"].chunk(0).dictionary_encode()
        which = langs.indices.to_numpy()
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            own = np.flatnonzero(which == i)
            inside = np.repeat(which == i, sizes)
            starts = np.concatenate(([0], np.cumsum(sizes[own])))
            for a, x, b, y, n in joint_levels(table["n"].to_numpy()[own], starts, source[inside], level[inside], width):
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int64))),
                    "left_source": names.take(pa.array(a)), "left_n": pa.array(x),
                    "right_source": names.take(pa.array(b)), "right_n": pa.array(y), "terms": pa.array(n)})

    def products(batches):
        rows, n_rows, n_cells = [], 0, 0
        for batch in batches:
            if batch.num_rows:
                rows.append(batch)
                n_rows += batch.num_rows
                n_cells += len(batch["cells"].flatten())
            if n_rows >= block_rows or n_cells >= block_cells:
                yield from multiply(rows)
                rows, n_rows, n_cells = [], 0, 0
        if rows:
            yield from multiply(rows)

    keys = [f.split()[0] for f in JOINT.split(", ")[:-1]]
    return terms.select("lang", "n", "cells").mapInArrow(products, JOINT).groupBy(*keys).agg(F.sum("terms").alias("terms"))


def price(n: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kinds)), exact for any count; 1 without kept terms."""
    below = total + kinds
    short = F.lit(SCALE).cast("long") * (n + 1)
    long = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    exact = F.when(n < 9 * SCALE, F.call_function("div", short, below)).otherwise(F.call_function("div", long, below.cast("decimal(20,0)")))
    return F.when(kinds > 0, exact + 1).otherwise(F.lit(1).cast("long"))


def cost(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank of every (lang, source) group of ``docs`` (text, lang, source).

    Part ``pair`` compares the group with each other source of its language, part
    ``term`` lists its ``top`` terms above the language's share.  Null text, lang and
    source are ''; a term is a run of letters and non-ASCII characters, kept by a
    language if at least ``least_docs`` of its documents have it.  Groups without
    kept terms are compared all the same, a language without any has values 0, and
    the only source of a language has no pairs.  Rows are documents of their own;
    other columns are not looked at; no rows give no rows.
    """
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    with scratch(docs.sparkSession) as own:
        return own.hand_over(_audited(plain, least_docs, top), "divergence")


def _audited(plain: DataFrame, least_docs: int, top: int) -> DataFrame:
    terms = stored(term_table(count_terms(plain), least_docs), "divergence-terms")
    cells = terms.select("lang", "term", F.col("n").alias("lang_n"), F.inline("cells")).withColumnRenamed("n", "own_n")
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("lang_total"))
    own = cells.groupBy("lang", "source").agg(F.sum("own_n").alias("total"))
    groups = attach(attach(plain.select("lang", "source").distinct(), own, ["lang", "source"], ["total"]),
                    langs, ["lang"], ["kinds", "lang_total"]).fillna(0)
    groups = stored(groups, "divergence-groups")
    return _pairs(terms, cells, groups).unionByName(_terms(cells, groups, top))


def _terms(cells: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    priced = attach(cells, groups, ["lang", "source"], ["total", "kinds", "lang_total"]).select(
        "lang", "source", F.col("term").alias("item"), price(F.col("own_n"), F.col("total"), F.col("kinds")).alias("p"),
        price(F.col("lang_n"), F.col("lang_total"), F.col("kinds")).alias("q"))
    above = priced.filter(F.col("p") > F.col("q")).select("lang", "source", "item", cost(F.col("p"), F.col("q")).alias("value"))
    return _ranked(above, "term").filter(F.col("rank") <= top)


def _ranked(values: DataFrame, part: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return values.select("lang", "source", F.lit(part).alias("part"), "item", "value", place.alias("rank"))


def _pairs(terms: DataFrame, cells: DataFrame, groups: DataFrame) -> DataFrame:
    sides = salted_join(groups.select("lang", "source", "kinds", F.col("total").alias("t")),
                        groups.select("lang", F.col("source").alias("item"), F.col("total").alias("u")),
                        ["lang"], 32, "inner").filter(F.col("source") != F.col("item"))
    kinds, t, u = F.col("kinds"), F.col("t"), F.col("u")
    none = F.lit(0).cast("long")
    p0, q0 = price(none, t, kinds), price(none, u, kinds)
    nothing = cost(p0, q0)
    keys = ["lang", "source", "item"]
    levels = cells.groupBy("lang", "source", "own_n").agg(F.count(F.lit(1)).alias("terms"))
    p = price(F.col("own_n"), t, kinds)
    q = price(F.col("own_n"), u, kinds)
    n = F.col("terms")
    flat = sides.select(*keys, (kinds * nothing).alias("value"))
    left = sides.join(levels, ["lang", "source"]).select(*keys, (n * (cost(p, q0) - nothing)).alias("value"))
    right = (sides.join(levels.withColumnRenamed("source", "item"), ["lang", "item"])
             .select(*keys, (n * (cost(p0, q) - nothing)).alias("value")))
    joint = joint_tables(terms).withColumnsRenamed({"left_source": "source", "right_source": "item"})
    x, y = price(F.col("left_n"), t, kinds), price(F.col("right_n"), u, kinds)

    def both(one: Column, other: Column, one0: Column, other0: Column) -> Column:
        return n * (cost(one, other) - cost(one, other0) - cost(one0, other) + cost(one0, other0))

    prices = sides.join(joint, keys).select(*keys, "terms", x.alias("x"), y.alias("y"), p0.alias("x0"), q0.alias("y0"))
    x, y, x0, y0 = map(F.col, ("x", "y", "x0", "y0"))
    summed = prices.groupBy(*keys).agg(F.sum(both(x, y, x0, y0)).alias("to"), F.sum(both(y, x, y0, x0)).alias("back"))
    there = summed.select(*keys, F.col("to").alias("value"))
    back = summed.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value"))
    parts = flat
    for other in (left, right, there, back):
        parts = parts.unionByName(other)
    return _ranked(parts.groupBy(*keys).agg(F.sum("value").alias("value")), "pair")
