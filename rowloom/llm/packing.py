"""Documents packed into windows: repeat counts of length combinations by non-negative least squares.

A document of n ids gives n // window full windows and a rest.  Only the counts
of the rests' lengths, at most ``window`` numbers, come to the driver.  There the
plan is made: combinations of up to four lengths that fill a window exactly are
enumerated, the repeat counts x >= 0 that minimise |A x - h| are found by
coordinate descent, rounded down to whole numbers within what is left, and the
residue is packed greedily: the longest rest first, then the longest that still
fit.  Where nothing fits into a gap, a rest is cut there, so a window has
padding only if no ids are left at all.

The plan says for each length which ranks go to which windows.  Ranks need no
sort: tasks number their own rests by length as they tokenize, and the counts of
(task, length) give the offset of each task.  So a length that a third of all
documents have costs no more than any other.
"""

from __future__ import annotations

import bisect
import itertools
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rowloom.llm.common import pieces, stored, texts
from rowloom.llm.tokens import word_tokenizer

WINDOW = 2048
#: Combinations of more than two lengths start from so many second lengths per first.
SPREAD = 12
SWEEPS = 60
BATCH_ROWS = 1_000

TOKENS = "doc_id long, ids binary, n long, rest int, block int, rank long, full long"
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
DIGESTS = PIECES.replace("ids binary", "ids_crc32 long")


def combinations(lengths: list[int], window: int, spread: int = SPREAD) -> list[tuple[int, ...]]:
    """Up to four of the given lengths that add up to the window, longest first.

    All pairs; triples and quadruples for evenly spaced second (and third)
    lengths, their last being what is missing.
    """
    have = set(lengths)
    found = {(a, window - a) for a in lengths if 2 * a >= window and window - a in have}

    def spaced(low: int, high: int, n: int) -> list[int]:
        inside = lengths[bisect.bisect_left(lengths, low):bisect.bisect_right(lengths, high)]
        return inside[::max(1, len(inside) // n)]

    for a in lengths:
        rest = window - a
        for b in spaced(-(-rest // 2), min(a, rest - 1), spread):
            if rest - b in have:
                found.add((a, b, rest - b))
            left = rest - b
            for c in spaced(-(-left // 2), min(b, left - 1), 2):
                if left - c in have:
                    found.add((a, b, c, left - c))
    return sorted(found, key=lambda c: (len(c), c))


def repeat_counts(chosen: list[tuple[int, ...]], histogram: dict[int, int], sweeps: int = SWEEPS) -> list[float]:
    """Non-negative least squares by cyclic coordinate descent: x >= 0 with the smallest |A x - h|."""
    residual = {k: float(v) for k, v in histogram.items()}
    columns = [[(k, len(list(g))) for k, g in itertools.groupby(c)] for c in chosen]
    norms = [sum(m * m for _, m in c) for c in columns]
    x = [0.0] * len(chosen)
    for _ in range(sweeps):
        moved = 0.0
        for i, column in enumerate(columns):
            if len(column) == 2:
                (a, m), (b, n) = column
                step = (residual[a] * m + residual[b] * n) / norms[i]
            else:
                step = sum(residual[k] * m for k, m in column) / norms[i]
            step = max(step, -x[i])
            if step:
                x[i] += step
                moved = max(moved, abs(step))
                for k, m in column:
                    residual[k] -= m * step
        if moved < 0.25:
            break
    return x


class Plan:
    """For each length, which ranks go into which window, and where.

    ``parts[length]`` lists runs of ranks as (first rank, uses per window, first
    window, offsets in the window, cut): rank r of a run is use (r - first) % uses
    of window first window + (r - first) // uses.  A cut below the length means
    that only so many ids stay there; the others are rest number
    ``after + r - first`` of length (length - cut).
    """

    def __init__(self, window: int = WINDOW):
        self.window, self.n_windows = window, 0
        self.parts: dict[int, list[tuple[int, int, int, list[int], int, int]]] = defaultdict(list)
        self.used: dict[int, int] = defaultdict(int)

    def add(self, lengths: list[int], times: int, cut: tuple[int, int, int] | None = None) -> None:
        """``times`` windows of these lengths; ``cut`` = (length, ids that stay, rank of the first remainder)."""
        offset, offsets = 0, defaultdict(list)
        for length in lengths:
            offsets[length].append(offset)
            offset += length
        for length, places in offsets.items():
            self.parts[length].append((self.used[length], len(places), self.n_windows, places, length, 0))
            self.used[length] += len(places) * times
        if cut:
            length, stay, after = cut
            self.parts[length].append((self.used[length], 1, self.n_windows, [offset], stay, after))
            self.used[length] += times
        self.n_windows += times

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """Pieces of a rest: (first id, ids, window, offset)."""
        found, at = [], 0
        while length:
            runs = self.parts[length]
            first, uses, window, places, stay, after = runs[bisect.bisect_right(runs, rank, key=lambda r: r[0]) - 1]
            turn, use = divmod(rank - first, uses)
            found.append((at, stay, window + turn, places[use]))
            at, length, rank = at + stay, length - stay, after + rank - first
        return found


def make_plan(histogram: dict[int, int], window: int = WINDOW) -> Plan:
    """How to fill windows from so many rests of each length (1 to window - 1)."""
    plan = Plan(window)
    left = {k: v for k, v in histogram.items() if v}
    total = dict(left)  # rests of each length ever made: ranks of remainders go on from here
    lengths = sorted(left)
    chosen = combinations(lengths, window)
    for combination, times in sorted(zip(chosen, repeat_counts(chosen, left)), key=lambda x: -x[1]):
        need = [(k, combination.count(k)) for k in set(combination)]
        times = min(int(times + 1e-6), *(left[k] // m for k, m in need))
        if times > 0:
            plan.add(list(combination), times)
            for k, m in need:
                left[k] -= m * times
    order = sorted(k for k, v in left.items() if v)
    while order:
        # One window of the longest rests that fit, then as many of its kind as there are.
        taken, gap = [], window
        at = len(order) - 1
        while gap and at >= 0:
            length = order[at]
            uses = min(left[length], gap // length)
            taken += [length] * uses
            gap -= uses * length
            at = min(at - 1, bisect.bisect_right(order, gap) - 1)
        need = {k: taken.count(k) for k in taken}
        times = min(left[k] // m for k, m in need.items())
        cut = None
        if gap:
            longer = [k for k in order[bisect.bisect_right(order, gap):] if left[k] > need.get(k, 0)]
            if longer:
                # The shortest that is long enough: its remainder is short and fits anywhere.
                length = longer[0]
                times = min(times, left[length] // (need.get(length, 0) + 1))
                rest = length - gap
                cut = (length, gap, total.get(rest, 0))
        plan.add(taken, times, cut)
        for k, m in need.items():
            left[k] -= m * times
        if cut:
            length, stay, _ = cut
            left[length] -= times
            rest = length - stay
            total[rest] = total.get(rest, 0) + times
            left[rest] = left.get(rest, 0) + times
        order = sorted(k for k, v in left.items() if v)
    return plan


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, window: int) -> DataFrame:
    """Ids of every document, and its number among those of its task with an equally long rest."""
    def encode(batches):
        words, block = word_tokenizer(tokenizer, end_id), TaskContext.get().partitionId()
        end, width = np.array([end_id], words.kind).tobytes(), words.kind.itemsize
        ranks, full = [0] * window, 0
        for batch in pieces(batches, BATCH_ROWS):
            ids = [coded + end for coded in words.encode_all(texts(batch["text"]))]
            rows = []
            for coded in ids:
                n = len(coded) // width
                rest = n % window
                rows.append((n, rest, ranks[rest], full))
                ranks[rest] += 1
                full += n // window
            n, rest, rank, first = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "ids": pa.array(ids, pa.binary()), "n": pa.array(n, pa.int64()),
                "rest": pa.array(rest, pa.int32()), "block": pa.array([block] * len(rows), pa.int32()),
                "rank": pa.array(rank, pa.int64()), "full": pa.array(first, pa.int64())})

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stored(plain.mapInArrow(encode, TOKENS), "packing-tokens", compression="zstd")


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW,
         then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None, columns: str = PIECES) -> DataFrame:
    """Cut and place all ids of ``docs`` (doc_id, text): one row per piece, with its ids.

    ``start`` is the piece's first id in its document, ``sequence_id`` and
    ``offset`` say where it stands.  Sequences hold exactly ``window`` ids except
    the one that is filled last.  Ids are 16 bits wide if all fit, else 32.  A
    null text is an empty document, which still has its end id; repeated rows
    are documents of their own; no rows, no pieces.

    ``then`` gets the batches of pieces where they are made and returns what is
    wanted of them, with these ``columns``: no second pass through Python.
    """
    tokens = tokenized(docs, tokenizer, end_id, window)
    counts = {r["rest"]: r["count"] for r in tokens.filter("rest > 0").groupBy("rest").count().collect()}
    plan = make_plan(counts, window)
    earlier = Window.partitionBy("rest").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (tokens.groupBy("rest", "block").agg(F.count(F.lit(1)).alias("_n"))
              .select("rest", "block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("before")))

    def place(batches):
        for batch in pieces(batches, BATCH_ROWS):
            out = {name: [] for name in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}

            def put(*values):
                for column, value in zip(out.values(), values):
                    column.append(value)

            for doc_id, ids, n, rest, block, rank, full, before in zip(*(batch[c].to_pylist() for c in batch.schema.names)):
                width = len(ids) // n
                for i in range(n // window):
                    # Full windows are numbered by task: unique without another pass.
                    put(doc_id, i * window, window, ids[i * window * width:(i + 1) * window * width], n,
                        plan.n_windows + (block << 36) + full + i, 0)
                base = n - rest
                for at, length, sequence, offset in plan.place(rest, rank + before) if rest else ():
                    put(doc_id, base + at, length, ids[(base + at) * width:(base + at + length) * width], n,
                        sequence, offset)
            yield pa.RecordBatch.from_pydict(
                {k: pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()})

    numbered = tokens.join(starts, ["rest", "block"]).select(
        "doc_id", "ids", "n", "rest", "block", "rank", "full", "before")
    return numbered.mapInArrow(place if then is None else lambda batches: then(place(batches)), columns)


def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with a checksum of their ids as 32-bit numbers instead of the ids.

    Length and bytes of a piece say how wide its ids are, so no task loads the tokenizer.
    """
    for batch in batches:
        sums = [zlib.crc32(np.frombuffer(i, f"<u{len(i) // n}").astype("<u4").tobytes())
                for i, n in zip(batch["ids"].to_pylist(), batch["length"].to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch[c] for c in batch.schema.names[:3]] + [pa.array(sums, pa.int64())]
            + [batch[c] for c in batch.schema.names[4:]],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def digests(pieces: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """The same for pieces that are there already."""
    return pieces.mapInArrow(digested, DIGESTS)


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences: the pieces' ids one after the other, and the documents they are from."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    return (pieces.groupBy("sequence_id").agg(ordered.alias("_p"))
            .select("sequence_id", F.array_join(F.transform("_p", lambda p: F.hex(p["ids"])), "").alias("_hex"),
                    F.transform("_p", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["start"].alias("start"),
                                                         p["length"].alias("length"))).alias("pieces"))
            .select("sequence_id", F.unhex("_hex").alias("ids"), "pieces"))
