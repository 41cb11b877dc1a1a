"""Benchmark passages in training texts, found by binary search in suffix arrays.

Each Arrow batch of documents is a shard.  Its task sorts the shard's suffixes
(places where a text reads on) and looks up every benchmark suffix by binary
search, so it gets all places that share a stretch of words with an item and the
longest verbatim match of each.  A document lies in one shard, so the results of
shards are simply put together: no shuffle, and nothing grows but the number of
shards.

The array is sparse without loss.  Words that no item has become 0, and a suffix
is kept only if as many known words follow as the shortest searched stretch has;
any other suffix can't begin a match.  Suffixes are compared by their first
``width`` words, the longest searched stretch, and matches are then extended word
by word.

Benchmark words go to the tasks in blocks of a fixed size.  A task holds one block
at a time; Spark keeps the others on disk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from rowloom.llm.common import alnum_words, passing, pieces, texts

WIDTH = 10
#: UTF-8 bytes of benchmark texts in a block.
BLOCK_BYTES = 8 << 20
SHARD_ROWS = 2_000

HITS = ("doc_id long, n_words long, n_hit long, items array<long>, "
        "matches array<struct<item_id:long,item_start:long,doc_start:long,length:long>>")


MATCHES = pa.list_(pa.struct([(name, pa.int64()) for name in ("item_id", "item_start", "doc_start", "length")]))


class Items:
    """Benchmark items as numbers: vocabulary, words one after the other, and where items start."""

    def __init__(self, rows: list[tuple[int, str | None]], width: int):
        split = sorted((item, alnum_words(text.encode("utf-8", "replace"))) for item, text in rows
                       if text and item is not None)
        split = [(item, words) for item, words in split if words]
        self.width = width
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for _, words in split for w in words}))}
        self.ids = np.array([item for item, _ in split], np.int64)
        self.lengths = np.array([len(words) for _, words in split], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths + 1)))[:-1]
        # A 0 after each item ends every match.
        self.words = np.array([self.vocabulary[w] if w else 0 for _, words in split for w in (*words, b"")], np.int32)
        self.owner = np.repeat(np.arange(len(split)), self.lengths + 1)
        #: Every window: its place in ``words``, and its length.
        self.windows = [(s + i, min(n, width)) for s, n in zip(self.starts.tolist(), self.lengths.tolist())
                        for i in range(max(1, n - width + 1))]
        self.shortest = int(min(width, self.lengths.min())) if len(split) else 0


def ahead(words: np.ndarray) -> np.ndarray:
    """How many known words follow from each place on, itself included."""
    n = len(words)
    stop = np.where(words == 0, np.arange(n), n)
    return np.minimum.accumulate(stop[::-1])[::-1] - np.arange(n)


def first_words(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` words from each place, as byte strings that sort as the words do; 0 from the first 0 on."""
    padded = np.concatenate((words, np.zeros(width, words.dtype)))
    rows = padded[at[:, None] + np.arange(width)]
    rows = np.where(np.cumsum(rows == 0, axis=1) > 0, 0, rows)
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * width}").ravel()


def shard_matches(words: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in the shard, place among the items, window length) of every occurrence of a window."""
    none = np.empty(0, np.int64)
    if not items.windows:
        return none, none, none
    at = np.flatnonzero(ahead(words) >= items.shortest)
    if not len(at):
        return none, none, none
    suffixes = first_words(words, at, items.width)
    order = np.argsort(suffixes, kind="stable")
    array, sorted_suffixes = at[order], suffixes[order]
    windows = np.array(items.windows, np.int64)
    wanted = first_words(items.words, windows[:, 0], items.width).view(np.uint8).reshape(len(windows), -1)
    # The suffixes that begin with a window stand between it, filled up with 0, and it, filled up with 255.
    tail = np.arange(wanted.shape[1]) >= 4 * windows[:, 1:]
    low = np.ascontiguousarray(np.where(tail, 0, wanted).astype(np.uint8)).view(suffixes.dtype).ravel()
    high = np.ascontiguousarray(np.where(tail, 255, wanted).astype(np.uint8)).view(suffixes.dtype).ravel()
    left, right = np.searchsorted(sorted_suffixes, low, "left"), np.searchsorted(sorted_suffixes, high, "right")
    found = np.maximum(right - left, 0)
    number = np.repeat(np.arange(len(windows)), found)
    inside = np.arange(len(number)) - np.repeat(np.cumsum(found) - found, found)
    return array[left[number] + inside], windows[number, 0], windows[number, 1]


def longest(words: np.ndarray, place: np.ndarray, item_place: np.ndarray, length: np.ndarray,
            items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences that can't be extended to the left, extended to the right as far as they go."""
    before = np.where((place > 0) & (item_place > 0), words[np.maximum(place - 1, 0)], 0)
    # Going on from a window one word earlier: that one is the longer match.
    inner = (before != 0) & (before == items.words[np.maximum(item_place - 1, 0)])
    place, item_place, length = place[~inner], item_place[~inner], length[~inner].copy()
    padded = np.concatenate((words, [0]))
    active = np.arange(len(place))
    while len(active):
        a = padded[np.minimum(place[active] + length[active], len(words))]
        b = items.words[item_place[active] + length[active]]
        active = active[(a == b) & (a != 0)]
        length[active] += 1
    return place, item_place, length


def benchmark_blocks(benchmark: DataFrame, width: int, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    rows, held = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        rows.append(tuple(row))
        held += len((row[1] or "").encode("utf-8", "replace"))
        if held >= block_bytes:
            yield Items(rows, width)
            rows, held = [], 0
    yield Items(rows, width)


def matches(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: its words, those inside benchmark windows, the items, and the longest matches.

    A window is ``width`` consecutive words of an item, or the whole of a shorter
    one.  Null or wordless texts have no words and no hits; null item_ids and
    wordless items match nothing; rows with equal ids are documents or items of
    their own; an empty benchmark leaves all documents clean.
    """
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(searcher(benchmark, width, block_bytes), HITS)


def searcher(benchmark: DataFrame, width: int, block_bytes: int = BLOCK_BYTES):
    """What ``matches`` does with batches of (doc_id, text)."""
    context = benchmark.sparkSession.sparkContext
    blocks = [context.broadcast(b) for b in benchmark_blocks(benchmark, width, block_bytes)]

    def search(batches):
        for batch in pieces(batches, SHARD_ROWS):
            split = [alnum_words(t) for t in texts(batch["text"])]
            starts = np.concatenate(([0], np.cumsum([len(s) + 1 for s in split]))).astype(np.int64)
            owner = np.repeat(np.arange(len(split)), np.diff(starts))
            covered = np.zeros(int(starts[-1]) + 1, np.int64)
            found_items: dict[int, set[int]] = {}
            found: dict[int, list[Row]] = {}
            for block in blocks:
                items = block.value
                known = items.vocabulary.get
                words = np.array([known(w, 0) for s in split for w in (*s, b"")], np.int32)
                place, item_place, length = shard_matches(words, items)
                np.add.at(covered, place, 1)
                np.add.at(covered, place + length, -1)
                hit = np.unique(np.stack((owner[place], items.ids[items.owner[item_place]])), axis=1)
                for d, i in hit.T.tolist():
                    found_items.setdefault(d, set()).add(i)
                for p, q, n in zip(*(x.tolist() for x in longest(words, place, item_place, length, items))):
                    d, i = int(owner[p]), int(items.owner[q])
                    found.setdefault(d, []).append({"item_id": int(items.ids[i]), "item_start": q - int(items.starts[i]),
                                                    "doc_start": p - int(starts[d]), "length": n})
                if len(blocks) > 1:
                    vars(block).pop("_value", None)  # what the task has loaded of it
            hits = np.concatenate(([0], np.cumsum(np.cumsum(covered[:-1]) > 0)))
            n = len(split)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "n_words": pa.array([len(s) for s in split], pa.int64()),
                "n_hit": pa.array(hits[starts[1:]] - hits[starts[:-1]], pa.int64()),
                "items": pa.array([sorted(found_items.get(d, ()), key=str) for d in range(n)], pa.list_(pa.int64())),
                "matches": pa.array([found.get(d, []) for d in range(n)], MATCHES)})

    return search


def report(found: DataFrame) -> DataFrame:
    """Counts and a checksum of the items instead of the lists."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.col("items").cast("array<string>"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` without the documents that hold a window, all columns as they are, whatever their names.

    Rows are judged one by one in the pass that reads them, whatever their doc_ids.
    """
    return passing(docs, searcher(benchmark, width), lambda found: found["n_hit"].to_numpy() == 0, SHARD_ROWS)
