"""Importance resampling towards a target distribution, from prefix checksums.

A document is its words with one space between them.  It is scanned once: the
CRC-32 of the text up to the end of each word is stored, with the length of the
word, in a written table; all later steps read that and no text.  A CRC is
linear over GF(2), so the one of the words i to j needs no bytes:

    crc(words i..j) = crc(text up to j) xor shift(crc(text before i), bytes of the words)

where ``shift`` is what appending that many zero bytes does to a remainder: a
product of matrices for powers of two, or one table for shifts of under 256 bytes.

Each run of 1 to ``width`` words is a feature and falls into a bucket by its
CRC.  A bucket's gain is the logarithm of its share in the target over its share
in the documents.  A document's weight is the mean gain of its features, and
Gumbel noise from a hash of its doc_id turns the highest scores into a sample
without replacement.

Counts come back as at most ``buckets`` numbers per task, are summed up by Spark,
and the table of gains, ``buckets`` numbers, goes to the tasks.  Scores lie
within about 200,000 whole numbers, as no count passes 2^63, so their histogram is
small at any size and shows the lowest score that can be drawn; only documents
from there on are put in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.llm.common import ALNUM, scratch, stored, texts, word_slices
from rowloom.operators.windows import global_row_number

POLYNOMIAL = 0xEDB88320
SCANNED = "doc_id long, n_words long, ends binary, lengths binary, long_words array<long>"
#: Words that are looked at together, and the length from which a word's is kept in a list of its own.
CHUNK, LONG = 1 << 19, 255


def _zero_byte() -> np.ndarray:
    """What one zero byte makes of each byte of a remainder: 4 x 256 numbers."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), t >> np.uint32(1))
    rest = [np.arange(256, dtype=np.uint32) << np.uint32(8 * (k - 1)) for k in (1, 2, 3)]
    return np.stack([t, *rest])


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24])


ZERO_BYTE = _zero_byte()


class Shift:
    """Appends any number of zero bytes to remainders."""

    def __init__(self):
        self.powers = [ZERO_BYTE]
        short = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
        for _ in range(255):
            short.append(_apply(ZERO_BYTE, short[-1]))
        self.short = np.stack(short, axis=1).reshape(4, -1)  # by byte, then (shift, value)
        while len(self.powers) < 63:
            self.powers.append(_apply(self.powers[-1], self.powers[-1]))

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        at = (n & 255) << 8
        done = self.short[0][at | (crc & 255)]
        for k in (1, 2, 3):
            done ^= self.short[k][at | ((crc >> np.uint32(8 * k)) & 255)]
        bit = 8
        rest = np.flatnonzero(n >> bit)
        while len(rest):
            moved = rest[(n[rest] >> bit) & 1 == 1]
            done[moved] = _apply(self.powers[bit], done[moved])
            bit += 1
            rest = rest[n[rest] >> bit > 0]
        return done


SHIFT = Shift()


def running(words: list[bytes], before: int = 0) -> np.ndarray:
    """CRC of the words so far, joined by spaces, at the end of each word; ``before`` is that of the text in front of them."""
    crc, ends = before, []
    for word in words:
        crc = crc32(word, crc)
        ends.append(crc)
        crc = crc32(b" ", crc)
    return np.array(ends, np.uint32)


def scan_text(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Running CRCs and lengths of all words of a text."""
    crcs, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    crc = 0
    for words in word_slices(text.translate(ALNUM)):
        if words:
            crcs.append(running(words, crc))
            sizes.append(np.fromiter(map(len, words), np.int64, len(words)))
            crc = crc32(b" ", int(crcs[-1][-1]))
    return np.concatenate(crcs), np.concatenate(sizes)


def scan(docs: DataFrame) -> DataFrame:
    """Per row its doc_id, number of words, running CRCs and lengths of words (``SCANNED``)."""
    def read(batches):
        for batch in batches:
            counts, ends, lengths, long = [], [], [], []
            for text in texts(batch["text"]):
                crcs, size = scan_text(text)
                counts.append(len(size))
                ends.append(crcs.tobytes())
                lengths.append(np.minimum(size, LONG).astype(np.uint8).tobytes())
                long.append(size[size >= LONG].tolist())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "n_words": pa.array(counts, pa.int64()), "ends": pa.array(ends, pa.binary()),
                "lengths": pa.array(lengths, pa.binary()), "long_words": pa.array(long, pa.list_(pa.int64()))})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(read, SCANNED)


def features(batch: pa.RecordBatch, width: int, chunk: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of the batch, CRC) of every run of 1 to ``width`` words of scanned rows, ``chunk`` first words at a time."""
    counts = batch["n_words"].to_numpy().astype(np.int64)
    ends = np.frombuffer(b"".join(batch["ends"].to_pylist()), "<u4")
    lengths = np.frombuffer(b"".join(batch["lengths"].to_pylist()), np.uint8)
    long = np.flatnonzero(lengths == LONG)
    true_long = batch["long_words"].flatten().to_numpy().astype(np.int64)
    stop = np.cumsum(counts)
    first = stop - counts
    for a in range(0, len(ends), chunk):
        b = min(a + chunk, len(ends))
        upto = min(b + width - 1, len(ends))
        owner = np.searchsorted(stop, np.arange(a, b), side="right")
        # The text before a word is the text up to the one before it, and a space.
        register = ~(ends[a - 1:b - 1] if a else np.concatenate((ends[:1], ends[:b - 1])))
        before = ~(ZERO_BYTE[0][(register ^ np.uint32(32)) & 255] ^ (register >> np.uint32(8)))
        before[np.arange(a, b) == first[owner]] = 0
        size = lengths[a:upto].astype(np.int64)
        lo, hi = np.searchsorted(long, (a, upto))
        size[long[lo:hi] - a] = true_long[lo:hi]
        place = np.concatenate(([0], np.cumsum(size)))
        for n in range(1, width + 1):
            i = np.flatnonzero(np.arange(a, b) + n <= stop[owner])
            n_bytes = place[i + n] - place[i] + (n - 1)
            yield owner[i], ends[a + i + n - 1] ^ SHIFT(before[i], n_bytes)


def bucket_counts(scanned: DataFrame, width: int, buckets: int) -> DataFrame:
    """Features per bucket: (bucket, n), summed up per task and then over all tasks."""
    def count(batches):
        found = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, crc in features(batch, width):
                found += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int64()), "n": pa.array(found[used])})

    return scanned.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) of all buckets: 1000 times the logarithm of the target's share over the source's, floored."""
    def of(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("double")

    def total(counts: DataFrame) -> Column:
        return F.coalesce(counts.agg(F.sum("n")).scalar(), F.lit(0)).cast("double") + F.lit(float(buckets))

    both = (source.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
            .join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left"))
    ratio = (of("t") + 1) * total(source) / ((of("s") + 1) * total(target))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.ln(ratio)).cast("long").alias("gain"))


def weigh(scanned: DataFrame, gains: DataFrame, width: int, buckets: int) -> DataFrame:
    """doc_id, n_words, n_features and weight, the floored mean gain, of every scanned row."""
    table = np.zeros(buckets, np.int64)
    for row in gains.collect():  # ``buckets`` rows
        table[row["bucket"]] = row["gain"]

    def add_up(batches):
        for batch in batches:
            sums, counts = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for owner, crc in features(batch, width):
                # Whole numbers far below 2^53, so sums in doubles are exact.
                sums += np.bincount(owner, table[crc % np.uint32(buckets)], batch.num_rows).astype(np.int64)
                counts += np.bincount(owner, minlength=batch.num_rows)
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "n_words": batch["n_words"],
                                              "n_features": pa.array(counts), "weight": pa.array(sums // np.maximum(counts, 1))})

    return scanned.mapInArrow(add_up, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """1000 times Gumbel noise from the doc_id, floored; a null doc_id is hashed as an empty one."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(u))).cast("long")


def lowest_drawn(scores: DataFrame, percent: int) -> tuple[int, int | None]:
    """How many of ``scores`` (score) are drawn, and the score that the last one has; None if there is none."""
    take = scores.count() * percent // 100
    if take == 0:
        return 0, None
    counts = scores.groupBy("score").agg(F.count(F.lit(1)).alias("n"))  # at most some 200,000 rows
    upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)))
    return take, upto.filter(F.col("upto") >= take).agg(F.max("score")).first()[0]


def resample(docs: DataFrame, target: DataFrame, width: int = 1, buckets: int = 10_000, seed: int = 2024,
             percent: int = 10, least_words: int = 20) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs`` (doc_id, text); ``target`` has a text.

    ``rank`` numbers the floor of ``percent`` hundredths of the rows with
    ``least_words`` words or more that have the highest scores, ties to the smaller doc_id
    (null last, then any order); it is null for all others.  Null texts have no words,
    rows without words weigh 0 and are not drawn.  Rows are judged one by one:
    those with equal doc_ids have equal noise and may be drawn together.  Without
    target texts all gains come from the documents alone; no rows give no rows.
    """
    spark = docs.sparkSession
    with scratch(spark) as own:
        scanned = stored(scan(docs), "resampling-crcs")
        aimed = scan(target.select(F.lit(None).cast("long").alias("doc_id"), "text"))
        # ``buckets`` rows each; every total is taken from them too.
        counts = [stored(bucket_counts(of, width, buckets), "resampling-counts") for of in (scanned, aimed)]
        weighed = weigh(scanned, bucket_gains(*counts, buckets), width, buckets)
        scores = own.hand_over(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
                               .withColumn("_row", F.monotonically_increasing_id()), "resampling-scores")
    enough = F.col("n_words") >= least_words
    take, cut = lowest_drawn(scores.filter(enough).select("score"), percent)
    shown = ["doc_id", "n_features", "weight", "score"]
    if cut is None:
        return scores.select(*shown, F.lit(None).cast("long").alias("rank"))
    may = enough & (F.col("score") >= cut)
    placed = global_row_number(
        scores.filter(may).withColumn("_at", F.struct(-F.col("score"), F.col("doc_id").isNull(), F.col("doc_id"))), "_at", "_row", "rank")
    drawn = F.when(F.col("rank") <= take, F.col("rank"))
    return (placed.select(*shown, drawn.alias("rank"))
            .unionByName(scores.filter(~may).select(*shown, F.lit(None).cast("long").alias("rank"))))
