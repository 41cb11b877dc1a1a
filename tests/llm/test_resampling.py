"""Checksums of runs from prefixes, and the draw against plain Python."""

import hashlib
import math
import random
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from rowloom.llm import resampling
from rowloom.llm.common import alnum_words, table

R = random.Random(5)
WORDS = [b"a", b"of", "é".encode(), b"word", b"x" * 254, b"y" * 255, b"z" * 256, b"long" * 5_000]


def test_shift_is_zero_bytes():
    for n in (0, 1, 2, 3, 7, 255, 256, 257, 511, 4096, 70_001):
        crc = np.array([crc32(b"head"), crc32(b"other"), 0, 2**32 - 1], np.uint32)
        tail = bytes(R.randrange(256) for _ in range(n))
        got = resampling.SHIFT(crc[:2], np.array([n, n])) ^ np.uint32(crc32(tail))
        assert got.tolist() == [crc32(b"head" + tail), crc32(b"other" + tail)]


@pytest.mark.parametrize("width, chunk", [(1, 1 << 19), (1, 3), (3, 1 << 19), (3, 1), (3, 4), (5, 2)])
def test_runs_from_prefixes(width, chunk):
    docs = [[], [b"one"], [R.choice(WORDS) for _ in range(30)], [], [b"a", b"of", b"a", b"of"], [b"long" * 5_000] * 3]
    sizes = [[len(w) for w in d] for d in docs]
    batch = pa.RecordBatch.from_pydict({
        "n_words": pa.array([len(d) for d in docs], pa.int64()),
        "ends": pa.array([resampling.running(d).tobytes() for d in docs], pa.binary()),
        "lengths": pa.array([bytes(min(s, 255) for s in own) for own in sizes], pa.binary()),
        "long_words": pa.array([[s for s in own if s >= 255] for own in sizes], pa.list_(pa.int64()))})
    got = sorted((int(o), int(c)) for owner, crc in resampling.features(batch, width, chunk) for o, c in zip(owner, crc))
    want = sorted((d, crc32(b" ".join(words[i:i + n]))) for d, words in enumerate(docs)
                  for n in range(1, width + 1) for i in range(len(words) - n + 1))
    assert got == want


def test_long_texts_are_scanned_in_slices():
    text = b"Some words-of a text  " * 120_000
    crcs, sizes = resampling.scan_text(text)
    words = alnum_words(text)
    assert sizes.tolist() == [len(w) for w in words] and len(text) > 2 << 20
    assert crcs[-1] == crc32(b" ".join(words)) and crcs[300_000] == crc32(b" ".join(words[:300_001]))
    assert [a.tolist() for a in resampling.scan_text(b" - ")] == [[], []]


def plain(docs, target, width, buckets, percent, least):
    def runs(text):
        w = alnum_words((text or "").encode())
        return len(w), [crc32(b" ".join(w[i:i + n])) % buckets for n in range(1, width + 1) for i in range(len(w) - n + 1)]
    rows = [(d, *runs(t)) for d, t in docs]
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, lists in ((s, [f for *_, f in rows]), (t, [runs(x)[1] for x in target])):
        for found in lists:
            for b in found:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    scored = []
    for d, n, found in rows:
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        scored.append((d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n))
    order = sorted((i for i, r in enumerate(scored) if r[4] >= least), key=lambda i: (-scored[i][3], scored[i][0] is None, scored[i][0] or 0))
    rank = {i: k for k, i in enumerate(order[:len(order) * percent // 100], 1)}
    return sorted(((*r[:4], rank.get(i)) for i, r in enumerate(scored)), key=str)


def made(n=300):
    words = [f"w{i}" for i in range(40)]
    docs = [(i if i % 11 else None, " ".join(R.choices(words, k=R.randrange(0, 60)))) for i in range(n)]
    docs += [(7, "Same  words-here, "), (7, "Same  words-here, "), (8, ""), (9, None), (10, "long" * 3_000 + " tail of it")]
    return docs, [" ".join(R.choices(words[:9], k=50)) for _ in range(5)] + [None, ""]


@pytest.mark.parametrize("width, percent, least", [(1, 10, 20), (3, 35, 1), (2, 0, 1), (1, 100, 3)])
def test_draw_against_plain(spark, width, percent, least):
    docs, target = made()
    got = resampling.resample(spark.createDataFrame(docs, "doc_id int, text string").withColumn("score", F.lit("own")),
                              spark.createDataFrame([(t, 1) for t in target], "text string, n int"),
                              width, 97, 2024, percent, least)
    rows = sorted(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)
    want = plain(docs, target, width, 97, percent, least)
    # Rows with null or equal doc_ids and scores may take each other's ranks.
    assert [r[:4] for r in rows] == [r[:4] for r in want]
    assert sorted((r[4], r[3]) for r in rows if r[4]) == sorted((r[4], r[3]) for r in want if r[4])
    assert {r for r in rows if r[0] is not None and r[0] != 7} == {r for r in want if r[0] is not None and r[0] != 7}


def test_many_ties_are_ranked_in_slices(spark, monkeypatch):
    import functools
    monkeypatch.setattr(resampling, "global_row_number", functools.partial(resampling.global_row_number, max_rows=50))
    docs = spark.range(3_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(1).alias("doc_id"),
                                     F.lit("the same five words here").alias("text"))
    got = resampling.resample(docs, docs.limit(0), 1, 50, 2024, 60, 5).collect()
    drawn = sorted((r["rank"], -r["score"]) for r in got if r["rank"])
    assert [r for r, _ in drawn] == list(range(1, 1801)) and [s for _, s in drawn] == sorted(s for _, s in drawn)
    assert len(got) == 3_000


def test_empty_tables(spark):
    docs, target = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    assert resampling.resample(docs.limit(0), target).collect() == []
    found = resampling.resample(docs, target.limit(0)).collect()
    enough = [r for r in found if r["n_features"] >= 20]
    assert len(found) == docs.count() and sorted(r["rank"] for r in found if r["rank"]) == list(range(1, len(enough) // 10 + 1))
    only = spark.createDataFrame([(None, None)], "doc_id long, text string")
    assert [tuple(r)[:3] for r in resampling.resample(only, target).collect()] == [(None, 0, 0)]
