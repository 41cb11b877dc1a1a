import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import SMALL
from rowloom.llm import shards
from rowloom.llm.queries import op7_shards


def check(rows, got, n):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(d), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[j]) for j in range(n)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1


def cut(got):
    places = defaultdict(set)
    for r in got:
        places[r.text_crc32, r.size].add(r.shard)
    return sum(len(p) > 1 for p in places.values())


@pytest.mark.parametrize("copies, n", [(3, 8), (30, 8), (1, 8)])
def test_even_and_together(spark, copies, n):
    rows = [(i, f"text {i // copies}") for i in range(960)]
    docs = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], "doc_id long, text string, law string, shard int").repartition(4)
    got = shards.place(docs, n).collect()
    check(rows, got, n)
    # Every document is linked: only exchanges and ends of shards can cut a group.
    assert cut(got) <= 960 // max(copies, 1) * 0.35 + n


def test_one_text_is_most_of_the_table(spark):
    rows = [(i, "hot" if i % 3 else f"own {i}") for i in range(900)]
    got = shards.place(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    check(rows, got, 10)


def test_odd_rows(spark):
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, "ä" * 100_000), (5, "ä" * 100_000), (None, "x"), (None, "x")]
    got = shards.place(spark.createDataFrame(rows, "doc_id long, text string"), 40).collect()
    check(rows, got, 40)
    assert shards.place(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_grants_keep_to_the_quota():
    draw = np.random.default_rng(3)
    for _ in range(30):
        flow = draw.integers(0, 9, (6, 6, 4))
        flow[np.arange(6), np.arange(6)] = 0
        load = flow.sum((1, 2)) + draw.integers(0, 30, 6)
        quota = load + draw.integers(0, 10, 6)
        bins = shards.granted(flow, load, quota)
        moved = np.where(np.arange(4) < bins[:, :, None], flow, 0).sum(2)
        assert (load + moved.sum(0) - moved.sum(1) <= quota).all()


def test_query_keeps_copies_together(spark, tables):
    rows = [tuple(r) for r in tables.documents.select("doc_id", "text").collect()]
    got = op7_shards(spark, SMALL).collect()
    check(rows, got, 40)
    groups = sum(c > 1 for c in Counter(t for _, t in rows).values())
    assert cut(got) <= 0.2 * groups + 1


def test_groups_that_fit_into_half_a_shard_stay_whole(spark, monkeypatch):
    """However many rows one task looks up: 60 of 480 rows a shard are far from half of it."""
    monkeypatch.setattr(shards, "MOST_ROWS", 5)
    rows = [(i, f"text {i // 60}" if i < 960 else f"own {i}") for i in range(3_840)]
    got = shards.place(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 8).collect()
    check(rows, got, 8)
    assert cut(got) <= 2
