import numpy as np
import pytest

from conftest import SMALL
from rowloom.llm import neighbours
from rowloom.llm.queries import op1_neighbours

SCHEMA = "vec_id long, embedding array<double>, rank int, score string"


def brute(rows, queries, k):
    points = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, v in sorted(points):
        if q not in queries:
            continue
        found = sorted((-float((np.array(v) * np.array(w)).sum()), i) for i, w in points if i != q and len(w) == len(v))
        out[q] = [(i, -s) for s, i in found[:k]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def search(spark, rows, queries, k=20, shard_rows=2048, **options):
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA).repartition(3)
    index, n = neighbours.build_index(df, shard_rows)
    return answers(neighbours.nearest(index, n, df.filter(df["vec_id"].isin(*queries)), k=k, **options))


@pytest.mark.parametrize("shard_rows, unit", [(2048, True), (200, False)])
def test_recall(spark, shard_rows, unit):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(1_500, 24)) * (1 if unit else draw.uniform(0.2, 3, size=(1_500, 1)))
    if unit:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    queries = list(range(0, 1_500, 20))
    got, want = search(spark, rows, queries, shard_rows=shard_rows, query_rows=30), brute(rows, queries, 20)
    assert got.keys() == want.keys()
    right = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in queries)
    assert right >= 0.95 * 20 * len(queries)
    for q in queries:
        exact = {i: s for i, s in brute(rows, [q], 1_500)[q]}
        assert all(s == pytest.approx(exact[i], abs=1e-12) for i, s in got[q])
        assert got[q] == sorted(got[q], key=lambda r: (-r[1], r[0]))


def test_few_and_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
            (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (10, [-1.0, 0.0]),
            (1, [0.5, 0.5]), (20, [3.0, 0.0, 1.0])]
    got = search(spark, rows, [0, 1, 3, 5, 9, 20])
    assert got == brute(rows, [0, 1, 3, 5, 9, 20], 20)
    assert [i for i, _ in got[0]] == [1, 2, 10]


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 1.0, 0.0]) for i in range(300)] + [(300 + i, [0.0, 1.0, float(i + 1)]) for i in range(50)]
    got = search(spark, rows, [0, 320], shard_rows=100)
    assert all(s == pytest.approx(2.0) for _, s in got[0][:20]) or got[0][0][0] >= 300
    assert len(got[320]) == 20 and got[320][0][0] == 349


def test_no_rows(spark):
    assert search(spark, [], [0]) == {}


def test_query_finds_the_nearest(spark, tables):
    rows = [tuple(r) for r in tables.embeddings.select("vec_id", "embedding").collect()]
    want = brute(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    got = answers(op1_neighbours(spark, SMALL))
    assert got.keys() == want.keys()
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.98 * 20 * len(want)
