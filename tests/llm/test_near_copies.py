import random
import re
from collections import defaultdict

import pytest

from conftest import SMALL
from rowloom.llm import near_copies
from rowloom.llm.queries import op10_near_copies


def brute(rows, share=85):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = min(4, len(words))
        sets.append({tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set())
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in enumerate(sets):
        near = {j for g in s for j in holders[g] if j < i}
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= share * (len(s) + len(sets[j]) - both):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    names = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[top(i)].append(doc_id)
    return sorted(((d, len(s), min(names[top(i)], default=None)) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def made_up(seed, n=400):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(3_000)]
    passage = draw.choices(words, k=30)
    rows = []
    for i in range(n):
        if rows and draw.random() < 0.6:
            text = draw.choice(rows[-40:])[1].split(" ")
            for _ in range(draw.choice([0, 1, 1, 2, 5])):
                text[draw.randrange(len(text))] = draw.choice(words)
        else:
            text = draw.choices(words, k=draw.choice([1, 3, 4, 5, 30, 120, 300]))
            if draw.random() < 0.5:
                text += passage
        rows.append((draw.randrange(10_000), " ".join(text)))
    return rows


@pytest.mark.parametrize("seed, group_rows, hits", [(1, 512, 12), (2, 3, 12), (3, 1, 10**9), (4, 512, 2)])
def test_equals_brute_force(spark, monkeypatch, seed, group_rows, hits):
    monkeypatch.setattr(near_copies, "SAMPLE_HITS", hits)
    monkeypatch.setattr(near_copies, "ASKERS", 5)
    rows = made_up(seed)
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, vertex int, tokens string").repartition(5)
    assert found(near_copies.group_copies(docs, group_rows=group_rows)) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c"), (7, "x " * 40_000), (7, "x " * 40_000),
            (None, "same words in both"), (None, "same words in both"), (9, "a b"), (None, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_copies.group_copies(docs)) == brute(rows)


def test_a_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(500 - i, " ".join(words[i:i + 200])) for i in range(0, 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(near_copies.group_copies(docs, group_rows=2))
    assert got == brute(rows) and len({c for *_, c in got}) == 1


def test_no_rows(spark):
    assert near_copies.group_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_equals_brute_force(spark, tables):
    rows = [tuple(r) for r in tables.documents.select("doc_id", "text").collect()]
    assert found(op10_near_copies(spark, SMALL)) == brute(rows)
