import hashlib
import random
import re

import pytest

from conftest import SMALL
from rowloom.llm import decontaminate
from rowloom.llm.queries import op5_decontaminate


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        if item is None or not words:
            continue
        n = min(width, len(words))
        for i in range(len(words) - n + 1):
            windows.setdefault(tuple(words[i:i + n]), set()).add(item)
    lengths = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (own := windows.get(tuple(words[i:i + n]))):
                    found |= own
                    hit.update(range(i, i + n))
        listed = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(words), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("block_bytes", [1, 200, 1 << 20])
def test_equals_brute_force(spark, block_bytes):
    draw = random.Random(block_bytes)
    words = [f"v{i}" for i in range(40)] + ["Ünï", "A1"]
    items = [(i, " ".join(draw.choices(words, k=draw.choice([1, 2, 9, 10, 11, 40])))) for i in range(30)]
    items += [(7, "v1 v2 v3"), (None, "v4"), (55, None), (56, "!!"), (57, "")]
    docs = []
    for i in range(60):
        text = draw.choices(words, k=draw.choice([0, 5, 60, 300]))
        for _ in range(draw.choice([0, 1, 3])):
            own = draw.choice(items)[1]
            text += (own or "").split()[draw.choice([0, 0, 1]):]
        docs.append((i, draw.choice([" ", ", ", "-"]).join(text)))
    docs += [(None, "v4 v4"), (3, None), (3, ""), (4, "v1 " * 30_000)]
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_words int").repartition(4)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    assert found(decontaminate.report(decontaminate.matches(frame, bench, block_bytes=block_bytes))) == brute(docs, items)


def test_longest_matches_and_places(spark):
    item = " ".join(f"k{i}" for i in range(25))
    docs = spark.createDataFrame([(1, "x y " + item + " z"), (2, " ".join(item.split()[5:18]) + " k3"), (3, "k1 k2")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    got = {r.doc_id: [tuple(m) for m in r.matches] for r in decontaminate.matches(docs, bench).collect()}
    assert got == {1: [(9, 0, 2, 25)], 2: [(9, 5, 0, 13)], 3: []}
    assert sorted(r.doc_id for r in decontaminate.without_benchmark(docs, bench).collect()) == [3]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(decontaminate.report(decontaminate.matches(docs, none))) == brute([(1, "a b")], [])
    assert decontaminate.matches(docs.limit(0), none).collect() == []


def test_query_equals_brute_force(spark, tables):
    docs = [tuple(r) for r in tables.documents.select("doc_id", "text").collect()]
    items = [tuple(r) for r in tables.benchmark.select("item_id", "text").collect()]
    got = found(op5_decontaminate(spark, SMALL))
    assert got == brute(docs, items)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)
