import re

import pytest

from conftest import SMALL
from rowloom.llm import licenses
from rowloom.llm.queries import op9_licenses


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, share=0.8):
    out = []
    for doc_id, text in rows:
        words, places = words_of(text), []
        for phrase, label in licenses.PHRASES.items():
            own = phrase.split()
            places += [(i, label) for i in range(len(words) - len(own) + 1) if words[i:i + len(own)] == own]
        best = []
        for line in (text or "").split("\n"):
            have = set(words_of(line))
            for label, template in licenses.TEMPLATES:
                own = set(words_of(template))
                if len(own & have) >= share * len(own) - 1e-9:
                    best.append((label, len(own & have) / len(own)))
        base = {label for _, label in places}
        starts = [s for s, _ in places]
        out.append((doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted(base)), ",".join(sorted(base | {b for b, _ in best})),
                    1.0 if places else max((c for _, c in best), default=0.0)))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


ROWS = [(1, None), (2, ""), (3, "MIT License, mit license MIT"), (4, "the GNU General Public\nLicense here"),
        (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of software and associated files"),
        (6, "intro\nThis Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.\nend"),
        (6, "Released under the License"), (None, "apache license " * 20_000), (8, "mit mit license"),
        (9, "free software library; you can redistribute it and or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation This")]


def test_equals_brute_force(spark):
    docs = spark.createDataFrame([(d, t, 5) for d, t in ROWS], "doc_id long, text string, labels int").repartition(3)
    assert found(licenses.scan(docs)) == brute(ROWS)
    blocks = {(r.doc_id, r.block, r.label) for r in licenses.license_blocks(docs).collect()}
    assert (6, 1, "mpl") in blocks and (5, 0, "mit") in blocks


@pytest.mark.parametrize("share", [0.3, 0.5, 1.0])
def test_filters_lose_nothing(share):
    texts = [w for _, t in ROWS if t for w in t.split("\n")] + [t for _, t in licenses.TEMPLATES]
    index = licenses.Index({b"license": 9, b"the": 50, b"public": 3}, share=share)
    for text in texts:
        have = frozenset(licenses.alnum_words(text.encode()))
        want = [(i, len(have & own) / len(own)) for i, (_, own) in enumerate(index.sets)
                if len(have & own) >= share * len(own) - 1e-9]
        assert sorted(index.search(have)) == want


def test_no_rows(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_equals_brute_force(spark, tables):
    rows = [tuple(r) for r in tables.documents.select("doc_id", "text").collect()]
    got = found(op9_licenses(spark, SMALL))
    assert got == brute(rows)
    assert any(r[2] for r in got)
