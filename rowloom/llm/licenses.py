"""Licence notices in texts: set containment of known templates in blocks of text.

A block is a line; a template is contained in it as far as the template's
different words are there.  Blocks that hold at least ``share`` of a template are
found by an exact set-similarity join.  The tokens are the words of the
templates, ordered by how many documents of the corpus hold them, rarest first.
Of each template only the first |T| - ceil(share * |T|) + 1 tokens, its prefix,
are looked up: a block without any of them can't hold enough of the rest.  A block
with too few different words falls to the length filter, and one whose first
common token stands too far back in the order to the positional filter.  What
remains is counted out.

The order comes from all documents; templates are a bounded list that goes to
every task.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowloom.llm.common import ALNUM, alnum_words, pieces, texts

# Phrases whose places are counted, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Openings of well-known public licence notices, each with a label.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
#: Part of a template's words that a block must hold.
SHARE = 0.8
BATCH_ROWS = 1_000

BLOCKS = "doc_id long, block long, first_word long, label string, template int, containment double"
SCANNED = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
           "score double")


def template_sets(templates=TEMPLATES) -> list[tuple[str, frozenset[bytes]]]:
    return [(label, frozenset(alnum_words(text.encode()))) for label, text in templates]


def token_counts(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, int]:
    """In how many documents each template word is; words of no text are left out.

    As many numbers as the templates have words come to the driver.
    """
    wanted = frozenset().union(*(words for _, words in template_sets(templates)))

    def count(batches):
        found = Counter()
        for batch in pieces(batches, BATCH_ROWS):
            for text in texts(batch["text"]):
                found.update(wanted.intersection(alnum_words(text)))
        yield pa.RecordBatch.from_pydict({"token": pa.array([t.decode() for t in found], pa.string()),
                                          "n": pa.array(found.values(), pa.int64())})

    counted = docs.select(F.col("text").cast("string")).mapInArrow(count, "token string, n long")
    return {r["token"].encode(): r["n"] for r in counted.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class Index:
    """Prefixes of the templates over the global order."""

    def __init__(self, counts: dict[bytes, int], templates=TEMPLATES, share: float = SHARE):
        self.sets = template_sets(templates)
        self.vocabulary = frozenset().union(*(words for _, words in self.sets))
        self.order = {t: i for i, t in enumerate(sorted(self.vocabulary, key=lambda t: (counts.get(t, 0), t)))}
        self.ranked = [sorted(words, key=self.order.get) for _, words in self.sets]
        # The smallest whole number that is at least the share, whatever the rounding of the product.
        self.needed = [next(n for n in range(len(words) + 1) if n >= share * len(words) - 1e-9) for words in self.ranked]
        self.prefixes: dict[bytes, list[tuple[int, int]]] = {}
        for i, words in enumerate(self.ranked):
            for position, token in enumerate(words[:len(words) - self.needed[i] + 1]):
                self.prefixes.setdefault(token, []).append((i, position))

    def search(self, words: frozenset[bytes] | set[bytes]) -> list[tuple[int, float]]:
        """(template, containment) of every template that a block with these words holds enough of."""
        found, seen = [], set()
        for token in sorted(words & self.prefixes.keys(), key=self.order.get):
            for i, position in self.prefixes[token]:
                # The template's first common token decides; later ones stand further back.
                if i in seen:
                    continue
                seen.add(i)
                if len(words) < self.needed[i] or len(self.ranked[i]) - position < self.needed[i]:
                    continue
                common = len(words & self.sets[i][1])
                if common >= self.needed[i]:
                    found.append((i, common / len(self.ranked[i])))
        return found


def _blocks(text: bytes, index: Index):
    """(number, first word, template, containment) of the lines that hold a template."""
    at = 0
    for number, line in enumerate(text.translate(ALNUM_LINES).split(b"\n")):
        words = line.split()
        known = index.vocabulary.intersection(words)
        if not known.isdisjoint(index.prefixes):
            # Of the other words only their number matters, to the length filter: it can't be below that of the known.
            for template, containment in index.search(known):
                yield number, at, template, containment
        at += len(words)


#: As ALNUM, but line feeds stay.
ALNUM_LINES = bytes(10 if b == 10 else ALNUM[b] for b in range(256))


def license_blocks(docs: DataFrame, templates=TEMPLATES, share: float = SHARE) -> DataFrame:
    """Every line of every text that holds a template: its number, where its words start, and how much it holds."""
    index, labels = Index(token_counts(docs, templates), templates, share), [label for label, _ in templates]

    def scan(batches):
        for batch in pieces(batches, BATCH_ROWS):
            rows = [(d, *b) for d, t in zip(batch["doc_id"].to_pylist(), texts(batch["text"])) for b in _blocks(t, index)]
            doc, block, first, template, containment = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(doc, pa.int64()), "block": pa.array(block, pa.int64()),
                "first_word": pa.array(first, pa.int64()), "label": pa.array([labels[i] for i in template], pa.string()),
                "template": pa.array(template, pa.int32()), "containment": pa.array(containment, pa.float64())})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scan, BLOCKS)


def _places(words: list[bytes], phrases: list[tuple[list[bytes], str]]):
    """(start, label) of every phrase, overlaps included."""
    for phrase, label in phrases:
        at, last = -1, phrase[-1]
        try:
            while True:
                at = words.index(last, at + 1)
                start = at - len(phrase) + 1
                if start >= 0 and words[start:at + 1] == phrase:
                    yield start, label
        except ValueError:
            pass


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=TEMPLATES, share: float = SHARE) -> DataFrame:
    """One row per document: places of the phrases, labels of phrases and templates, and the best containment.

    ``score`` is 1 where a phrase stands, else the largest containment of a template that
    reaches ``share``, else 0.  Null and empty texts have no words and no labels;
    repeated rows are judged one by one.
    """
    index, labels = Index(token_counts(docs, templates), templates, share), [label for label, _ in templates]
    split = [([w.encode() for w in p.split()], label) for p, label in phrases.items()]

    def rows(batches):
        for batch in pieces(batches, BATCH_ROWS):
            out = {name: [] for name in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")}
            for text in texts(batch["text"]):
                words = alnum_words(text)
                places = list(_places(words, split)) if split else []
                blocks = [(labels[i], c) for _, _, i, c in _blocks(text, index)]
                base = {label for _, label in places}
                starts = [s for s, _ in places]
                for column, value in zip(out.values(), (
                        len(words), len(places), min(starts, default=None), max(starts, default=None),
                        ",".join(sorted(base)), ",".join(sorted(base.union(b for b, _ in blocks))),
                        1.0 if places else max((c for _, c in blocks), default=0.0))):
                    column.append(value)
            kinds = dict.fromkeys(out, pa.int64()) | {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"]} | {k: pa.array(v, kinds[k]) for k, v in out.items()})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, SCANNED)


