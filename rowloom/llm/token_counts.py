"""Token counts of whole texts: batches of about equal bytes inside Arrow functions, lengths only.

Spark deals the rows out as the files lie; nothing is shuffled.  A task works
through its texts in batches of ``BATCH_BYTES``: several short texts, or part of a
long one.  Long texts are cut at places that no token can span, so the counts
of the parts add up to that of the whole text.  What comes back is a number per
text, never the ids.

* A SentencePiece model writes every space as its mark and puts one more in
  front of the text.  If none of its pieces has a mark behind another character, no
  merge spans a space that follows one.  Such a space is cut away: the mark that the model
  puts in front of the right part stands for it.  The texts of a batch are cut
  at all these spaces, and each different run is encoded once and its count remembered.
* Other tokenizers are cut between two letters with one space between them, and the
  space stays with the right part, provided that a probe text gives the same
  ids whole and cut, and that no added token holds a space.  Else texts stay whole.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rowloom.llm.common import Memo, texts

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes of text in one batch, and of the longest run whose count is remembered.
BATCH_BYTES, REMEMBERED_BYTES = 1 << 20, 48
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
MARK = "▁"
PROBE = "The ending of a word, its 12 marks  and é lines\n are x y cut A B, don't they? " * 3


def parts(text: bytes, boundary: re.Pattern | None, size: int) -> Iterator[bytes]:
    """``text`` in parts of ``size`` bytes or a little more, each ended by a match of ``boundary``, which is left out."""
    start = 0
    while boundary is not None and len(text) - start > size:
        found = boundary.search(text, start + size)
        if found is None:
            break
        yield text[start:found.start()]
        start = found.end()
    yield text[start:]


class PieceCounter:
    """Counts by a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self._model = SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        # It must neither trim spaces nor leave out the mark in front.
        same = ["".join(p) for p in self._model.encode(["a", " a"], out_type=str)] == [MARK + "a", MARK * 2 + "a"]
        safe = same and not any(MARK in p.lstrip(MARK) for p in pieces)
        # A space behind something that is no space or mark, and before something.
        self.boundary = re.compile(rb"(?<=[^ ])(?<!" + MARK.encode() + rb") (?!\Z)") if safe else None
        self._known = Memo(self._lengths)

    def _lengths(self, runs: list[bytes]) -> list[int]:
        return [len(ids) for ids in self._model.encode([r.decode("utf-8", "replace") for r in runs], num_threads=1)]

    def _runs(self, text: bytes) -> list[bytes]:
        if self.boundary is None:
            return [text]
        runs = text.split(b" ")
        return runs if b"" not in runs and MARK.encode() not in text else self.boundary.split(text)

    def count(self, batch: list[bytes]) -> list[int]:
        split = [self._runs(t) for t in batch]
        different = set().union(*split)
        long = [r for r in different if len(r) > REMEMBERED_BYTES]
        self._known.learn(different.difference(long))
        lengths = self._known
        if long:
            lengths = dict(zip(long, self._lengths(long)))
            lengths.update((r, self._known[r]) for r in different.difference(long))
        return [sum(map(lengths.__getitem__, runs)) for runs in split]


class TextCounter:
    """Counts by a tokenizer file in JSON."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        boundary = re.compile(rb"(?<=[A-Za-z])(?= [A-Za-z])")
        cut = [i for part in boundary.split(PROBE.encode()) for i in self._ids([part])[0]]
        spaced = any(" " in t.content for t in self._tokenizer.get_added_tokens_decoder().values())
        self.boundary = boundary if not spaced and cut == self._ids([PROBE.encode()])[0] else None

    def _ids(self, batch: list[bytes]) -> list[list[int]]:
        found = self._tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in batch], add_special_tokens=False)
        return [e.ids for e in found]

    def count(self, batch: list[bytes]) -> list[int]:
        return [len(ids) for ids in self._ids(batch)]


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter | TextCounter:
    """One per Python worker: what it remembers lasts from task to task."""
    return PieceCounter(path) if path.endswith(".model") else TextCounter(path)


def balanced(rows: Iterable[bytes], boundary: re.Pattern | None, size: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """Batches of about ``size`` bytes: row numbers, and texts or parts of them; no empty ones."""
    owners, batch, held = [], [], 0
    for row, text in enumerate(rows):
        for part in parts(text, boundary, size):
            if part:
                owners.append(row)
                batch.append(part)
                held += len(part)
            if held >= size:
                yield owners, batch
                owners, batch, held = [], [], 0
    if batch:
        yield owners, batch


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 4096, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row of ``docs`` (doc_id, text).

    ``tokenizer`` is a path that all executors have: ``.model`` for SentencePiece,
    else a tokenizer in JSON.  Neither begin and end nor special tokens are added,
    and special strings inside texts are read as the library does by default.
    A null or empty text has no bytes and no tokens.  Rows are counted one by
    one, so null and repeated doc_ids are kept as they are; other columns are
    not looked at; no rows give no rows.
    """
    def measure(batches):
        tokens = counter(tokenizer)
        for rows in batches:
            counts = np.zeros(rows.num_rows, np.int64)
            for owners, batch in balanced(texts(rows["text"]), tokens.boundary, batch_bytes):
                np.add.at(counts, owners, tokens.count(batch))
            sizes = pc.fill_null(pc.binary_length(rows["text"].cast(pa.binary())), 0).cast(pa.int64())
            yield pa.RecordBatch.from_pydict({"doc_id": rows["doc_id"], "n_bytes": sizes, "n_tokens": pa.array(counts),
                                              "over_limit": pa.array(counts > limit)})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(measure, COUNTS)
