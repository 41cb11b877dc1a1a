import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from conftest import SMALL
from rowloom.llm import queries, token_files
from rowloom.llm.tokens import WordTokenizer, word_tokenizer
from rowloom.llm.queries import TOKENIZER, op8_token_files

ODD = ["", None, "  \n", "á b c ̸x", "It's 12 o'clock!?", "\x1c\x1d x", "word " * 30_000, "ΣΑΣ Ẋ İ",
       "tab\tand\x0bmore wide"]


def brute(tokenizer, text, end):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_words_give_the_ids_of_the_text(text):
    whole = Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids
    words = word_tokenizer(TOKENIZER, 2)
    assert np.frombuffer(words.encode(text.encode("utf-8", "replace")), words.kind).tolist() == whole


@given(st.lists(st.text("aBzÉßŉİſǄµª1 .,'-\"<|>]$\n\u0331\u0307…¿жΣ", max_size=30) | st.sampled_from(
    ["<|endoftext|>", "<|ENDOFTEXT|>", " the. ", "it's", "'S ", "...", "x<|endoftext|>. ", "H\u0331. "]), max_size=8))
@settings(max_examples=500, deadline=None)
def test_capitals_and_marks_give_the_ids_of_the_text(parts):
    whole = Tokenizer.from_file(TOKENIZER).encode("".join(parts), add_special_tokens=False).ids
    words = word_tokenizer(TOKENIZER, 2)
    assert words._direct
    each = words.encode_all([p.encode() for p in parts] + ["".join(parts).encode()])
    assert np.frombuffer(each[-1], words.kind).tolist() == whole
    assert each[:-1] == [words.encode(p.encode()) for p in parts]


def test_a_word_is_encoded_once_whatever_its_capitals_and_marks(monkeypatch):
    words, sent = WordTokenizer(TOKENIZER, 2), []
    fill = words._known.fill
    monkeypatch.setattr(words._known, "fill", lambda new: sent.extend(new) or fill(new))
    text = "Zorblix zorblix. ZORBLIX, zorblix!? Ézorb ézorb; (zorblix)\n" * 3
    whole = Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(words.encode(text.encode()), words.kind).tolist() == whole
    assert sum(b"zorblix" in w.lower() for w in sent) == 2  # on its own and in brackets


def test_a_word_is_looked_up_once_in_a_group_of_texts(monkeypatch):
    words, asked = WordTokenizer(TOKENIZER, 2), []
    look_up = words._known.values_of
    monkeypatch.setattr(words._known, "values_of", lambda keys: asked.extend(keys) or look_up(keys))
    texts = ["", "one two one. Two", "  ", "\x1c one\x00 two\x0bone \u00a0 ", "two"] * 50
    tokenizer = Tokenizer.from_file(TOKENIZER)
    got = words.encode_all([t.encode() for t in texts])
    assert [np.frombuffer(g, words.kind).tolist() for g in got] == [brute(tokenizer, t, 2)[:-1] for t in texts]
    assert len(asked) == len(set(asked)) and b"one" in asked
    assert words.encode_all([]) == []


@given(st.lists(st.integers(0, 5_000), max_size=700))
@settings(max_examples=100, deadline=None)
def test_select_returns_every_boundary(gaps):
    values = np.cumsum(np.array(gaps, np.int64))
    code = token_files.EliasFano.encode(values, int(values[-1]) if len(values) else 0)
    assert code.select(np.arange(len(values))).tolist() == values.tolist()
    for i in range(0, len(values), 37):
        assert code.select(i)[0] == values[i]
    if len(values) > 300:
        used = len(code.low) + len(code.high) + code.samples.nbytes
        assert used * 8 <= len(values) * (2.5 + code.low_bits) + 64


@pytest.mark.parametrize("file_ids", [1, 500, 1 << 22])
def test_files_round_trip(spark, file_ids):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(None, "none", "x", 1), (3, "again", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, file int").repartition(3)
    manifest, folder = token_files.write_token_files(docs, TOKENIZER, 2, file_ids=file_ids)
    got = sorted(map(tuple, token_files.read_token_files(manifest, folder).collect()), key=lambda r: r[1])
    tokenizer, start, want = Tokenizer.from_file(TOKENIZER), 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = brute(tokenizer, text, 2)
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    manifest, folder = token_files.write_token_files(docs, TOKENIZER, 2)
    assert token_files.read_token_files(manifest, folder).collect() == []


def test_query_equals_plain_encoding(spark, tables):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op8_token_files(spark, SMALL).collect()}
    tokenizer, start = Tokenizer.from_file(TOKENIZER), 0
    for doc_id, text in sorted(map(tuple, tables.documents.select("doc_id", "text").collect())):
        ids = brute(tokenizer, text, 2)
        assert got.pop(doc_id) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got
    assert queries.all_queries()["op8_token_files"] is op8_token_files
