"""Token ids of texts by a tokenizer file, word by word."""

from __future__ import annotations

import codecs
import functools
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rowloom.llm.common import Memo

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: How byte-level tokenizers write bytes: printable ones as they are, the others as characters from 256 on.
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARACTERS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}
#: The character of each byte, a space stays one.
SPELLING = "".join(" " if b == 32 else BYTE_CHARACTERS.get(b, chr(b)) for b in range(256))
#: Punctuation between a letter or digit and white space is a piece of its own; no part of a special token.
MARKS = rb"!\"#$%&'()*+,\-./:;=?@\[\\\]\^_`{}~"
MARK = re.compile(rb"[" + MARKS + rb"]")
ENDS = re.compile(rb"([" + MARKS + rb"](?<=[A-Za-z0-9].)[" + MARKS + rb"]*)(?=[ \n])")
#: Bytes of characters below U+0180: among these normalization composes nothing, so A-Z may be lowered first.
PLAIN = bytes(range(0xC6))
#: Words of letters up to U+017F, whose kind and lower case no version of Unicode changed; not the Turkish capital I.
STEADY = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc5[\x80-\xbf])+")
PROBES = ["the", "Rerethin", "thonst. ", "eaux?! x", "éireeau", "größe, ", "x", "niño; a", "MIXEDcase: b", "Inst$$$ ", "ÉTÉ& ",
          "don't' l'eau", "a-b-\nc", "4.5. 6", "Œuvre", "ĦĲ", "supercalifragilistique", "... a", "Ǆa", "mI\u0307", "H\u0331. ", "ЖУК жук."]
#: Texts are encoded together up to so many bytes.
GROUP_BYTES = 1 << 21


class WordTokenizer:
    """Ids of whole texts for a tokenizer that drops white space and never joins across it.

    The ids of a text are then those of its words, one after the other, so each
    different word is encoded once and remembered.  Splitting at ASCII white
    space only is enough; other white space stays inside a word and is left to
    the tokenizer.  ``kind`` is the narrowest unsigned type that holds all ids.

    If that gives the same as the whole tokenizer for some probes, words of letters
    go to the tokenizer's model directly, many in one call, and punctuation behind words is cut off before: such a word
    needs no normalization but lower case and is one piece.  The model marks the
    last id of a piece, which tells the words' ids apart.
    """

    def __init__(self, path: str, extra_id: int = 0):
        from tokenizers import Tokenizer, pre_tokenizers
        self._tokenizer = Tokenizer.from_file(path)
        largest = max(self._tokenizer.get_vocab_size(with_added_tokens=True) - 1, extra_id)
        self.kind = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        self._model = Tokenizer(self._tokenizer.model)
        self._model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = getattr(self._tokenizer.model, "end_of_word_suffix", None)
        self._last = np.zeros(largest + 1, bool)
        self._last[[i for token, i in self._tokenizer.get_vocab(False).items() if suffix and token.endswith(suffix)]] = True
        # Neither lower case nor cutting may touch an added token: each has a "<" and none of the marks.
        added = [t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values()]
        clear = all(b"<" in a and not MARK.search(a) for a in added)
        self._known, self._direct = Memo(self._encode), bool(suffix) and clear
        probes = [p.encode() for p in PROBES]
        if self._direct and [self.encode(p) for p in probes] != self._plain(probes):
            self._known, self._direct = Memo(self._encode), False

    def _plain(self, words: list[bytes]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _spelled(self, letters: list[bytes], lowered: bytes) -> list[bytes]:
        """Ids of words of letters, by the model alone; ``lowered``: the words in lower case, with spaces between."""
        text = codecs.charmap_decode(lowered, "strict", SPELLING)[0]
        ids = np.array(self._model.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
        ends = ((np.flatnonzero(self._last[ids]) + 1) * self.kind.itemsize).tolist()
        if len(ends) != len(letters):  # a letter that the model doesn't know
            return self._plain(letters)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of all words, those of letters by the model alone."""
        if not self._direct:
            return self._plain(words)
        steady, lower, others = [], [], []
        for word in words:
            if word.isalpha() or STEADY.fullmatch(word):  # isalpha of bytes: ASCII letters only
                steady.append(word)
            else:
                text = word.decode("utf-8", "replace")
                plain = text.isalpha() and text.lower() == text and unicodedata.is_normalized("NFC", text)
                (lower if plain else others).append(word)
        letters = steady + lower
        lowered = b" ".join([b" ".join(steady).decode().lower().encode(), *lower])
        found = dict(zip(letters, self._spelled(letters, lowered)))
        found.update(zip(others, self._plain(others)))
        return [found[w] for w in words]

    def _spaced(self, text: bytes) -> bytes:
        """The text with a space wherever a word may be cut, in lower case where that is safe."""
        if not self._direct:
            return text
        if b"<" not in text and not text.translate(None, PLAIN):
            text = text.lower()
        return b" ".join(ENDS.split(text))

    def encode(self, text: bytes) -> bytes:
        """The ids as little-endian numbers of ``kind``."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """The same for each text; those of about GROUP_BYTES are encoded together."""
        out, group, held = [], [], 0
        for at, text in enumerate(texts, 1):
            group.append(self._spaced(text))
            held += len(text)
            if held >= GROUP_BYTES or at == len(texts):
                out += self._encode_group(group)
                group, held = [], 0
        return out

    def _encode_group(self, spaced: list[bytes]) -> list[bytes]:
        """Each different word is looked up once; its ids are put wherever it stands."""
        split = pc.ascii_split_whitespace(pa.array(spaced, pa.large_binary()).view(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        _, offsets, letters = coded.dictionary.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(coded.dictionary) + 1).tolist()
        letters = letters.to_pybytes() if letters else b""
        words, places = [letters[a:b] for a, b in zip(offsets, offsets[1:])], coded.indices.to_numpy()
        known = self._known.values_of([w for w in words if w])
        ids = [known[w] if w else b"" for w in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        first, n = np.cumsum(sizes) - sizes, sizes[places]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(ends[-1]) + np.repeat(first[places] - ends[:-1], n)
        raw = np.frombuffer(b"".join(ids), self.kind)[at].tobytes()
        bounds = (ends[split.offsets.to_numpy()] * self.kind.itemsize).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]


@functools.lru_cache(maxsize=2)
def word_tokenizer(path: str, extra_id: int = 0) -> WordTokenizer:
    """One per Python worker: its memory of words lasts from task to task."""
    return WordTokenizer(path, extra_id)
