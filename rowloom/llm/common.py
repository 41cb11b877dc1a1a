"""What the operators of this folder share: words of a text, word hashes, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from rowloom.session import release, scratch, stored  # noqa: F401

#: A-Z become a-z; every other ASCII character that is no letter or digit becomes a space.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; a null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def alnum_words(text: bytes) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z in lower case."""
    return text.translate(ALNUM).split()


def plain_words(text: bytes) -> list[bytes]:
    """What stands between ASCII white space, A-Z in lower case."""
    return text.lower().split()


def word_slices(cleaned: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words between ASCII white space, those of about ``size`` bytes at a time; words stay whole."""
    start = 0
    while len(cleaned) - start > size:
        end = cleaned.find(b" ", start + size)
        if end < 0:
            break
        yield cleaned[start:end].split()
        start = end
    yield cleaned[start:].split()


class Memo(dict):
    """A dictionary that fills itself and forgets: at most two generations of ``limit`` entries.

    ``fill`` gets the missing keys and returns their values.  Keys that are used
    again outlive a change of generation, so frequent words stay.
    """

    def __init__(self, fill, limit: int = 200_000):
        super().__init__()
        self.fill, self.limit, self.old = fill, limit, {}

    def learn(self, keys: Iterable) -> None:
        """Afterwards all ``keys`` are there."""
        self.values_of(set(keys))

    def values_of(self, keys: Iterable) -> dict:
        """Learn different ``keys``; they and their values, as a small dictionary of its own."""
        found, missing = {}, []
        for key in keys:
            value = self.get(key)
            if value is None:
                missing.append(key)
            else:
                found[key] = value
        if missing:
            if len(self) + len(missing) > self.limit:
                self.old = dict(self)
                self.clear()
                self.update(found)
            known = {k: v for k in missing if (v := self.old.get(k)) is not None}
            new = [k for k in missing if k not in known]
            if new:
                known.update(zip(new, self.fill(new)))
            self.update(known)
            found.update(known)
        return found


def word_hashes(words: list[bytes]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(w) for w in words]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def free_name(columns: Sequence[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def passing(docs: DataFrame, compute: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
            passes: Callable[[pa.RecordBatch], np.ndarray], rows: int) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they are: judged in the pass that reads them.

    ``compute`` gets batches of (doc_id, text), doc_ids null, and returns one row for each, in their order;
    ``passes`` says which of these pass.
    """
    place = [c.lower() for c in docs.columns].index("text")

    def choose(batches):
        for batch in pieces(batches, rows):
            text = batch.column(place).cast(pa.string())
            plain = pa.RecordBatch.from_arrays([pa.nulls(len(text), pa.int64()), text], names=["doc_id", "text"])
            good = [passes(found) for found in compute(iter([plain])) if found.num_rows]
            yield batch.filter(pa.array(np.concatenate(good), pa.bool_())) if good else batch

    return docs.mapInArrow(choose, docs.schema)


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
