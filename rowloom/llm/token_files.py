"""Token ids in binary files whose document boundaries are Elias-Fano coded.

A file holds the ids of consecutive documents, one after the other, and where
each document ends.  The ends grow, so each is split: its low bits are stored as
they are, and the rest as gaps in unary, about two bits a document beside the
low bits.  Positions of every 256th one bit lead a select to the right place.

Layout, little-endian: magic, id width in bytes, low bits a boundary (both 16
bits), documents (32 bits), ids (64 bits), bytes of the high part (32 bits); the
low part; the high part; the sampled positions (32 bits each); the ids.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rowloom.llm.common import pieces, stored, texts
from rowloom.llm.tokens import word_tokenizer
from rowloom.session import scratch_path

MAGIC = b"RLTK"
HEADER = struct.Struct("<4sHHIQI")
SAMPLE = 256
#: A file is closed after the document with which it reaches so many ids.
FILE_IDS = 1 << 22
BATCH_ROWS = 1_000

MANIFEST = "part int, number int, file string, first_id long, last_id long, n_docs long, n_ids long, doc_ids array<long>"


class EliasFano:
    """A non-decreasing sequence below ``universe + 1``; ``select(i)`` is its i-th member."""

    def __init__(self, count: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> "EliasFano":
        values, n = values.astype(np.uint64), len(values)
        low_bits = max(0, int(universe // n).bit_length() - 1) if n else 0
        wide = ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = ((values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)).astype(np.int64)
        bits = np.zeros((int(universe) >> low_bits) + n + 1, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, np.packbits(wide, bitorder="little").tobytes(),
                   np.packbits(bits, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4"))

    def _one(self, i: np.ndarray) -> np.ndarray:
        """Where the i-th one bits are, i ascending: counted on from the sample before the first."""
        start = int(self.samples[i[0] // SAMPLE])
        stop = (int(self.samples[i[-1] // SAMPLE + 1]) if i[-1] // SAMPLE + 1 < len(self.samples)
                else len(self.high) * 8)
        window = np.frombuffer(self.high, np.uint8, -(-stop // 8) - start // 8, start // 8)
        ones = np.flatnonzero(np.unpackbits(window, bitorder="little")[start % 8:]) + start
        return ones[i - i[0] // SAMPLE * SAMPLE]

    def select(self, i: int | np.ndarray) -> np.ndarray:
        """Members at the ascending positions ``i``."""
        i = np.atleast_1d(np.asarray(i, np.int64))
        if not len(i):
            return i
        high = self._one(i) - i
        if not self.low_bits:
            return high
        at = i[:, None] * self.low_bits + np.arange(self.low_bits)
        packed = np.frombuffer(self.low, np.uint8)
        bits = (packed[at >> 3] >> (at & 7)) & 1
        return (high << self.low_bits) | (bits.astype(np.int64) << np.arange(self.low_bits)).sum(1)


def pack_file(ids: bytes, width: int, lengths: list[int]) -> bytes:
    ends = np.cumsum(np.array(lengths, np.int64))
    total = len(ids) // width
    code = EliasFano.encode(ends, total)
    return b"".join((HEADER.pack(MAGIC, width, code.low_bits, len(lengths), total, len(code.high)),
                     code.low, code.high, code.samples.tobytes(), ids))


def open_file(data: bytes) -> tuple[np.ndarray, EliasFano]:
    """The ids and where documents end."""
    magic, width, low_bits, n, total, high_bytes = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("no token file")
    at = HEADER.size
    low = data[at:at + -(-n * low_bits // 8)]
    at += len(low)
    high = data[at:at + high_bytes]
    at += high_bytes
    samples = np.frombuffer(data, "<u4", -(-n // SAMPLE), at)
    at += samples.nbytes
    return (np.frombuffer(data, f"<u{width}", total, at), EliasFano(n, low_bits, low, high, samples))


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None,
                      file_ids: int = FILE_IDS) -> tuple[DataFrame, str]:
    """Write all texts of ``docs`` (doc_id, text) in ascending doc_id order; the manifest and the folder.

    Documents are dealt into ranges of doc_id, each sorted and written by one
    task as files of about ``file_ids`` ids.  A file gets a name of its own, and
    only names in the manifest, which Spark commits, count: files of tasks that
    were lost or run twice are never read.  ``start`` of a file is the number of
    ids before it; one row per file is summed up for that.

    Null texts are empty documents; null doc_ids come first, rows with equal
    doc_ids stand in the order of their texts.  No rows: no files.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")

    def write(batches):
        words, part, number = word_tokenizer(tokenizer, end_id), TaskContext.get().partitionId(), 0
        end, width = np.array([end_id], words.kind).tobytes(), words.kind.itemsize
        files, root = pa.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        ids, lengths, doc_ids, held = [], [], [], 0

        def close():
            name = f"{part:06d}-{number:05d}-{uuid.uuid4().hex}.tok"
            with files.open_output_stream(f"{root}/{name}") as out:
                out.write(pack_file(b"".join(ids), width, lengths))
            known = [d for d in doc_ids if d is not None]
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "file": [name],
                 "first_id": pa.array([min(known, default=None)], pa.int64()),
                 "last_id": pa.array([max(known, default=None)], pa.int64()),
                 "n_docs": [len(lengths)], "n_ids": [held],
                 "doc_ids": pa.array([doc_ids], pa.list_(pa.int64()))})

        for batch in pieces(batches, BATCH_ROWS):
            for doc_id, coded in zip(batch["doc_id"].to_pylist(), words.encode_all(texts(batch["text"]))):
                ids.append(coded + end)
                lengths.append(len(coded) // width + 1)
                doc_ids.append(doc_id)
                held += lengths[-1]
                if held >= file_ids:
                    yield close()
                    ids, lengths, doc_ids, held, number = [], [], [], 0, number + 1
        if lengths:
            yield close()

    ordered = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
               .repartitionByRange(F.asc_nulls_first("doc_id")).sortWithinPartitions("doc_id", "text"))
    manifest = stored(ordered.mapInArrow(write, MANIFEST), "token-manifest")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), folder


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""
    def read(batches):
        files, root = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, first, doc_ids in zip(*(batch[c].to_pylist() for c in ("file", "start", "doc_ids"))):
                with files.open_input_stream(f"{root}/{name}") as source:
                    ids, ends = open_file(source.readall())
                ends = ends.select(np.arange(ends.count))
                starts = np.concatenate(([0], ends[:-1]))
                raw = memoryview(ids.astype("<u4").tobytes())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()), "start": starts + first, "n_tokens": ends - starts,
                    "ids_crc32": pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts, ends)], pa.int64())})

    return (manifest.select("file", "start", "doc_ids").repartition("file")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))
