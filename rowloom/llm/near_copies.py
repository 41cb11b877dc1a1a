"""Documents that share nearly all their word n-grams: an exact Jaccard join over a token-group matrix.

1. Shingles of all documents are counted in buckets by hash.  A block of documents
   sends each bucket its shingles; back come those that another document has too.
   A shingle of one document alone can't be in any overlap, so a document with
   more of them than the threshold allows is done: nothing can link to it.
2. What is left is collapsed to one row per set (by a 64-bit hash of it) and put into groups of similar
   sets: equal smallest shared shingle, split where a group is large.  The matrix
   says which group holds which shingle.
3. The matrix holds the prefixes of sets, the rarest shingles of which a partner
   must have one.  Two groups that hold the same one are candidates, and the sets of
   one ask the other.  There the overlap with the union of the group's shingles bounds the overlap with any
   member, and only groups that reach the needed overlap are opened, their members
   of suitable size counted out.
4. Each group returns links that connect what it found connected, not all pairs.
   Components come from rounds of smallest neighbours and shortcuts.

A shingle that many documents share would gather in one bucket.  A small sample
shows such shingles; they count as shared and come last in the order, and are not
sent.  What the sample misses costs time, not results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rowloom.llm.common import mixed, pieces, plain_words, release, scratch, stored, texts

WORDS = 4
SHARE = 85  # hundredths
BLOCK_ROWS = 1_000
#: Text bytes for each bucket of shingles; sets in a group.
BUCKET_BYTES = 12 << 20
GROUP_ROWS = 512
#: Sets that ask a group in one task.
ASKERS = 4_096
#: Documents that show common shingles, and how many of them must have one.
SAMPLE_ROWS, SAMPLE_HITS = 4_000, 12

ROWS = ("block long, bucket int, docs binary, tokens binary, ranks binary, doc_ids array<string>, sizes binary, keys binary")
STATE = "doc_id long, n long, vertex long, alone long, tokens binary"


def shingles(words: list[bytes], width: int = WORDS) -> np.ndarray:
    """The set of hashes of all runs of ``width`` words, sorted; of all words if there are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(w))
    h = np.full(len(w) - width + 1, width, np.uint64)
    for i in range(width):
        h = mixed(h) + w[i:len(w) - width + 1 + i]
    return np.unique(mixed(h))


def needed(size: np.ndarray | int, share: int):
    """The least overlap of a set of this size with any partner."""
    return -(-size * share // 100)


def common_shingles(docs: DataFrame, rows: int, width: int) -> np.ndarray:
    """Shingles of at least SAMPLE_HITS documents of a sample: at most all shingles of it / SAMPLE_HITS."""
    share = min(1.0, SAMPLE_ROWS / max(1, rows))
    edge = min(int(share * (1 << 63)), (1 << 63) - 1)

    def split(batches):
        for batch in pieces(batches, BLOCK_ROWS):
            sets = [shingles(plain_words(t), width) for t in texts(batch["text"])]
            token, n = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_pydict({"token": token.view(np.int64), "n": n.astype(np.int64)})

    sample = docs.filter(F.col("text").isNotNull() & (F.xxhash64("doc_id", F.octet_length("text")).bitwiseAND((1 << 63) - 1) <= edge))
    often = (sample.select("text").mapInArrow(split, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= SAMPLE_HITS).select("token").toArrow())
    return np.sort(often["token"].to_numpy().view(np.uint64))


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def _short(tokens: np.ndarray) -> bytes:
    """Six of the eight bytes; the bucket tells the rest apart."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def shared_shingles(docs: DataFrame, width: int, share: int, buckets: int, common: np.ndarray) -> DataFrame:
    """One row per document: set size, and for sets that may have partners their shared shingles in rank order."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("docs", pa.binary()), ("tokens", pa.binary()),
                        ("ranks", pa.binary()), ("doc_ids", pa.list_(pa.string())), ("sizes", pa.binary()),
                        ("keys", pa.binary())])

    def split(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in pieces(batches, BLOCK_ROWS):
            sets = [shingles(plain_words(t), width) for t in texts(batch["text"])]
            sizes = np.array([len(s) for s in sets], np.int64)
            tokens = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            owner = np.repeat(np.arange(len(sets)), sizes)
            frequent = _member(tokens, common)
            keys = b"".join(xxhash.xxh3_64_digest(s.tobytes()) for s in sets)
            # Rows for no bucket are spread like the others and pass through.
            rows = [{"block": block, "bucket": -1 - (block ^ (block >> 32)) % buckets, "docs": owner[frequent].astype("<u2").tobytes(),
                     "tokens": _short(tokens[frequent]), "ranks": b"\xff" * int(frequent.sum()),
                     "doc_ids": batch["doc_id"].cast(pa.string()).to_pylist(), "sizes": sizes.astype("<i8").tobytes(),
                     "keys": keys}]
            tokens, owner = tokens[~frequent], owner[~frequent]
            # The two bytes that aren't sent choose the bucket.
            bucket = ((tokens >> np.uint64(48)) * np.uint64(buckets)) >> np.uint64(16)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in range(buckets):
                inside = order[ends[b]:ends[b + 1]]
                if len(inside):
                    rows.append({"block": block, "bucket": b, "docs": owner[inside].astype("<u2").tobytes(),
                                 "tokens": _short(tokens[inside])})
            block += 1
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def shared(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["bucket"].iloc[0] < 0:
            return pdf
        lengths = [len(t) // 6 for t in pdf["tokens"]]
        tokens = _long(b"".join(pdf["tokens"]))
        order = np.argsort(tokens, kind="stable")
        ordered = tokens[order]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        count = np.diff(np.append(first, len(ordered)))
        often = np.empty(len(tokens), np.int64)
        often[order] = np.repeat(count, count)
        rank = np.minimum(254, np.log2(often) * 8).astype(np.uint8)
        docs_, tokens_, ranks, at = [], [], [], 0
        for n, raw in zip(lengths, pdf["docs"]):
            keep = often[at:at + n] > 1
            docs_.append(np.frombuffer(raw, "<u2")[keep].tobytes())
            tokens_.append(_short(tokens[at:at + n][keep]))
            ranks.append(rank[at:at + n][keep].tobytes())
            at += n
        out = pdf.assign(docs=docs_, tokens=tokens_, ranks=ranks)
        return out[out["docs"].map(len) > 0]

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf[pdf["bucket"] < 0].iloc[0]
        sizes = np.frombuffer(head["sizes"], "<i8")
        keys = np.frombuffer(head["keys"], ">i8")
        owner = np.concatenate([np.frombuffer(d, "<u2") for d in pdf["docs"]]).astype(np.int64)
        # Six bytes and the bucket are the shingle from here on.
        tokens = np.concatenate([_long(t) | (np.uint64(max(b, 0) % 65536) << np.uint64(48))
                                 for t, b in zip(pdf["tokens"], pdf["bucket"])])
        ranks = np.concatenate([np.frombuffer(r, np.uint8) for r in pdf["ranks"]])
        order = np.lexsort((tokens, ranks, owner))
        owner, tokens = owner[order], tokens[order]
        ends = np.searchsorted(owner, np.arange(len(sizes) + 1))
        held = np.diff(ends)
        may = (sizes > 0) & (held >= needed(sizes, share))
        rows = [(None if d is None else int(d), int(n), int(k) if m else None, int(n - h) if m else None,
                 tokens[a:b].tobytes() if m else None)
                for d, n, k, m, h, a, b in zip(head["doc_ids"], sizes, keys, may, held, ends[:-1], ends[1:])]
        return pd.DataFrame(rows, columns=["doc_id", "n", "vertex", "alone", "tokens"]).astype(
            {"doc_id": "Int64", "vertex": "Int64", "alone": "Int64"})

    counted = docs.mapInArrow(split, ROWS).groupBy("bucket").applyInPandas(shared, ROWS)
    return stored(counted.groupBy("block").applyInPandas(gather, STATE), "copies-shingles")


class Joined:
    """Which of some rows are connected, as far as known."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def unite(self, i: int, j: int) -> bool:
        i, j = self.top(i), self.top(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def group_links(members: list[tuple[int, int, np.ndarray]], askers: list[tuple[int, int, np.ndarray]],
                share: int) -> list[tuple[int, int]]:
    """Links among members, and between askers and members: enough to connect what is connected.

    Both are (vertex, set size, shared shingles).
    """
    sizes = np.array([n for _, n, _ in members])
    tokens = np.concatenate([t for *_, t in members])
    owner = np.repeat(np.arange(len(members)), [len(t) for *_, t in members])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    union = np.unique(tokens)
    joined, found = Joined(len(members) + len(askers)), []
    for i, (vertex, n, own) in enumerate([*members, *askers]):
        # A partner holds this much of the set, so the union of all members does.
        if i >= len(members) and _member(own, union).sum() < needed(n, share):
            continue
        low, high = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
        spans = high - low
        at = np.repeat(low - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
        common = np.bincount(owner[at], minlength=len(members))
        for j in np.flatnonzero(100 * common >= share * (n + sizes - common)).tolist():
            if members[j][0] != vertex and joined.unite(i, j):
                found.append((vertex, members[j][0]))
    return found


def links(sets: DataFrame, share: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (a, b) between vertices of different sets that connect every pair reaching the threshold."""
    def place(batches):
        for batch in batches:
            out = {name: [] for name in ("vertex", "home", "prefix")}
            for vertex, n, alone, raw in zip(*(batch[c].to_pylist() for c in ("vertex", "n", "alone", "tokens"))):
                tokens = np.frombuffer(raw, np.uint64)
                out["vertex"].append(vertex)
                out["home"].append(int(mixed(tokens).min().view(np.int64)))
                out["prefix"].append(tokens[:max(0, int(n - needed(n, share) + 1 - alone))].view(np.int64))
            yield pa.RecordBatch.from_pydict({"vertex": pa.array(out["vertex"], pa.int64()),
                                              "home": pa.array(out["home"], pa.int64()),
                                              "prefix": pa.array(out["prefix"], pa.list_(pa.int64()))})

    placed = sets.select("vertex", "n", "alone", "tokens").mapInArrow(place, "vertex long, home long, prefix array<long>")
    placed = placed.filter(F.size("prefix") > 0)
    parts = placed.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / group_rows).alias("_parts"))
    grouped = stored(placed.join(parts, "home").select(
        "vertex", "prefix", F.xxhash64("home", F.pmod(F.xxhash64("vertex"), F.col("_parts"))).alias("group")), "copies-groups")
    matrix = grouped.select(F.explode("prefix").alias("token"), "group").distinct()
    # Tokens that only one group holds lead nowhere else.
    wide = matrix.groupBy("token").agg(F.count(F.lit(1)).alias("_groups")).filter("_groups > 1").select("token")
    matrix = stored(matrix.join(wide, "token", "left_semi"), "copies-matrix")
    # Groups are matched, not their members: a group of similar sets has the same tokens many times.
    met = (matrix.withColumnRenamed("group", "_own").join(matrix, "token").filter(F.col("_own") < F.col("group"))
           .select("_own", "group").distinct())
    asked = stored(grouped.select("vertex", F.col("group").alias("_own")).join(met, "_own").select("vertex", "group"),
                   "copies-asked")
    # A group that many ask meets them in parts.
    parts = asked.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / ASKERS).alias("_parts"))
    content = sets.select("vertex", "n", "tokens")
    members = (grouped.select("vertex", "group").join(parts, "group", "left")
               .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)) - 1)))
               .select("vertex", "group", "part").join(content, "vertex"))
    askers = (asked.join(parts, "group").withColumn("part", F.pmod(F.xxhash64("vertex"), F.col("_parts")))
              # New names for the same columns: a cogroup of two frames needs them.
              .select("vertex", F.col("group").alias("group"), "part")
              .join(content.select(*[F.col(c).alias(c) for c in content.columns]), "vertex")
              .select(*[F.col(c).alias(c) for c in ("vertex", "group", "part", "n", "tokens")]))

    def open_group(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        def listed(pdf):
            return [(int(v), int(n), np.frombuffer(t, np.uint64)) for v, n, t in zip(pdf["vertex"], pdf["n"], pdf["tokens"])]

        return pd.DataFrame(group_links(listed(left), listed(right), share), columns=["a", "b"], dtype="int64")

    return stored(members.groupBy("group", "part").cogroup(askers.groupBy("group", "part"))
                  .applyInPandas(open_group, "a long, b long"), "copies-links")


def components(edges: DataFrame) -> DataFrame:
    """(vertex, top) of every linked vertex: the same ``top`` for all that are connected."""
    both = stored(edges.select(F.col("a").alias("vertex"), F.col("b").alias("other"))
                  .unionByName(edges.select(F.col("b").alias("vertex"), F.col("a").alias("other"))).distinct(), "copies-both")
    top = stored(both.groupBy("vertex").agg(F.least(F.col("vertex"), F.min("other")).alias("top")), "copies-tops")
    used = top
    while True:
        seen = both.join(top.withColumnsRenamed({"vertex": "other", "top": "_near"}), "other")
        near = seen.groupBy("vertex").agg(F.min("_near").alias("_near"))
        moved = top.join(near, "vertex").select("vertex", F.col("top").alias("_before"), F.least("top", "_near").alias("top"))
        # A shortcut: the top of one's top.
        higher = top.select(F.col("vertex").alias("top"), F.col("top").alias("_higher"))
        after = stored(moved.join(higher, "top", "left").select(
            "vertex", "_before", F.least("top", F.coalesce("_higher", "top")).alias("top")), "copies-tops")
        release(used)
        top, used = after.select("vertex", "top"), after
        if after.filter(F.col("top") != F.col("_before")).isEmpty():
            return top


def group_copies(docs: DataFrame, width: int = WORDS, share: int = SHARE, group_rows: int = GROUP_ROWS,
                 buckets: int | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id of every document (doc_id, text).

    Two documents are linked when the intersection of their sets of ``width``-word
    shingles is at least ``share`` hundredths of the union; a component is named by its
    smallest doc_id.  Null, empty and wordless texts have empty sets and are
    linked with nothing.  Repeated rows are documents of their own, linked by
    their equal texts.  A component whose doc_ids are all null has a null name.
    """
    with scratch(docs.sparkSession) as own:
        return own.hand_over(_grouped(docs, width, share, group_rows, buckets), "copies-components")


def _grouped(docs: DataFrame, width: int, share: int, group_rows: int, buckets: int | None) -> DataFrame:
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = plain.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    buckets = buckets or min(60_000, max(64, (size["bytes"] or 0) // BUCKET_BYTES))
    common = common_shingles(plain, size["rows"], width)
    state = shared_shingles(plain, width, share, buckets, common)
    may = state.filter(F.col("vertex").isNotNull())
    # One row per different set; equal sets are one vertex.
    sets = stored(may.groupBy("vertex").agg(F.min_by(F.struct("n", "alone", "tokens"), F.coalesce("doc_id", F.lit(0))).alias("_s"),
                                            F.min("doc_id").alias("first")).select("vertex", "first", "_s.*"), "copies-sets")
    tops = components(links(sets, share, group_rows))
    named = sets.select("vertex", "first").join(tops, "vertex", "left").select(
        "vertex", "first", F.coalesce("top", "vertex").alias("top"))
    names = named.groupBy("top").agg(F.min("first").alias("component_id"))
    component = named.join(names, "top").select("vertex", "component_id")
    apart = state.filter(F.col("vertex").isNull()).withColumn("component_id", F.col("doc_id"))
    return (state.join(component, "vertex").select("doc_id", "n", "component_id")
            .unionByName(apart.select("doc_id", "n", "component_id")).withColumnRenamed("n", "n_shingles")
            .select("doc_id", "n_shingles", "component_id"))
