"""Documents dealt into shards of equal row counts, equal texts together: balanced label propagation.

Documents with the same text are linked.  A group of them has a hub, so a group of
n has n links and not n^2 pairs; a group larger than half a shard gets
several hubs.  Linked documents start in the shard of their own hash.  In every
round each hub points to the shard where most of its documents are, and documents
elsewhere ask to move there.  The requests from shard i to shard j, in bins by a
hash of the hub, are counted; as many as i and j can exchange, and then as many as
j has room for, are granted bin by bin.  So no shard grows beyond its quota and
a little slack, and what moves is decided from counts of a fixed size.

Documents without links have no neighbours to move to.  They, and linked ones
beyond a shard's quota, whole groups as far as possible, fill the shards up to their quotas, which are at most one
row apart.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.llm.common import stored

SHARDS = 40
ROUNDS = 12
#: Part by which a shard may be too large between rounds; the end puts that right.
SLACK = 0.1
BINS = 32
#: Rows of a hub that look up its shard in one task, about.  Deals out work; what a hub holds is up to half a shard.
MOST_ROWS = 20_000
#: Rows that one task numbers at a time, about.
RANKED_ROWS = 5_000


def quotas(rows: int, shards: int) -> list[int]:
    """As even as whole numbers allow."""
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def granted(flow: np.ndarray, load: np.ndarray, quota: np.ndarray) -> np.ndarray:
    """How many bins of each (from, to) may move, given requests by (from, to, bin).

    Moves that another in the opposite direction balances come first; what is
    left over may move where the quota still has room.
    """
    asked = flow.sum(2)
    allowed = np.minimum(asked, asked.T)
    bins = (np.cumsum(flow, 2) <= allowed[:, :, None]).sum(2)

    def moved(b):
        return np.where(np.arange(flow.shape[2]) < b[:, :, None], flow, 0).sum(2)

    def after(b):
        m = moved(b)
        return load + m.sum(0) - m.sum(1)

    # Whole bins of different size can leave an exchange uneven: take back where that breaks a quota.
    while (over := after(bins) - np.maximum(quota, load)).max(initial=0) > 0:
        j = int(over.argmax())
        i = int(moved(bins)[:, j].argmax())
        bins[i, j] -= 1
    now = after(bins)
    for j in np.argsort(now - quota):
        for i in np.argsort(-asked[:, j]):
            while bins[i, j] < flow.shape[2] and now[j] + flow[i, j, bins[i, j]] <= quota[j]:
                now[j] += flow[i, j, bins[i, j]]
                now[i] -= flow[i, j, bins[i, j]]
                bins[i, j] += 1
    return bins


def propagate(linked: DataFrame, quota: list[int], rounds: int = ROUNDS, bins: int = BINS) -> DataFrame:
    """Rounds of moves over rows (group, chunk, slice, shard, ...); the same rows with new shards.

    The slices of a hub, from 0, vote together and look up its shard one by one.
    """
    spark, shards = linked.sparkSession, len(quota)
    for turn in range(rounds):
        votes = linked.groupBy("group", "chunk", "shard").agg(F.count(F.lit(1)).alias("_n"), F.max("slice").alias("_last"))
        # Ties go to a shard that differs from hub to hub.
        first = F.max_by("shard", F.struct("_n", F.xxhash64("group", "chunk", "shard")))
        hubs = votes.groupBy("group", "chunk").agg(first.alias("_to"), F.max("_last").alias("_last"))
        hubs = hubs.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last")))).drop("_last")
        asking = linked.join(hubs, ["group", "chunk", "slice"]).withColumn(
            "_bin", F.pmod(F.xxhash64("group", "chunk", F.lit(turn)), F.lit(bins)).cast("int"))
        asking = stored(asking, "shard-requests")
        flow = np.zeros((shards, shards, bins), np.int64)
        load = np.zeros(shards, np.int64)
        for r in asking.groupBy("shard", "_to", "_bin").agg(F.count(F.lit(1)).alias("n")).collect():
            load[r["shard"]] += r["n"]
            if r["shard"] != r["_to"]:
                flow[r["shard"], r["_to"], r["_bin"]] += r["n"]
        if not flow.any():
            return linked
        may = granted(flow, load, np.ceil(np.array(quota) * (1 + SLACK)).astype(np.int64))
        if not may.any():
            return linked
        moves = spark.createDataFrame([(i, j, int(may[i, j])) for i in range(shards) for j in range(shards)],
                                      "shard int, _to int, _may int")
        linked = (asking.join(F.broadcast(moves), ["shard", "_to"])  # shards^2 rows
                  .withColumn("shard", F.when(F.col("_bin") < F.col("_may"), F.col("_to")).otherwise(F.col("shard")))
                  .drop("_to", "_bin", "_may"))
    return stored(linked, "shard-labels")


def ranked(df: DataFrame, keys: list[str], by: Column, buckets: int, name: str, ties: list[str]) -> DataFrame:
    """Adds the row's place (from 0) within its keys; rows of one ``by``, a 64-bit hash, stand together.

    Ranges of the hash, ``buckets`` at least, are numbered apart and put together
    by their counts, so no task gets a whole key.
    """
    df = df.withColumn("_h", by).withColumn("_bucket", F.shiftrightunsigned("_h", 64 - max(1, buckets.bit_length())))
    counts = df.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy(*keys, "_bucket").orderBy("_h", *ties)
    return (df.withColumn("_rn", F.row_number().over(own)).join(offsets, [*keys, "_bucket"])
            .withColumn(name, F.col("_before") + F.col("_rn") - 1).drop("_h", "_bucket", "_rn", "_before"))


def place(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document (doc_id, text).

    The law is ``rows``: counts of shards differ by one at most.  ``size`` is the
    text's UTF-8 bytes plus 16, ``slot`` numbers a shard's rows from 0 without
    gaps, ``grown_shard`` is null.  Null texts have size 16, checksum 0 and no
    links; empty ones are equal texts like any others.  Repeated rows and null
    doc_ids are rows of their own.  No rows, no result.
    """
    text = F.col("text").cast("string")
    base = stored(docs.select(
        F.col("doc_id").cast("long"), (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0).cast("long")).alias("text_crc32"),
        F.when(text.isNotNull(), F.xxhash64(text, F.octet_length(text))).alias("group")), "shard-rows")
    rows = base.count()
    quota = quotas(rows, shards)
    room = max(1, quota[-1] // 2, min(quota[-1], 64))
    buckets = max(64, rows // RANKED_ROWS)
    same = (base.filter(F.col("group").isNotNull()).groupBy("group").agg(F.count(F.lit(1)).alias("_size"))
            .filter("_size > 1"))
    chunks = F.ceil(F.col("_size") / room)
    tagged = stored(base.join(same, "group", "left")
                    .withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit(7)), chunks))
                    .withColumn("slice", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.ceil(F.col("_size") / chunks / MOST_ROWS))),
                    "shard-linked")
    linked = (tagged.filter(F.col("_size").isNotNull()).drop("_size")
              .withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")))
    linked = propagate(linked, quota, rounds)
    limits = F.array(*[F.lit(q) for q in quota])
    hub = F.xxhash64("group", "chunk", "shard")
    kept = stored(ranked(linked, ["shard"], hub, buckets, "_place", ["doc_id", "text_crc32"])
                  .withColumn("_kept", F.col("_place") < F.get(limits, F.col("shard"))), "shard-kept")
    settled = kept.filter("_kept").select("doc_id", "size", "text_crc32", "group", "chunk", "shard")
    load = {r["shard"]: r["n"] for r in settled.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Shards are filled one after the other along the order of the pool, so what is linked stays together there too.
    free = np.cumsum([q - load.get(j, 0) for j, q in enumerate(quota)])
    pool = (kept.filter(~F.col("_kept")).select("doc_id", "size", "text_crc32", "group", "chunk")
            .unionByName(tagged.filter(F.col("_size").isNull()).select("doc_id", "size", "text_crc32", "group", "chunk")))
    order = F.xxhash64(F.coalesce(F.xxhash64("group", "chunk"), F.lit(0)),
                       F.when(F.col("chunk").isNull(), F.col("doc_id")))
    filled = (ranked(pool.withColumn("_all", F.lit(0)), ["_all"], order, buckets, "_place", ["doc_id", "text_crc32"])
              .withColumn("shard", F.size(F.filter(F.array(*[F.lit(int(f)) for f in free]), lambda f: f <= F.col("_place"))))
              .select("doc_id", "size", "text_crc32", "group", "chunk", "shard"))
    dealt = stored(settled.unionByName(filled), "shard-dealt")
    slots = ranked(dealt, ["shard"], F.xxhash64("doc_id", "text_crc32"), buckets, "slot", ["doc_id", "text_crc32"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"),
                        F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))
