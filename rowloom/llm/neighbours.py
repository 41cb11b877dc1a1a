"""Approximate nearest neighbours: a navigable small-world graph per shard, shard results merged.

Vectors are dealt into shards of about ``SHARD_ROWS`` by a hash.  Each shard gets
a hierarchical graph of its own, built in one task and stored as one row of flat
arrays: the vectors, their ids, and for every layer a rectangle of neighbour
numbers filled up with -1.  Queries travel in blocks to every shard; a task walks
the graph for all queries of a block at once, in steps of array operations, and
the best of all shards are merged by exact scores.

The measure is the inner product.  Links are made in the space with one more
coordinate, sqrt(largest norm^2 - norm^2), where the nearest point is the one
with the largest inner product; the search itself compares inner products.

A task merges what it finds for a block in all its shards, so results grow with
queries and tasks, not with queries and shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rowloom.llm.common import stored

SHARD_ROWS = 2048
QUERY_ROWS = 2048
LINKS = 16
#: Nearest points from which a node's links are chosen.
CONSIDERED = 48
BEAM = 64
#: Points of the beam that one step expands.
STEP = 4
#: Shards whose results a task holds before it merges them.
MERGED_SHARDS = 8

INDEX = ("dim int, shard long, n int, ids binary, vectors binary, entry int, "
         "links binary, upper array<struct<nodes:binary,links:binary>>")


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, vector (doubles) and dim of the rows that take part, equal rows once.

    Null ids and vectors that are null, empty, zero or hold null or non-finite
    components take no part.
    """
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
            .filter(F.col("vec_id").isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0))
            .dropDuplicates().withColumn("dim", F.size("vector")))


def _levels(ids: np.ndarray) -> np.ndarray:
    """The highest layer of each node, from its id: the same however often a task runs."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    u = (x >> np.uint64(11)).astype(np.float64) / 2.0 ** 53
    return np.floor(-np.log(1.0 - u) / np.log(LINKS)).astype(np.int64)


def _diverse(near: np.ndarray, links: int) -> list[set[int]]:
    """For each node up to ``links`` others: the nearest that are nearer to it than to one already taken.

    ``near`` is the nearness of all pairs.  Places that stay free are filled with
    the nearest ones passed over.  All nodes are handled together, rank by rank.
    """
    n = len(near)
    depth = min(CONSIDERED, n - 1)
    own = near.copy()
    np.fill_diagonal(own, -np.inf)
    candidates = np.argpartition(-own, depth - 1, axis=1)[:, :depth]
    every = np.arange(n)
    candidates = np.take_along_axis(candidates, np.argsort(-np.take_along_axis(own, candidates, 1), axis=1), 1)
    taken, count = np.full((n, links), -1), np.zeros(n, np.int64)
    for rank in range(depth):
        c = candidates[:, rank]
        to_taken = np.where(taken >= 0, near[c[:, None], taken], -np.inf).max(1)
        add = (count < links) & (near[every, c] > to_taken)
        taken[every[add], count[add]] = c[add]
        count += add
    out = [set(t[:m]) for t, m in zip(taken.tolist(), count.tolist())]
    for node, row in enumerate(candidates.tolist()):
        for c in row:
            if len(out[node]) >= links:
                break
            out[node].add(c)
    return out


def _layer(vectors: np.ndarray, links: int, room: int) -> np.ndarray:
    """Neighbours of every node as a rectangle; each node can be reached from the first."""
    n = len(vectors)
    if n == 1:
        return np.full((1, 1), -1, np.int32)
    near = vectors @ vectors.T
    norms = np.diag(near).copy()
    near = 2 * near - norms[:, None] - norms
    out = _diverse(near, links)
    # Links back, the nearest first, as far as there is room.
    back: list[list[int]] = [[] for _ in range(n)]
    for node, others in enumerate(out):
        for o in others:
            if node not in out[o]:
                back[o].append(node)
    for node, others in enumerate(back):
        others.sort(key=lambda o: (-near[node, o], o))
        out[node].update(others[:max(0, room - len(out[node]))])
    # What can't be reached from the first node is linked from the nearest node that can.
    reached = np.zeros(n, bool)
    walk = [0]
    reached[0] = True
    while True:
        while walk:
            for o in out[walk.pop()]:
                if not reached[o]:
                    reached[o] = True
                    walk.append(o)
        missing = np.flatnonzero(~reached)
        if not len(missing):
            break
        known = np.flatnonzero(reached)
        best = near[np.ix_(missing, known)]
        node, at = np.unravel_index(best.argmax(), best.shape)
        out[known[at]].add(int(missing[node]))
        out[missing[node]].add(int(known[at]))
        reached[missing[node]] = True
        walk.append(int(missing[node]))
    links_of = np.full((n, max(map(len, out))), -1, np.int32)
    for node, others in enumerate(out):
        links_of[node, :len(others)] = sorted(others)
    return links_of


def build_shard(ids: np.ndarray, vectors: np.ndarray) -> dict:
    """Flat arrays of one shard's graph; rows in ascending id order."""
    norms = (vectors ** 2).sum(1)
    space = np.concatenate((vectors, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]), axis=1).astype(np.float32)
    levels = _levels(ids)
    # The base layer starts its walk at the entry, so the highest node comes first when it is laid.
    entry = int(levels.argmax())
    turn = np.concatenate(([entry], np.delete(np.arange(len(ids)), entry)))
    ground = _layer(space[turn], LINKS, 2 * LINKS)
    upper = []
    for level in range(1, int(levels.max()) + 1):
        nodes = turn[levels[turn] >= level]
        links = _layer(space[nodes], LINKS, LINKS)
        upper.append({"nodes": nodes.astype("<i4").tobytes(),
                      "links": np.where(links >= 0, nodes[links], -1).astype("<i4").tobytes()})
    base = np.empty((len(ids), ground.shape[1]), "<i4")
    base[turn] = np.where(ground >= 0, turn[ground], -1)
    return {"n": len(ids), "ids": ids.astype("<i8").tobytes(), "vectors": vectors.astype("<f8").tobytes(),
            "entry": entry, "links": base.tobytes(), "upper": upper}


def _nearness(queries: np.ndarray, vectors: np.ndarray, rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Inner products of queries[rows[i]] and the points nodes[i, :]."""
    return np.matmul(vectors[np.maximum(nodes, 0)], queries[rows][:, :, None])[:, :, 0]


def search_shard(row: dict, queries: np.ndarray, beam: int) -> np.ndarray:
    """For each query the points of its final beam, -1 where there are fewer."""
    n, q = row["n"], len(queries)
    vectors = np.frombuffer(row["vectors"], "<f8").reshape(n, -1).astype(np.float32)
    queries = queries.astype(np.float32)
    at, every = np.full(q, row["entry"]), np.arange(q)
    for layer in reversed(row["upper"]):
        nodes = np.frombuffer(layer["nodes"], "<i4")
        links = np.full((n, len(layer["links"]) // 4 // len(nodes)), -1, np.int32)
        links[nodes] = np.frombuffer(layer["links"], "<i4").reshape(len(nodes), -1)
        best, active = _nearness(queries, vectors, every, at[:, None])[:, 0], every
        while len(active):
            around = links[at[active]]
            near = np.where(around >= 0, _nearness(queries, vectors, active, around), -np.inf)
            pick = near.argmax(1)
            value = near[np.arange(len(active)), pick]
            better = value > best[active]
            moved = active[better]
            at[moved], best[moved] = around[better, pick[better]], value[better]
            active = moved
    links = np.frombuffer(row["links"], "<i4").reshape(n, -1)
    seen = np.zeros((q, n + 1), bool)  # the last column takes the -1
    seen[every, at], seen[:, n] = True, True
    points = np.full((q, beam), -1)
    near = np.full((q, beam), -np.inf, np.float32)
    done = np.ones((q, beam), bool)
    points[:, 0], near[:, 0], done[:, 0] = at, _nearness(queries, vectors, every, at[:, None])[:, 0], False
    active = every
    while len(active):
        open_ = np.where(done[active], -np.inf, near[active])
        step = np.argpartition(-open_, STEP - 1, axis=1)[:, :STEP]
        chosen = np.take_along_axis(points[active], step, 1)
        chosen = np.where(np.take_along_axis(open_, step, 1) > -np.inf, chosen, -1)
        done[active[:, None], step] = True
        around = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(active), -1)
        # A point that several expanded points have in common counts once.
        around = np.sort(around, axis=1)
        around[:, 1:][around[:, 1:] == around[:, :-1]] = -1
        around = np.where(seen[active[:, None], around], -1, around)
        seen[active[:, None], around] = True
        value = np.where(around >= 0, _nearness(queries, vectors, active, around), -np.inf).astype(np.float32)
        all_points = np.concatenate((points[active], around), axis=1)
        all_near = np.concatenate((near[active], value), axis=1)
        all_done = np.concatenate((done[active], around < 0), axis=1)
        keep = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        points[active] = np.take_along_axis(all_points, keep, 1)
        near[active] = np.take_along_axis(all_near, keep, 1)
        done[active] = np.take_along_axis(all_done, keep, 1)
        active = active[(~done[active]).any(1)]
    return points


def build_index(embeddings: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """A row per shard with its graph, written to the shared folder; the number of shards."""
    rows = usable(embeddings)
    shards = max(1, -(-rows.count() // shard_rows))

    def build(pdf):
        pdf = pdf.sort_values("vec_id", kind="stable")
        row = build_shard(pdf["vec_id"].to_numpy(np.int64), np.stack(pdf["vector"].to_numpy()).astype(np.float64))
        import pandas as pd
        return pd.DataFrame([{"dim": pdf["dim"].iloc[0], "shard": pdf["shard"].iloc[0]} | row])

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)))
    return stored(dealt.groupBy("dim", "shard").applyInPandas(build, INDEX), "neighbour-index"), shards


def best_of(found: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` best of each query: query ids, point ids and scores, nearest first, ties by smaller id."""
    q, ids, score = (np.concatenate(part) for part in zip(*found))
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], ids[keep], score[keep]


def merged(found: list[tuple[np.ndarray, ...]], k: int) -> pa.RecordBatch:
    q, ids, score = best_of(found, k)
    return pa.RecordBatch.from_pydict({"query_id": q, "vec_id": ids, "score": score})


def nearest(index: DataFrame, shards: int, queries: DataFrame, k: int = 20, beam: int = BEAM,
            query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` nearest points of each query vector: query_id, rank from 1, vec_id, score.

    Scores are inner products in double precision; ties go to the smaller
    vec_id.  A query never finds points of its own id and only those of its own
    dimension.  With no more than ``k`` points it gets all of them.
    """
    asked = usable(queries)
    beam = max(beam, 2 * k + 2)
    blocks = max(1, -(-asked.count() // query_rows))
    block = F.pmod(F.xxhash64("vec_id", "vector", F.lit(1)), F.lit(blocks))
    packed = (asked.groupBy("dim", block.alias("block"))
              .agg(F.array_sort(F.collect_list(F.struct("vec_id", "vector"))).alias("queries"))
              .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))))

    def search(batches):
        held, found = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                key = batch["dim"][i].as_py(), batch["block"][i].as_py()
                if key != held and found:
                    yield merged(found, k)
                    found = []
                held = key
                row = {c: batch[c][i].as_py() for c in ("n", "ids", "vectors", "entry", "links", "upper")}
                asked_here = batch["queries"][i].values
                query_ids = asked_here.field("vec_id").to_numpy()
                vectors = asked_here.field("vector").flatten().to_numpy().reshape(len(query_ids), -1)
                ids = np.frombuffer(row["ids"], "<i8")
                points = search_shard(row, vectors, beam)
                q, place = np.nonzero(points >= 0)
                at = points[q, place]
                own = ids[at] == query_ids[q]
                q, at = q[~own], at[~own]
                exact = np.frombuffer(row["vectors"], "<f8").reshape(row["n"], -1)
                found.append((query_ids[q], ids[at], (vectors[q] * exact[at]).sum(1)))
                if len(found) >= MERGED_SHARDS:
                    found = [best_of(found, k)]
        if found:
            yield merged(found, k)

    met = (packed.join(index, ["dim", "shard"]).sortWithinPartitions("dim", "block")
           .select("dim", "block", "queries", "n", "ids", "vectors", "entry", "links", "upper"))
    found = met.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
