"""Nearest neighbours by inner product: a small-world graph per shard, shard results merged.

Equal vectors are one point of the index, with the smallest ids that have it (a
query can return no more of them than it wants results, so no link is lost).
Points are dealt to shards of about `SHARD_ROWS` by a hash of the vector.  Each
shard is one hierarchical navigable small-world graph in flat arrays: levels by
a hash of the vector, and for each level one array of neighbours, `WIDTH` (twice
that at the bottom) to a node.  The points of a shard join in blocks; a block's
candidates come from one matrix product with the points before it and in it, the
neighbours are chosen by the diversity rule, and a node that others chose too
often keeps its best choice.

Largest inner product is made nearest distance by one more component, the root
of the largest squared length minus the vector's own.  A query walks down each
shard's levels and then keeps a beam of `BEAM` points at the bottom, all queries
of a block together.  Scores are exact double-precision inner products of the
vectors as given; shard results meet in one ranking per query, ties to smaller
ids.

Vectors that are null, zero, or hold null or non-finite components take no part,
neither do missing ids and vectors of another length than the most common one
(the shorter on ties).  Repeated rows are one point; an id with several vectors
asks with the smallest of them and is found by each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociflow.llm.common import column, written

SHARD_ROWS = 8192
WIDTH = 24
BEAM = 96
#: Queries that one shard's task answers in one go.
QUERY_BLOCK = 4096
#: Bits of a level: one node in 2**LEVEL_BITS is on the next level, too.
LEVEL_BITS = 4
_BLOCK = 512


# --- the graph of one shard --------------------------------------------------


def levels_of(hashes: np.ndarray, most: int = 4) -> np.ndarray:
    """The top level of each node: how many times LEVEL_BITS zero bits its hash ends in."""
    level = np.zeros(len(hashes), np.int64)
    rest = hashes.astype(np.uint64)
    open_ = np.ones(len(hashes), bool)
    for _ in range(most):
        open_ &= (rest & np.uint64((1 << LEVEL_BITS) - 1)) == 0
        level += open_
        rest = rest >> np.uint64(LEVEL_BITS)
    return level


def _diverse(x: np.ndarray, node: np.ndarray, candidates: np.ndarray, distance: np.ndarray, width: int) -> list[int]:
    """Nearest first, leave out candidates that lie nearer to one already kept than to the node; fill up with those."""
    kept: list[int] = []
    left: list[int] = []
    vectors = x[candidates]
    near = np.full(len(candidates), np.inf)
    for i in range(len(candidates)):
        if len(kept) == width:
            break
        if near[i] > distance[i]:
            kept.append(i)
            near = np.minimum(near, ((vectors - vectors[i]) ** 2).sum(axis=1))
        else:
            left.append(i)
    kept += left[: max(0, width // 2 - len(kept))]
    return [int(candidates[i]) for i in kept]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T, 0)


def level_graph(x: np.ndarray, width: int, beam: int) -> np.ndarray:
    """Neighbours of every row of ``x``, -1 where there are fewer; rows join in order, block by block."""
    n = len(x)
    chosen: list[list[int]] = []
    for start in range(0, n, _BLOCK):
        stop = min(start + _BLOCK, n)
        far = _distances(x[start:stop], x[:stop])
        rows = np.arange(start, stop)
        far[np.arange(stop) >= rows[:, None]] = np.inf  # only points that joined before
        take = min(beam, stop)
        near = np.argpartition(far, take - 1, axis=1)[:, :take]
        for row in range(stop - start):
            c = near[row][np.isfinite(far[row, near[row]])]
            c = c[np.lexsort((c, far[row, c]))]
            chosen.append(_diverse(x, x[start + row], c, far[row, c], width))
    # links hold both ways; who was chosen too often keeps a diverse choice
    both: list[set[int]] = [set(c) for c in chosen]
    for i, links in enumerate(chosen):
        for j in links:
            both[j].add(i)
    out = np.full((n, 2 * width), -1, np.int32)
    for i, links in enumerate(both):
        c = np.array(sorted(links), np.int64)
        if len(c) > 2 * width:
            d = ((x[c] - x[i]) ** 2).sum(axis=1)
            order = np.lexsort((c, d))
            c = np.array(_diverse(x, x[i], c[order], d[order], 2 * width))
        out[i, : len(c)] = c
    return out


def build(x: np.ndarray, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level from the bottom: its nodes, and their neighbours as positions in that list."""
    level = levels_of(hashes)
    graph = []
    for k in range(int(level.max(initial=0)) + 1):
        nodes = np.flatnonzero(level >= k).astype(np.int32)
        graph.append((nodes, level_graph(x[nodes], WIDTH if k == 0 else WIDTH // 2, BEAM)))
    return graph


def _walk(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int) -> np.ndarray:
    """Best-first search of all rows of ``q`` at once: the ``beam`` nearest found, -1 where there are fewer."""
    m = len(q)
    found = np.full((m, beam), -1, np.int64)
    cost = np.full((m, beam), np.inf)
    done = np.zeros((m, beam), bool)
    seen = np.zeros((m, len(x)), bool)
    found[:, 0] = entry
    cost[:, 0] = ((x[entry] - q) ** 2).sum(axis=1)
    seen[np.arange(m), entry] = True
    active = np.arange(m)
    while len(active):
        open_ = np.where(done[active] | (found[active] < 0), np.inf, cost[active])
        # the two nearest points not yet looked at
        pick = np.argpartition(open_, 1, axis=1)[:, :2] if beam > 1 else np.zeros((len(active), 1), int)
        usable = np.isfinite(np.take_along_axis(open_, pick, axis=1))
        going = usable.any(axis=1)
        active, pick, usable = active[going], pick[going], usable[going]
        if not len(active):
            break
        row = np.repeat(np.arange(len(active)), pick.shape[1])[usable.ravel()]
        at = pick.ravel()[usable.ravel()]
        done[active[row], at] = True
        nodes = found[active[row], at]
        next_ = links[nodes]
        who = np.repeat(row, next_.shape[1])
        next_ = next_.ravel()
        real = next_ >= 0
        who, next_ = who[real], next_[real]
        key = np.unique(who * len(x) + next_)
        who, next_ = key // len(x), key % len(x)
        new = ~seen[active[who], next_]
        who, next_ = who[new], next_[new]
        seen[active[who], next_] = True
        d = ((x[next_] - q[active[who]]) ** 2).sum(axis=1)
        worth = d < cost[active[who], beam - 1]
        who, next_, d = who[worth], next_[worth], d[worth]
        if not len(who):
            continue
        count = np.bincount(who, minlength=len(active))
        wide = int(count.max())
        place = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
        more, more_cost = np.full((len(active), wide), -1, np.int64), np.full((len(active), wide), np.inf)
        more[who, place], more_cost[who, place] = next_, d
        got = np.flatnonzero(count)
        a = active[got]
        all_cost = np.concatenate([cost[a], more_cost[got]], axis=1)
        order = np.argsort(all_cost, axis=1, kind="stable")[:, :beam]
        cost[a] = np.take_along_axis(all_cost, order, axis=1)
        found[a] = np.take_along_axis(np.concatenate([found[a], more[got]], axis=1), order, axis=1)
        done[a] = np.take_along_axis(np.concatenate([done[a], np.zeros((len(got), wide), bool)], axis=1), order, axis=1)
    return found


def search(x: np.ndarray, graph: list[tuple[np.ndarray, np.ndarray]], q: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Positions in ``x`` of the points found for each query, nearest first."""
    nodes, links = graph[-1]
    entry = np.zeros(len(q), np.int64)
    for level in range(len(graph) - 1, 0, -1):
        nodes, links = graph[level]
        best = _walk(x[nodes], links, q, entry, 8)[:, 0]
        entry = np.searchsorted(graph[level - 1][0], nodes[best])
    nodes, links = graph[0]
    return _walk(x, links, q, entry, beam)


# --- Spark -------------------------------------------------------------------


def _usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): the vectors that take part, in double precision."""
    v = F.transform(F.col(vector), lambda c: c.cast("double"))
    good = rows.select(F.col(key).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
        & F.exists("v", lambda c: c != 0)
    )
    lengths = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return good.filter(F.size("v") == (lengths[0]["n"] if lengths else 0))


def _points(vectors: DataFrame, k: int) -> DataFrame:
    """(h, v, ids): the distinct vectors, each with its k + 1 smallest ids."""
    named = vectors.withColumn("h", F.xxhash64("v"))
    # the rank limit is applied before the shuffle, too, so a hot vector sends k + 1 rows a task
    rank = F.dense_rank().over(Window.partitionBy("h", "v").orderBy("id"))
    few = named.withColumn("r", rank).filter(F.col("r") <= k + 1)
    return few.groupBy("h", "v").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def _matrix(column_: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column_.combine_chunks() if isinstance(column_, pa.ChunkedArray) else column_
    if not len(flat):
        return np.empty((0, 0))
    return np.asarray(flat.flatten()).reshape(len(flat), -1)


_INDEX = "shard int, dim int, vectors binary, ids array<array<long>>, levels array<binary>, links array<binary>, extra binary"


def index(rows: DataFrame, key: str, vector: str, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row a shard: its points and the flat arrays of its graph."""
    points = written(_points(_usable(rows, key, vector), k), "ann-points")
    sizes = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)).alias("longest")).first()
    shards, longest = max(1, -(-sizes["n"] // shard_rows)), sizes["longest"] or 0.0

    def make(group: pa.Table) -> pa.Table:
        group = group.sort_by("h")
        v = _matrix(group.column("v"))
        extra = np.sqrt(np.maximum(longest - (v**2).sum(axis=1), 0))
        graph = build(np.column_stack([v, extra]).astype(np.float32), np.asarray(group.column("h")).astype(np.uint64))
        return pa.table(
            {
                "shard": pa.array([group.column("shard")[0].as_py()], pa.int32()),
                "dim": pa.array([v.shape[1]], pa.int32()),
                "vectors": pa.array([v.tobytes()], pa.binary()),
                "ids": pa.array([group.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
                "levels": pa.array([[nodes.tobytes() for nodes, _ in graph]], pa.list_(pa.binary())),
                "links": pa.array([[links.tobytes() for _, links in graph]], pa.list_(pa.binary())),
                "extra": pa.array([extra.tobytes()], pa.binary()),
            }
        )

    # the hash's low bits choose levels, so shards go by another hash
    dealt = points.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), F.col("h")), F.lit(shards)).cast("int"))
    return written(dealt.groupBy("shard").applyInArrow(make, _INDEX), "ann-index")


_FOUND = "query_id long, vec_id long, score double"


def nearest(rows: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row where ``queries`` holds, itself left out."""
    shards = index(rows, key, vector, k, shard_rows)
    asked = _usable(rows.filter(queries), key, vector).groupBy("id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64(F.lit("block"), F.col("id")), F.lit(blocks)).cast("int")
    # the stated query set meets every shard, in blocks
    last = shards.agg(F.max("shard")).first()[0]
    every = F.sequence(F.lit(0), F.lit(last)) if last is not None else F.array().cast("array<int>")
    sent = asked.select("id", "v", block.alias("block"), F.explode(every).alias("shard"))
    copies = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def answer(key_: tuple, asked_: pa.Table, held: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not asked_.num_rows or not held.num_rows:
            return schema.empty_table()
        dim = held.column("dim")[0].as_py()
        v = np.frombuffer(held.column("vectors")[0].as_py()).reshape(-1, dim)
        extra = np.frombuffer(held.column("extra")[0].as_py())
        x = np.column_stack([v, extra]).astype(np.float32)
        nodes = [np.frombuffer(b, np.int32) for b in held.column("levels")[0].as_py()]
        graph = [(n, np.frombuffer(b, np.int32).reshape(len(n), -1)) for n, b in zip(nodes, held.column("links")[0].as_py(), strict=True)]
        ids = held.column("ids")[0].as_py()
        asked_ = asked_.sort_by("id")
        names, q = np.asarray(asked_.column("id")), _matrix(asked_.column("v"))
        q_long = np.column_stack([q, np.zeros(len(q))]).astype(np.float32)
        out = [[], [], []]
        for start in range(0, len(q), _BLOCK):
            found = search(x, graph, q_long[start : start + _BLOCK], max(BEAM, 2 * k))
            for name, vector_, hits in zip(names[start:], q[start:], found, strict=False):
                hits = hits[hits >= 0]
                scores = (v[hits] * vector_).sum(axis=1)
                best = np.argsort(-scores, kind="stable")[: k + 1]
                # points with equal scores may hold smaller ids than the last one kept
                best = np.flatnonzero(scores >= scores[best[-1]])
                for i in best:
                    own = ids[hits[i]]
                    out[0] += [int(name)] * len(own)
                    out[1] += own
                    out[2] += [float(scores[i])] * len(own)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    found = sent.groupBy("shard", "block").cogroup(copies.groupBy("shard", "block")).applyInArrow(answer, _FOUND)
    others = found.filter(F.col("query_id") != F.col("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return others.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
