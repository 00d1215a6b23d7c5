"""Nearest neighbours by robust-pruned directed graphs, one per shard.

Distinct vectors are dealt into shards of bounded size, which grow with the table up to
that bound. In each, points enter a
graph in batches: a greedy search over what is there proposes neighbours, relaxed
pruning keeps edges in different directions, and edges back are added and pruned
likewise. The graphs are stored, a row per shard. Queries go through every shard
in blocks, by a beam search whose finds are scored in double precision; the best
of all shards are kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidematch.llm.common import Steps
from tidematch.session import ship_package

#: Distinct vectors in a shard, about: as many as make ``SHARDS`` shards, within these
#: bounds. Every query goes through every shard, so there are few shards, up to
#: millions of vectors, and large ones beyond.
SHARD, LARGEST, SHARDS = 8192, 131_072, 128
#: Queries in a block. A shard's graph is sent to each block of queries, so a block is
#: about as large as a graph of the smallest size.
BLOCK = 8192
#: Edges out of a point, beam widths of building and of searching, relaxation.
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 256
RELAX = 1.2
#: Points where each search starts, and points that enter a graph at once.
STARTS = 8
BATCH = 256
NEAREST = 10


def distances(points: np.ndarray, rows: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Squared distances of the points named in each row to that row's target."""
    gap = points[rows] - targets[:, None, :]
    return np.einsum("bij,bij->bi", gap, gap)


def beam_search(
    points: np.ndarray, edges: np.ndarray, starts: np.ndarray, targets: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy searches for all targets in step.

    Returns the beams (ids, squared distances; -1 and infinity where empty) and
    for each target which points it expanded.
    """
    count = len(targets)
    each = np.arange(count)
    seen = np.zeros((count, len(points)), bool)
    seen[:, starts] = True
    ids = np.full((count, width + edges.shape[1]), -1, np.int64)
    far = np.full(ids.shape, np.inf, np.float32)
    first = np.broadcast_to(starts, (count, len(starts)))[:, :width]
    ids[:, : first.shape[1]] = first
    far[:, : first.shape[1]] = distances(points, first, targets)
    done = np.zeros(ids.shape, bool)
    expanded = []
    while True:
        order = np.argsort(far, axis=1, kind="stable")
        ids, far, done = (np.take_along_axis(a, order, axis=1) for a in (ids, far, done))
        ids[:, width:], far[:, width:], done[:, width:] = -1, np.inf, False
        todo = np.where(done | (ids < 0), np.inf, far)[:, :width]
        at = todo.argmin(axis=1)
        live = np.isfinite(todo[each, at])
        if not live.any():
            break
        done[each, at] |= live
        chosen = np.where(live, ids[each, at], -1)
        expanded.append(chosen)
        near = np.where(live[:, None], edges[np.maximum(chosen, 0)], -1)
        new = (near >= 0) & ~seen[each[:, None], near]
        rows, cols = np.nonzero(new)
        seen[rows, near[rows, cols]] = True
        gap = points[near[rows, cols]] - targets[rows]
        ids[:, width:] = np.where(new, near, -1)
        far[rows, width + cols] = np.einsum("ij,ij->i", gap, gap)
    visited = np.stack(expanded, axis=1) if expanded else np.zeros((count, 0), np.int64)
    return ids[:, :width], far[:, :width], visited


def prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Diverse neighbours out of each row's candidates (-1: none).

    The nearest candidate is kept, and those that lie clearly nearer to it than
    to the point itself go; and so on up to the degree.
    """
    far = distances(points, np.maximum(candidates, 0), points[own])
    out = np.sort(candidates, axis=1)
    order = np.argsort(candidates, axis=1, kind="stable")
    twice = np.zeros(candidates.shape, bool)
    np.put_along_axis(twice, order[:, 1:], out[:, 1:] == out[:, :-1], axis=1)
    far[(candidates < 0) | twice | (candidates == own[:, None])] = np.inf
    order = np.argsort(far, axis=1, kind="stable")
    candidates, far = np.take_along_axis(candidates, order, 1), np.take_along_axis(far, order, 1)
    where = points[np.maximum(candidates, 0)]
    norms = np.einsum("bij,bij->bi", where, where)
    kept = np.full((len(own), DEGREE), -1, np.int64)
    open_far = far.copy()
    each = np.arange(len(own))
    for k in range(DEGREE):
        at = open_far.argmin(axis=1)
        live = np.isfinite(open_far[each, at])
        if not live.any():
            break
        kept[live, k] = candidates[each, at][live]
        chosen = where[each, at]
        between = norms + norms[each, at][:, None] - 2 * np.einsum("bij,bj->bi", where, chosen)
        open_far[(RELAX**2 * between <= far) & live[:, None]] = np.inf
        open_far[each, at] = np.inf
    return kept


def build(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edges, starts) of a graph over the points."""
    count = len(points)
    middle = points.mean(axis=0)
    gap = points - middle
    order = np.random.default_rng(count).permutation(count)
    medoid = int(np.einsum("ij,ij->i", gap, gap).argmin())
    order = np.concatenate([[medoid], order[order != medoid]])
    starts = order[:STARTS]
    edges = np.full((count, DEGREE), -1, np.int64)
    entered = min(count, STARTS)
    if entered > 1:  # the starting points know each other
        own = order[:entered]
        edges[own] = prune(points, own, np.broadcast_to(own, (entered, entered)).copy())
    while entered < count:
        batch = order[entered : entered + min(BATCH, entered)]
        ids, _, visited = beam_search(points, edges, starts, points[batch], BUILD_BEAM)
        fresh = prune(points, batch, np.concatenate([ids, visited], axis=1))
        edges[batch] = fresh
        _add_back(points, edges, batch, fresh)
        entered += len(batch)
    return edges, starts


def _add_back(points: np.ndarray, edges: np.ndarray, batch: np.ndarray, fresh: np.ndarray) -> None:
    """Edges to the new points from those they point at, pruned where too many."""
    rows, cols = np.nonzero(fresh >= 0)
    heads, tails = fresh[rows, cols], batch[rows]
    order = np.argsort(heads, kind="stable")
    heads, tails = heads[order], tails[order]
    own, firsts, sizes = np.unique(heads, return_index=True, return_counts=True)
    for start in range(0, len(own), BATCH):
        part = slice(start, start + BATCH)
        width = int(sizes[part].max())
        more = np.full((len(own[part]), width), -1, np.int64)
        for k, (a, n) in enumerate(zip(firsts[part], sizes[part])):
            more[k, :n] = tails[a : a + n]
        both = np.concatenate([edges[own[part]], more], axis=1)
        room = (both >= 0).sum(axis=1) <= DEGREE
        if room.any():
            packed = -np.sort(-both[room], axis=1)[:, :DEGREE]
            edges[own[part][room]] = packed
        if not room.all():
            edges[own[part][~room]] = prune(points, own[part][~room], both[~room])


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) with whole, finite, non-zero vectors and an id; repeated rows once."""
    v = F.col(vector).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull())
        .select(F.col(key).cast("long").alias("id"), v.alias("v"))
        .filter(F.coalesce(sound, F.lit(False)) & F.exists("v", lambda x: x != 0))
        .distinct()
    )


def index(rows: DataFrame, steps: Steps, nearest: int = NEAREST) -> tuple[DataFrame, int]:
    """The stored graphs, a row per shard and dimension, and the number of shards.

    Equal vectors are one point that carries its ``nearest + 1`` smallest ids:
    no answer can hold more of them.
    """
    ship_package(rows.sparkSession)
    first = Window.partitionBy("v").orderBy("id")
    points = (
        rows.withColumn("n", F.row_number().over(first))
        .filter(F.col("n") <= nearest + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    points = steps.put(points, "points")
    count = points.count()
    shards = max(1, -(-count // min(LARGEST, max(SHARD, count // SHARDS))))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))

    def graph(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.iloc[group["ids"].map(lambda x: x[0]).argsort(kind="stable")]
        exact = np.stack(group["v"].to_list())
        edges, starts = build(exact.astype(np.float32))
        sizes = group["ids"].map(len).to_numpy(np.int32)
        return pd.DataFrame(
            {
                "shard": [key[0]],
                "dim": [key[1]],
                "points": [exact.tobytes()],
                "edges": [edges.astype(np.int32).tobytes()],
                "starts": [starts.astype(np.int32).tobytes()],
                "sizes": [sizes.tobytes()],
                "ids": [np.concatenate(group["ids"].to_list()).astype(np.int64).tobytes()],
            }
        )

    built = dealt.groupBy("shard", F.size("v").alias("dim")).applyInPandas(
        graph,
        "shard int, dim int, points binary, edges binary, starts binary, sizes binary, ids binary",
    )
    graphs = steps.put(built, "index")
    steps.drop("points")
    return graphs, shards


def search(graphs: DataFrame, shards: int, queries: DataFrame, nearest: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score) for rows (id, v) of ``queries``."""
    ship_package(graphs.sparkSession)
    blocks = max(1, -(-queries.count() // BLOCK))
    asked = queries.select(
        "id",
        "v",
        F.size("v").alias("dim"),
        F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )
    met = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
        {"query_id": "int64", "vec_id": "int64", "score": "float64"}
    )

    def look(graph: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(graph) or not len(block):
            return empty
        row = graph.iloc[0]
        exact = np.frombuffer(row["points"]).reshape(-1, row["dim"])
        edges = np.frombuffer(row["edges"], np.int32).astype(np.int64).reshape(-1, DEGREE)
        starts = np.frombuffer(row["starts"], np.int32).astype(np.int64)
        sizes = np.frombuffer(row["sizes"], np.int32)
        ids = np.split(np.frombuffer(row["ids"], np.int64), np.cumsum(sizes)[:-1])
        points = exact.astype(np.float32)
        out = []
        for start in range(0, len(block), BATCH):
            part = block.iloc[start : start + BATCH]
            targets = np.stack(part["v"].to_list())
            beams, _, _ = beam_search(
                points, edges, starts, targets.astype(np.float32), max(SEARCH_BEAM, nearest + 1)
            )
            for own, target, beam in zip(part["id"], targets, beams):
                beam = beam[beam >= 0]
                score = np.sqrt(((exact[beam] - target) ** 2).sum(axis=1))
                found = [(s, i) for s, p in zip(score.tolist(), beam) for i in ids[p] if i != own]
                out += [(own, i, s) for s, i in sorted(found)[:nearest]]
        return pd.DataFrame(out, columns=list(empty.columns)).astype(dict(empty.dtypes))

    found = (
        met.groupBy("dim", "shard", "block")
        .cogroup(asked.groupBy("dim", "shard", "block"))
        .applyInPandas(look, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = found.withColumn("rank", F.row_number().over(order))
    return best.filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def neighbours(
    vectors: DataFrame,
    is_query,
    key: str = "vec_id",
    vector: str = "embedding",
    nearest: int = NEAREST,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of every row for which
    the condition ``is_query`` holds, over all other rows.

    Rows with a null id, and vectors that are null, empty, zero or hold a null or
    non-finite component, take no part. Vectors of another dimension are no
    candidates. Ties go to the smaller id; repeated rows count once; of an id
    with several vectors each is searched and the nearest of all count. With
    fewer candidates than asked for all are given; an empty table gives no rows.
    """
    steps = Steps(vectors.sparkSession, "ann")
    rows = steps.put(usable(vectors, key, vector), "rows")
    asked = steps.put(usable(vectors.filter(is_query), key, vector), "queries")
    graphs, shards = index(rows, steps, nearest)
    found = steps.put(search(graphs, shards, asked, nearest), "found")
    steps.drop("rows", "queries", "index")
    return found
