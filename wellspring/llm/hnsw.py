"""Approximate nearest neighbours: a navigable small-world graph per shard.

Equal vectors are merged (with the smallest ids a result can need), dealt to
shards of about ``SHARD_ROWS`` (fewer where they would pass ``SHARD_BYTES``) by a hash, and each shard is indexed as a
hierarchy of graphs: all its vectors at the bottom, about 1 in 16 of each level
above. A level is stored as one flat neighbour array (node by ``M`` slots, -1: empty).

Largest inner product becomes nearest by angle with one more coordinate
that gives all vectors of a shard the same length (0 in queries), so graph edges,
chosen to be near and diverse, serve vectors of any length.

Nodes are inserted in batches: a batch searches the graph so far, all at once in
numpy, looks at its own members exactly, chooses edges, and its neighbours
take the edges back, pruned where full. Queries are searched in blocks against
every shard the same way with a beam of ``EF_SEARCH``, and the shards' best are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm._stage import store, table, take
from wellspring.operators import skew_join

K, QUERY_MODULUS = 20, 20
SHARD_ROWS, SHARD_BYTES, BLOCK_QUERIES = 32768, 64 << 20, 2048
FEW_DIMS = 10_000  # so many numbers of dimensions may be broadcast, with a few numbers each
M, EF_BUILD, EF_SEARCH = 16, 96, 160
FIRST = 256  # inserted exactly
OPENS = 4  # nodes a query opens at a time
NODES_AT_ONCE = 512


# --- graph ------------------------------------------------------------------------------

def levels_of(n: int, seed: int = 7) -> np.ndarray:
    """Each node's top level: geometric with ratio 1 / M."""
    u = np.random.default_rng(seed).random(n)
    return np.floor(-np.log(np.maximum(u, 1e-12)) / np.log(M)).astype(np.int64)


def unit_scale(vectors: np.ndarray) -> np.ndarray:
    """The vectors in single precision, divided by their largest component: graphs are walked with these."""
    return (vectors / max(np.abs(vectors).max(initial=0.0), 1e-300)).astype(np.float32)


def beam_search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, ef: int) \
        -> tuple[np.ndarray, np.ndarray]:
    """For every query the ``ef`` nearest found (-1: none) and their products, nearest first.

    ``links`` is the flat neighbour array, ``entries`` (query by any) the nodes to start at, each once (-1: none).
    Every round, each query opens its ``OPENS`` nearest nodes that are not yet open."""
    q, n, width = len(queries), len(vectors), links.shape[1]
    beam = np.full((q, ef), -1, np.int64)
    score = np.full((q, ef), -np.inf, np.float32)
    opened = np.ones((q, ef), bool)
    seen = np.zeros((q, n + 1), bool)  # the last column is for empty slots
    seen[:, n] = True
    active, new = np.arange(q), entries
    while len(active):
        # by place, so that a neighbour of several opened nodes is met once
        at = np.sort(np.where(new >= 0, new, n), axis=1)
        fresh = ~seen[active[:, None], at]
        fresh[:, 1:] &= at[:, 1:] != at[:, :-1]
        seen[active[:, None], at] = True
        r, c = np.nonzero(fresh)
        product = np.full(at.shape, -np.inf, np.float32)
        product[r, c] = np.einsum("pd,pd->p", vectors[at[r, c]], queries[active[r]])
        nodes = np.concatenate([beam[active], np.where(fresh, at, -1)], axis=1)
        scores = np.concatenate([score[active], product], axis=1)
        done = np.concatenate([opened[active], ~fresh], axis=1)
        best = np.argpartition(-scores, ef - 1, axis=1)[:, :ef]
        beam[active] = nodes = np.take_along_axis(nodes, best, 1)
        score[active] = scores = np.take_along_axis(scores, best, 1)
        opened[active] = done = np.take_along_axis(done, best, 1)
        some = ~done.all(axis=1)
        active, nodes, waiting = active[some], nodes[some], np.where(done, -np.inf, scores)[some]
        if not len(active):
            break
        opens = min(OPENS, ef)
        first = np.argpartition(-waiting, opens - 1, axis=1)[:, :opens]
        real = np.take_along_axis(waiting, first, 1) > -np.inf
        opened[active[:, None], first] = True
        nodes = np.take_along_axis(nodes, first, 1)
        new = np.where(real[:, :, None], links[np.maximum(nodes, 0)], -1).reshape(len(active), opens * width)
    order = np.argsort(-score, axis=1, kind="stable")
    return np.take_along_axis(beam, order, 1), np.take_along_axis(score, order, 1)


def diverse(vectors: np.ndarray, candidates: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1: none) at most ``most``: those nearer to the
    row's node than to any chosen one, then the nearest of the rest."""
    candidates, near = candidates[:, :4 * most], near[:, :4 * most]
    if candidates.shape[1] <= most:
        return candidates
    x = vectors[np.maximum(candidates, 0)]
    among = x @ x.transpose(0, 2, 1)
    worst = np.full(candidates.shape, -np.inf, among.dtype)  # largest product with a chosen one
    chosen = np.zeros(candidates.shape, bool)
    for i in range(candidates.shape[1]):
        chosen[:, i] = fine = (worst[:, i] < near[:, i]) & (candidates[:, i] >= 0)
        np.maximum(worst, among[:, i], out=worst, where=fine[:, None])
    order = np.argsort(np.where(candidates < 0, 2, ~chosen), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(candidates, order, 1)


def _connect(vectors: np.ndarray, links: np.ndarray, at: int, found: np.ndarray, near: np.ndarray) -> None:
    """Choose the edges of the nodes from ``at`` on, and let their neighbours take the edges back."""
    width = links.shape[1]
    picked = diverse(vectors, found, near, width // 2)
    links[at:at + len(found), :picked.shape[1]] = picked
    r, c = np.nonzero(picked >= 0)
    to, new = picked[r, c], at + r
    order = np.lexsort((-near[r, c], to))
    to, new = to[order], new[order]
    own, first, count = np.unique(to, return_index=True, return_counts=True)
    by_count = np.argsort(count, kind="stable")
    for i in range(0, len(own), NODES_AT_ONCE):
        some = by_count[i:i + NODES_AT_ONCE]
        place = np.arange(min(int(count[some].max()), 3 * width))
        taken = np.where(place < count[some][:, None], new[np.minimum(first[some][:, None] + place, len(new) - 1)], -1)
        both = np.concatenate([links[own[some]], taken], axis=1)
        product = np.einsum("tcd,td->tc", vectors[np.maximum(both, 0)], vectors[own[some]])
        product[both < 0] = -np.inf
        order = np.argsort(-product, axis=1, kind="stable")
        links[own[some]] = diverse(vectors, np.take_along_axis(both, order, 1), np.take_along_axis(product, order, 1), width)


def build_level(vectors: np.ndarray) -> np.ndarray:
    """The flat neighbour array of one level over all given vectors."""
    n = len(vectors)
    links = np.full((n, 2 * M), -1, np.int32)
    at = 0
    while at < n:
        size = min(n - at, FIRST if at == 0 else max(32, min(512, at // 4)))
        own = vectors[at:at + size]
        near = own @ own.T
        near[np.triu_indices(size)] = -np.inf  # edges go to earlier members of the batch
        found = np.where(near > -np.inf, np.arange(at, at + size), -1)
        if at:
            start = np.linspace(0, at - 1, 8).astype(np.int64)
            beam, score = beam_search(vectors[:at], links[:at], own, np.broadcast_to(start, (size, 8)), EF_BUILD)
            found, near = np.concatenate([beam, found], axis=1), np.concatenate([score, near], axis=1)
        order = np.argsort(-near, axis=1, kind="stable")[:, :EF_BUILD]
        _connect(vectors, links, at, np.take_along_axis(found, order, 1), np.take_along_axis(near, order, 1))
        at += size
    return links


def build_index(vectors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per level, from the bottom: the nodes on it, and their flat neighbour array (by place on the level)."""
    vectors = unit_scale(vectors)
    length = np.sum(vectors * vectors, axis=1)
    lifted = np.concatenate([vectors, np.sqrt(np.maximum(length.max(initial=0.0) - length, 0))[:, None]], axis=1)
    top, nodes, links = levels_of(len(vectors)), [], []
    for level in range(int(top.max(initial=0)) + 1):
        own = np.flatnonzero(top >= level)
        nodes.append(own.astype(np.int32))
        links.append(build_level(lifted[own]))
    return nodes, links


def search_index(vectors: np.ndarray, nodes: list[np.ndarray], links: list[np.ndarray], queries: np.ndarray,
                 ef: int = EF_SEARCH) -> np.ndarray:
    """For every query, the nodes found by a search from the top level down. ``vectors`` and ``queries``: see ``unit_scale``."""
    entries = np.broadcast_to(nodes[-1][:8].astype(np.int64), (len(queries), min(8, len(nodes[-1]))))
    for level in range(len(nodes) - 1, -1, -1):
        own = nodes[level]
        start = np.where(entries >= 0, np.searchsorted(own, entries), -1)
        beam, _ = beam_search(vectors[own], links[level], queries, start, ef if level == 0 else 8)
        entries = np.where(beam >= 0, own[np.maximum(beam, 0)], -1)
    return entries


# --- the operator -----------------------------------------------------------------------

def _usable(rows: DataFrame) -> DataFrame:
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(
        fine & F.exists("v", lambda x: x != 0))


def _by_dim(rows: DataFrame, dims: DataFrame, row_key: list[str]) -> DataFrame:
    """``rows`` with the columns of ``dims``, a row for each number of dimensions. Most tables have one number, so
    rows are not shuffled by it: ``dims`` is broadcast after a count, beyond ``FEW_DIMS`` hot numbers are cut into pieces."""
    if dims.limit(FEW_DIMS + 1).count() <= FEW_DIMS:
        return rows.join(F.broadcast(dims), "dim")
    return skew_join(rows, dims, "dim", row_key=row_key)


def _build(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values(["d1", "d2"])
    vectors = np.stack(part["v"].to_numpy())
    nodes, links = build_index(vectors)
    return pd.DataFrame([{
        "dim": part["dim"].iloc[0], "shard": part["shard"].iloc[0], "vectors": vectors.astype("<f8").tobytes(),
        "nodes": [x.tobytes() for x in nodes], "links": [x.tobytes() for x in links],
        "ids": np.concatenate(part["ids"].to_list()).tolist(), "sizes": [len(x) for x in part["ids"]]}])


INDEX = "dim int, shard long, vectors binary, nodes array<binary>, links array<binary>, ids array<long>, sizes array<int>"


def build(rows: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The stored index of ``rows(vec_id, v)``: one row per shard. An id list holds the
    smallest k + 1 ids of a vector: ties go to smaller ids, so no result needs more."""
    keyed = rows.withColumn("d1", F.xxhash64("v")).withColumn("d2", F.xxhash64(F.lit(1), "v")).withColumn("dim", F.size("v"))
    # partial top-k per task before the shuffle: a vector that a third of the rows share sends k + 1 rows a task
    rank = F.row_number().over(Window.partitionBy("dim", "d1", "d2").orderBy("vec_id"))
    firsts = keyed.dropDuplicates(["vec_id", "dim", "d1", "d2"]).withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    merged = firsts.groupBy("dim", "d1", "d2").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    merged = store(merged, "hnsw_vectors")
    most = F.greatest(F.lit(1), F.least(F.lit(shard_rows), F.floor(SHARD_BYTES / (8 * F.col("dim")))))
    shards = merged.groupBy("dim").agg(F.count("*").alias("n")).select("dim", F.ceil(F.col("n") / most).alias("shards"))
    dealt = _by_dim(merged, shards, ["d1", "d2"]).withColumn("shard", F.pmod("d2", F.col("shards")))
    # a stated number of partitions: shards are few bytes and much work, so they mustn't be coalesced;
    # by range, so that neighbouring shards don't meet in one task by their hashes while others are idle
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = dealt.repartitionByRange(parts, "dim", "shard")
    return store(spread.groupBy("dim", "shard").applyInPandas(_build, INDEX), "hnsw_index")


def _search(k: int):
    def run(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "d1": [], "d2": [], "vec_id": [], "score": []}
        if len(queries) and len(index):
            row = index.iloc[0]
            vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, int(row["dim"]))
            nodes = [np.frombuffer(x, np.int32) for x in row["nodes"]]
            links = [np.frombuffer(x, np.int32).reshape(-1, 2 * M) for x in row["links"]]
            ids, ends = np.asarray(row["ids"]), np.cumsum(row["sizes"])
            starts = ends - np.asarray(row["sizes"])
            asked, scaled = np.stack(queries["v"].to_numpy()), unit_scale(vectors)
            for i in range(0, len(asked), 512):
                one = asked[i:i + 512] / np.abs(asked[i:i + 512]).max(axis=1, keepdims=True)
                found = search_index(scaled, nodes, links, one.astype(np.float32))
                for j, near in enumerate(found, start=i):
                    near = near[near >= 0]
                    score = (vectors[near] * asked[j]).sum(axis=1)
                    size = (ends - starts)[near]
                    at = np.repeat(starts[near] - np.cumsum(size) + size, size) + np.arange(size.sum())
                    score, vec = np.repeat(score, size), ids[at]
                    own = vec != queries["vec_id"].iloc[j]
                    score, vec = score[own], vec[own]
                    best = np.lexsort((vec, -score))[:k]
                    for name, values in (("query_id", queries["vec_id"].iloc[j]), ("d1", queries["d1"].iloc[j]),
                                         ("d2", queries["d2"].iloc[j])):
                        out[name] += [values] * len(best)
                    out["vec_id"] += vec[best].tolist()
                    out["score"] += score[best].tolist()
        return pd.DataFrame(out)
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row of ``queries(vec_id,
    embedding)`` the k rows of ``vectors`` with other ids and the largest inner product
    (in double precision), ties to the smaller id.

    Vectors that are null, zero, of a null id, or hold null or non-finite components
    take no part, neither do vectors of another length than the query's. Equal
    rows count once; rows of one id with different vectors are candidates (or
    queries) each. Fewer than k candidates: all of them. Other columns are ignored.
    """
    as_double = [F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")]
    rows = _usable(take(vectors, "vec_id", "embedding").select(*as_double))
    asked = _usable(take(queries, "vec_id", "embedding").select(*as_double))
    asked = asked.withColumn("d1", F.xxhash64("v")).withColumn("d2", F.xxhash64(F.lit(1), "v")).withColumn(
        "dim", F.size("v")).dropDuplicates(["vec_id", "dim", "d1", "d2"])
    index = build(rows, k, shard_rows)
    asked = store(asked, "hnsw_queries")
    sizes = index.groupBy("dim").agg(F.count("*").alias("shards"))
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / BLOCK_QUERIES).alias("blocks"))
    dims = sizes.join(blocks, "dim")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = (_by_dim(asked, dims, ["vec_id", "d1", "d2"]).withColumn("block", F.pmod("d1", F.col("blocks")))
            .withColumn("shard", every("shards")).select("dim", "shard", "block", "vec_id", "d1", "d2", "v"))
    right = _by_dim(index, blocks, ["shard"]).withColumn("block", every("blocks")).drop("blocks")
    keys, parts = ["dim", "shard", "block"], int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, right = left.repartition(parts, *keys), right.repartition(parts, *keys)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _search(k), "query_id long, d1 long, d2 long, vec_id long, score double")
    order = Window.partitionBy("query_id", "d1", "d2").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op6_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % QUERY_MODULUS == 0))
