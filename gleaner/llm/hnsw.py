"""Largest inner products by hierarchical navigable small-world graphs, one per shard, merged.

Equal vectors are one node (with the smallest ids that a result could need). Nodes are dealt to shards of about ``SHARD_ROWS`` by
hash; each shard becomes one index row with its vectors and one flat neighbour array per layer, written to the shared folder. For
the graph a vector gets one more coordinate that makes all lengths of a shard equal, so that the largest inner product is the
nearest neighbour. Nodes are numbered by falling layer, so layer l is the first n_l nodes; layers are built from the top, in batches
that search the graph so far. Queries go to every shard in slices; each shard sends its best k, scored exactly, and the best k of
those stay.

Defined cases: vectors that are null, empty, all zero or hold null, NaN or infinite components take no part, as query or candidate,
and rows without an id neither; of rows repeating an id, the one with the smallest vector counts; vectors of another dimension than
the query's are no candidates; ties go to the smaller id; with fewer candidates than k all are returned; an empty table gives none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import settle

SHARD_ROWS = 8192
SLICE_ROWS = 2048
DEGREE, BUILD_WIDTH, SEARCH_WIDTH = 16, 64, 112
FIRST_BATCH, BATCH, BLOCK, STEPS = 256, 1024, 256, 4


def spread_neighbours(base: np.ndarray, own: np.ndarray, cand: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """For each row of ``own`` vectors, up to ``degree`` of its candidates (-1: none), sorted so that one closer to an already chosen
    neighbour than to the node waits until the others are served."""
    order = np.argsort(-sims, axis=1, kind="stable")
    cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
    rows, width = cand.shape
    vectors = base[np.maximum(cand, 0)]
    mutual = vectors @ vectors.transpose(0, 2, 1)
    chosen, count = np.zeros((rows, width), dtype=bool), np.zeros(rows, dtype=np.int64)
    for j in range(width):
        hidden = ((mutual[:, j] > sims[:, j, None]) & chosen).any(axis=1)
        take = (cand[:, j] >= 0) & ~hidden & (count < degree)
        chosen[:, j] = take
        count += take
    rank = np.where(chosen, 0, np.where(cand >= 0, 1, 2)) * width + np.arange(width)
    first = np.argsort(rank, axis=1, kind="stable")[:, :degree]
    found = np.take_along_axis(cand, first, 1)
    if found.shape[1] < degree:
        found = np.pad(found, ((0, 0), (0, degree - found.shape[1])), constant_values=-1)
    return found.astype(np.int32)


def beam_search(base: np.ndarray, graph: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` best nodes found per query (-1: none) and their inner products, best first; ``entries`` is one node per query."""
    found = [_beam(base, graph, queries[i : i + BLOCK], entries[i : i + BLOCK], width) for i in range(0, len(queries), BLOCK)]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _beam(base, graph, queries, entries, width):
    q, n = len(queries), len(graph)
    ids, sims, opened = np.full((q, width), -1, dtype=np.int64), np.full((q, width), -np.inf), np.zeros((q, width), dtype=bool)
    seen = np.zeros((q, n), dtype=bool)
    ids[:, 0], sims[:, 0] = entries, np.einsum("ij,ij->i", base[entries], queries)
    seen[np.arange(q), entries] = True
    active = np.arange(q)
    while len(active):
        open_sims = np.where(opened[active] | (ids[active] < 0), -np.inf, sims[active])
        steps = min(STEPS, width)
        picks = np.argpartition(-open_sims, steps - 1, axis=1)[:, :steps]
        real = np.take_along_axis(open_sims, picks, 1) > -np.inf
        live = real.any(axis=1)
        active, picks, real = active[live], picks[live], real[live]
        if not len(active):
            break
        opened[active[:, None], picks] |= real
        nodes = np.where(real, ids[active[:, None], picks], -1)
        owner, new = [], []
        for s in range(steps):
            near = np.where(nodes[:, s, None] >= 0, graph[np.maximum(nodes[:, s], 0)], -1)
            r, c = np.nonzero(near >= 0)
            to = near[r, c]
            fresh = ~seen[active[r], to]
            r, to = r[fresh], to[fresh]
            seen[active[r], to] = True
            owner.append(r)
            new.append(to)
        owner, new = np.concatenate(owner), np.concatenate(new)
        if not len(new):
            continue
        got = np.einsum("ij,ij->i", base[new], queries[active[owner]])
        order = np.argsort(owner, kind="stable")
        owner, new, got = owner[order], new[order], got[order]
        counts = np.bincount(owner, minlength=len(active))
        column = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        more = int(counts.max())
        more_ids, more_sims = np.full((len(active), more), -1, dtype=np.int64), np.full((len(active), more), -np.inf)
        more_ids[owner, column], more_sims[owner, column] = new, got
        all_ids, all_sims = np.concatenate([ids[active], more_ids], axis=1), np.concatenate([sims[active], more_sims], axis=1)
        all_open = np.concatenate([opened[active], np.zeros_like(more_ids, dtype=bool)], axis=1)
        best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids[active], sims[active], opened[active] = (np.take_along_axis(x, best, 1) for x in (all_ids, all_sims, all_open))
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _build_layer(base: np.ndarray, upper: list[np.ndarray], degree: int, width: int) -> np.ndarray:
    """Neighbour array of the layer of all rows of ``base``; ``upper`` are the finished layers above, top first."""
    n, room = len(base), 2 * degree
    graph = np.full((n, room), -1, dtype=np.int32)
    at = 0
    while at < n:
        # The first batch holds all nodes of the layer above, which the ways down end at.
        to = min(n, at + BATCH if at else max(FIRST_BATCH, len(upper[-1]) if upper else 0))
        batch = base[at:to]
        mutual = batch @ batch.T
        np.fill_diagonal(mutual, -np.inf)
        mates = min(width, to - at - 1)
        parts = []
        if mates > 0:
            top = np.argpartition(-mutual, mates - 1, axis=1)[:, :mates]
            parts.append((top + at, np.take_along_axis(mutual, top, 1)))
        if at:
            parts.append(beam_search(base[:at], graph[:at], batch, _descend(base, upper, batch), width))
        if parts:
            cand, sims = np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts], axis=1)
            keep = min(width, cand.shape[1])
            top = np.argpartition(-sims, keep - 1, axis=1)[:, :keep]
            chosen = spread_neighbours(base, batch, np.take_along_axis(cand, top, 1), np.take_along_axis(sims, top, 1), degree)
            graph[at:to, :degree] = chosen
            _link_back(base, graph, chosen, at, room, width)
        at = to
    return graph


def _link_back(base: np.ndarray, graph: np.ndarray, chosen: np.ndarray, at: int, room: int, width: int) -> None:
    """Give each chosen neighbour a link to the node that chose it; full lists are chosen anew."""
    r, c = np.nonzero(chosen >= 0)
    source, target = r + at, chosen[r, c].astype(np.int64)
    own = graph[np.unique(target)]
    old_t, old_c = np.nonzero(own >= 0)
    target = np.concatenate([target, np.unique(target)[old_t]])
    source = np.concatenate([source, own[old_t, old_c]])
    pair = np.unique(target * len(graph) + source)
    target, source = pair // len(graph), pair % len(graph)
    sims = np.einsum("ij,ij->i", base[target], base[source])
    order = np.lexsort((-sims, target))
    target, source, sims = target[order], source[order], sims[order]
    nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
    column = np.arange(len(target)) - np.repeat(first, counts)
    row = np.repeat(np.arange(len(nodes)), counts)
    fit = column < max(width, room)
    wide = int(min(max(width, room), counts.max()))
    cand, close = np.full((len(nodes), wide), -1, dtype=np.int64), np.full((len(nodes), wide), -np.inf)
    cand[row[fit], column[fit]], close[row[fit], column[fit]] = source[fit], sims[fit]
    small = counts <= room
    graph[nodes[small]] = -1
    graph[nodes[small], : min(room, wide)] = cand[small, :room]
    full = np.flatnonzero(~small)
    for i in range(0, len(full), BLOCK):
        f = full[i : i + BLOCK]
        graph[nodes[f]] = spread_neighbours(base, base[nodes[f]], cand[f], close[f], room)


def _descend(base: np.ndarray, layers: list[np.ndarray], queries: np.ndarray) -> np.ndarray:
    """Entry nodes for the layer below ``layers`` (top first): the best node found on the way down."""
    at = np.zeros(len(queries), dtype=np.int64)
    for graph in layers:
        at = beam_search(base[: len(graph)], graph, queries, at, 8)[0][:, 0]
    return at


def equal_lengths(vectors: np.ndarray) -> np.ndarray:
    """The vectors scaled by one factor, with a coordinate that makes every length one."""
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    longest = norms.max()
    scaled = vectors / longest
    lifted = np.concatenate([scaled, np.sqrt(np.maximum(0.0, 1 - (norms / longest) ** 2))[:, None]], axis=1)
    return lifted.astype(np.float32) if longest < 100 * np.median(norms) else lifted


def build_graph(vectors: np.ndarray, seed: int = 3, degree: int = DEGREE, width: int = BUILD_WIDTH) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of nodes (by falling layer) and the layers' neighbour arrays, top first."""
    n = len(vectors)
    u = np.random.default_rng(seed).random(n)
    layer = np.floor(-np.log(np.maximum(u, 1e-300)) / math.log(degree)).astype(np.int64)
    order = np.argsort(-layer, kind="stable")
    base, layers = equal_lengths(vectors[order]), []
    for level in range(int(layer.max()), -1, -1):
        members = int((layer >= level).sum())
        layers.append(_build_layer(base[:members], layers, degree if level == 0 else max(4, degree // 2), width))
    return order, layers


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products summed in component order, so equal vectors give equal scores wherever they stand."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


INDEX = "shard long, dim int, vectors binary, ids binary, ends binary, sizes binary, layers binary"


def _build_rows(table: pa.Table) -> pa.Table:
    dims = np.asarray(table.column("dim"))
    rows = []
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        own = table.take(at)
        vectors = np.array(own.column("v").combine_chunks().flatten()).reshape(-1, int(dim))
        order, layers = build_graph(vectors)
        ids = [own.column("ids")[int(i)].as_py() for i in order]
        rows.append({
            "shard": table.column("shard")[0].as_py(), "dim": int(dim), "vectors": vectors[order].tobytes(), "ids": np.array([x for i in ids for x in i]).tobytes(),
            "ends": np.cumsum([len(i) for i in ids]).astype(np.int64).tobytes(), "sizes": np.array([g.shape for g in layers], dtype=np.int64).tobytes(),
            "layers": np.concatenate([g.ravel() for g in layers]).astype(np.int32).tobytes(),
        })
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
    names = [c.split()[0] for c in INDEX.split(", ")]
    return pa.table([pa.array([r[c] for r in rows], t) for c, t in zip(names, types, strict=True)], names=names)


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id and v (array of doubles) of the rows that take part."""
    v = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & (F.size("v") > 0))
    inf = F.lit(float("inf"))
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def build_index(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """One row per shard (and dimension) of ``rows`` (vec_id, v), and the number of shards. Equal vectors keep their k + 1 smallest ids:
    no result of k can hold more."""
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    nodes = rows.withColumn("place", first).where(F.col("place") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    nodes = settle(nodes.select("v", "ids", F.size("v").alias("dim")), "vector-nodes")
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("long"))
    return settle(dealt.groupBy("shard").applyInArrow(_build_rows, INDEX), "hnsw-index"), shards


def search_index(index: DataFrame, shards: int, queries: DataFrame, k: int, width: int = SEARCH_WIDTH) -> DataFrame:
    """query_id, rank, vec_id, score: the k best found for each of ``queries`` (vec_id, v), itself left out."""
    slices = max(1, -(-queries.count() // SLICE_ROWS))
    asked = queries.select(
        F.col("vec_id").alias("query_id"), "v", F.pmod(F.xxhash64("vec_id"), F.lit(slices)).cast("int").alias("slice"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
    )
    held = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[list[int], list[int], list[float]]] = []
        sizes = np.array([len(v) for v in right.column("v").to_pylist()]) if right.num_rows else np.zeros(0, dtype=np.int64)
        for row in left.to_pylist():
            own = right.take(np.flatnonzero(sizes == row["dim"]))
            if own.num_rows:
                found.append(_search(row, np.asarray(own.column("query_id")), np.array(own.column("v").combine_chunks().flatten()).reshape(-1, row["dim"]), k, width))
        flat = [[x for f in found for x in f[i]] for i in range(3)]
        return pa.table([pa.array(flat[0], pa.int64()), pa.array(flat[1], pa.int64()), pa.array(flat[2], pa.float64())], names=["query_id", "vec_id", "score"])

    parts = held.groupBy("shard", "slice").cogroup(asked.groupBy("shard", "slice")).applyInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return parts.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(row: dict, query_ids: np.ndarray, queries: np.ndarray, k: int, width: int) -> tuple[list[int], list[int], list[float]]:
    vectors = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
    ids, ends = np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["ends"], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    flat, layers, at = np.frombuffer(row["layers"], dtype=np.int32), [], 0
    for n, degree in np.frombuffer(row["sizes"], dtype=np.int64).reshape(-1, 2):
        layers.append(flat[at : at + n * degree].reshape(n, degree))
        at += n * degree
    base = equal_lengths(vectors)
    norms = np.sqrt(np.einsum("ij,ij->i", queries, queries))
    lifted = np.concatenate([queries / norms[:, None], np.zeros((len(queries), 1))], axis=1).astype(base.dtype)
    nodes, _ = beam_search(base, layers[-1], lifted, _descend(base, layers[:-1], lifted), min(width, len(vectors)))
    out: tuple[list[int], list[int], list[float]] = ([], [], [])
    owner, column = np.nonzero(nodes >= 0)
    node = nodes[owner, column]
    score = exact_products(vectors[node], queries[owner])
    order = np.lexsort((ids[starts[node]], -score, owner))
    owner, node, score = owner[order], node[order], score[order]
    bounds = np.searchsorted(owner, np.arange(len(queries) + 1))
    for q in range(len(queries)):
        rows = []
        for i in range(bounds[q], min(bounds[q] + k + 1, bounds[q + 1])):
            rows += [(-score[i], int(x)) for x in ids[starts[node[i]] : ends[node[i]]] if x != query_ids[q]]
        for s, x in sorted(rows)[:k]:
            out[0].append(int(query_ids[q]))
            out[1].append(x)
            out[2].append(float(-s))
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, shard_rows: int = SHARD_ROWS, width: int = SEARCH_WIDTH) -> DataFrame:
    """Index every usable row and search it for those with ``is_query`` (an expression over vec_id)."""
    rows = settle(usable(vectors), "usable-vectors")
    index, shards = build_index(rows, k, shard_rows)
    return search_index(index, shards, rows.where(is_query), k, width)


def op6_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
