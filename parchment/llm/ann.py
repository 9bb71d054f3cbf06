"""Approximate nearest neighbours over robust-pruned directed graphs, one for each shard.

Vectors are dealt to shards by their hash. A shard's graph starts from random edges; greedy beam
searches from its medoid propose neighbours for every vector, and relaxed distance pruning keeps a
proposal only if no kept neighbour is nearer to it by the factor ``ALPHA``, which leaves diverse,
navigable edges. Reverse edges are added and pruned alike; two rounds, as for the published
algorithm. Queries, in blocks, are searched by beam in every shard, and the shards' best merge by
exact cosine in double precision. A task holds the graphs of a few shards (HELD bytes) while blocks
of queries pass by, so that a block is sent once for each task and never with a graph beside it.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part,
neither as queries nor as candidates; equal vectors share a node, whose smallest K + 1 ids can be
answers (any more could not be among K, with one of them the query itself); a vector of another
length is in a shard of its length; fewer candidates than K give fewer rows; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, stage_table, table

#: Beams of a build and of a query.
K, DEGREE, BEAM, SEARCH_BEAM, ALPHA = 5, 24, 48, 128, 1.2
SHARD, QUERY_BLOCK, BATCH = 4096, 256, 256
#: Bytes of graphs and vectors that a task of the search holds, and the most shards of one task.
HELD, SHARDS_HELD = 128 << 20, 32


def beam_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, start: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of a beam for each query, by expanding the nearest unexpanded node of all queries at once."""
    m, n = len(queries), len(x)
    rows = np.arange(m)[:, None]
    ids = np.broadcast_to(start, (m, len(start))).copy()
    dist = 1.0 - np.einsum("md,mkd->mk", queries, x[ids])
    seen = np.zeros((m, n + 1), bool)
    seen[rows, ids] = True
    done = np.zeros(ids.shape, bool)
    while True:
        open_dist = np.where(done, np.inf, dist)
        best = open_dist.argmin(axis=1)
        live = np.isfinite(open_dist[np.arange(m), best])
        if not live.any():
            return ids, dist
        at = np.flatnonzero(live)
        done[at, best[at]] = True
        near = graph[ids[at, best[at]]]
        fresh = (near >= 0) & ~seen[at[:, None], near]
        seen[at[:, None], np.where(fresh, near, n)] = True
        found = np.where(fresh, 1.0 - np.einsum("md,mkd->mk", queries[at], x[near]), np.inf)
        all_ids = np.concatenate((ids, np.full((m, near.shape[1]), -1, ids.dtype)), axis=1)
        all_dist = np.concatenate((dist, np.full((m, near.shape[1]), np.inf, dist.dtype)), axis=1)
        all_done = np.concatenate((done, np.zeros((m, near.shape[1]), bool)), axis=1)
        all_ids[at, ids.shape[1] :], all_dist[at, ids.shape[1] :] = np.where(fresh, near, -1), found  # one seen before would be there twice while a beam is not full
        width = min(beam, all_ids.shape[1])
        keep = np.argpartition(all_dist, width - 1, axis=1)[:, :width]
        ids, dist, done = (np.take_along_axis(a, keep, axis=1) for a in (all_ids, all_dist, all_done))
        done |= ~np.isfinite(dist)


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Diverse neighbours of each point among its candidates (-1: none)."""
    m = len(points)
    dist = 1.0 - np.einsum("md,mkd->mk", x[points], x[candidates])
    dist[(candidates < 0) | (candidates == points[:, None])] = np.inf
    order = np.argsort(dist, axis=1, kind="stable")
    candidates, dist = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(dist, order, axis=1)
    dist[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = np.inf
    near = x[candidates]
    between = 1.0 - np.matmul(near, near.transpose(0, 2, 1))
    out = np.full((m, degree), -1, np.int32)
    every = np.arange(m)
    for r in range(degree):
        best = dist.argmin(axis=1)
        ok = np.isfinite(dist[every, best])
        if not ok.any():
            break
        out[ok, r] = candidates[every, best][ok]
        drop = alpha * between[every, best] <= dist
        drop[every, best] = True
        dist[ok] = np.where(drop[ok], np.inf, dist[ok])
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """Neighbour table and entry points of a shard's unit vectors."""
    n = len(x)
    rng = np.random.default_rng(n)
    graph = np.full((n, degree), -1, np.int32)
    if n > 1:
        graph[:, : min(degree, 8)] = rng.integers(0, n, (n, min(degree, 8)))
    medoid = int((x @ x.mean(axis=0)).argmax()) if n else 0
    start = np.unique(np.concatenate(([medoid], rng.integers(0, max(n, 1), 3))))[:n]
    for factor in (1.0, alpha):
        for batch in np.array_split(rng.permutation(n), max(1, -(-n // BATCH))):
            if not len(batch):
                continue
            found, _ = beam_search(x, graph, x[batch], start, beam)
            fresh = robust_prune(x, batch, np.concatenate((found.astype(np.int32), graph[batch]), axis=1), degree, factor)
            graph[batch] = fresh
            back = fresh.ravel()
            to, of = back[back >= 0], np.repeat(batch, degree)[back >= 0]
            order = np.argsort(to, kind="stable")
            to, of = to[order], of[order]
            heads, first, count = np.unique(to, return_index=True, return_counts=True)
            for part in np.array_split(np.arange(len(heads)), max(1, -(-len(heads) // BATCH))):
                more = np.full((len(part), count[part].max(initial=1)), -1, np.int32)
                spread = np.repeat(first[part], count[part]) + (np.arange(count[part].sum()) - np.repeat(np.cumsum(count[part]) - count[part], count[part]))
                more[np.repeat(np.arange(len(part)), count[part]), spread - np.repeat(first[part], count[part])] = of[spread]
                graph[heads[part]] = robust_prune(x, heads[part], np.concatenate((graph[heads[part]], more), axis=1), degree, factor)
    return graph, start


def usable(vector: F.Column) -> F.Column:
    ok = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return vector.isNotNull() & F.forall(vector, ok) & F.exists(vector, lambda v: v != 0)


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, shard_size: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query, itself left out. ``queries`` are rows of ``vectors``."""
    clean = lambda df: df.select(F.col(id_col).cast("bigint").alias("id"), F.transform(vec_col, lambda v: v.cast("double")).alias("v")).where(usable(F.col("v"))).withColumn("v", F.transform("v", lambda v: v + F.lit(0.0)))
    rows = clean(vectors).withColumn("h", F.xxhash64("v"))
    total, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    shards = max(1, -(-total // shard_size))
    bounded_batches(vectors.sparkSession)
    shard = F.concat_ws("/", F.size("v").cast("string"), F.pmod("h", F.lit(shards)).cast("string"))
    first = rows.withColumn("r", F.row_number().over(W.partitionBy("h", "v").orderBy("id"))).where(F.col("r") <= k + 1)
    index_schema = "shard string, dim int, ids binary, nodes binary, vectors binary, graph binary, entry binary"

    def index(key: tuple, data: pa.Table) -> pa.Table:
        ids = data.column("id").to_numpy()
        dim = len(data.column("v")[0])
        flat = data.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        order = np.argsort(ids, kind="stable")
        ids, flat = ids[order], flat[order]
        node_rows, node = np.unique(flat, axis=0, return_inverse=True)
        unit = (node_rows / np.linalg.norm(node_rows, axis=1, keepdims=True)).astype(np.float32)
        graph, entry = build_graph(unit)
        blobs = [ids.astype("<i8"), node.reshape(-1).astype("<i4"), node_rows.astype("<f8"), graph.astype("<i4"), entry.astype("<i4")]
        return pa.table({"shard": [key[0].as_py()], "dim": pa.array([dim], pa.int32()), **{n: pa.array([b.tobytes()], pa.binary()) for n, b in zip(("ids", "nodes", "vectors", "graph", "entry"), blobs, strict=True)}})

    indexed = stage_table(first.withColumn("shard", shard).select("shard", "id", "v").groupBy("shard").applyInArrow(index, index_schema))

    q = clean(queries).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-total // (50 * QUERY_BLOCK)))))).withColumn("dim", F.size("v"))
    block_schema = "block bigint, dim int, q_ids binary, q_vectors binary"

    def pack(key: tuple, data: pa.Table) -> pa.Table:
        flat = data.column("v").combine_chunks().flatten().to_numpy()
        return pa.table({"block": [key[0].as_py()], "dim": pa.array([key[1].as_py()], pa.int32()), "q_ids": pa.array([data.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()), "q_vectors": pa.array([flat.astype("<f8").tobytes()], pa.binary())})

    blocks = q.select("block", "dim", "id", "v").groupBy("block", "dim").applyInArrow(pack, block_schema)
    held = max(1, min(SHARDS_HELD, HELD // (shard_size * (12 * (width or 1) + 4 * DEGREE))))
    tasks = max(-(-shards // held), min(shards, vectors.sparkSession.sparkContext.defaultParallelism))
    task = F.pmod(F.split_part("shard", F.lit("/"), F.lit(2)).cast("int"), F.lit(tasks))
    aimed = blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).withColumn("late", F.lit(1))
    sent = indexed.withColumn("task", task).withColumn("late", F.lit(0)).unionByName(aimed, allowMissingColumns=True)
    out_schema = "query_id bigint, vec_id bigint, score double"

    def opened(row: dict) -> tuple:
        d = row["dim"]
        ids, node = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["nodes"], "<i4")
        own = np.frombuffer(row["vectors"], "<f8").reshape(-1, d)
        unit = (own / np.linalg.norm(own, axis=1, keepdims=True)).astype(np.float32)
        order = np.argsort(node, kind="stable")  # ids of a node stay ascending
        low = np.searchsorted(node[order], np.arange(len(own)))
        return d, ids[order], low, np.append(low[1:], len(node)) - low, own, unit, np.frombuffer(row["graph"], "<i4").reshape(-1, DEGREE), np.frombuffer(row["entry"], "<i4")

    def in_shard(graph: tuple, q_ids: np.ndarray, q_rows: np.ndarray, out: list) -> None:
        """The best of one shard for each query, appended to its list of (vec_id, score)."""
        _, ids, low, size, own, unit, edges, entry = graph
        for a in range(0, len(q_ids), BATCH):
            qv = q_rows[a : a + BATCH]
            found, _ = beam_search(unit, edges, (qv / np.linalg.norm(qv, axis=1, keepdims=True)).astype(np.float32), entry, SEARCH_BEAM)
            for i, query in enumerate(q_ids[a : a + BATCH]):
                nodes = found[i][found[i] >= 0]
                near = own[nodes]
                score = (near * qv[i]).sum(axis=1) / (np.sqrt((near * near).sum(axis=1)) * np.sqrt((qv[i] * qv[i]).sum()))
                vec = np.concatenate([ids[low[x] : low[x] + size[x]] for x in nodes]) if len(nodes) else np.empty(0, np.int64)
                score = np.repeat(score, size[nodes])
                vec, score = vec[vec != query], score[vec != query]
                top = np.lexsort((vec, -score))[:k]
                out[a + i].append((vec[top], score[top]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, graphs = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["task"] != now:
                    now, graphs = row["task"], []
                if not row["late"]:
                    graphs.append(opened(row))
                    continue
                q_ids = np.frombuffer(row["q_ids"], "<i8")
                q_rows = np.frombuffer(row["q_vectors"], "<f8").reshape(-1, row["dim"])
                found: list[list] = [[] for _ in q_ids]
                for graph in graphs:
                    if graph[0] == row["dim"]:
                        in_shard(graph, q_ids, q_rows, found)
                out: list[list] = [[], [], []]
                for query, parts in zip(q_ids.tolist(), found, strict=True):
                    if parts:
                        vec, score = (np.concatenate(z) for z in zip(*parts, strict=True))
                        top = np.lexsort((vec, -score))[:k]
                        out[0] += [query] * len(top)
                        out[1] += vec[top].tolist()
                        out[2] += score[top].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

    hits = sent.repartition(tasks, "task").sortWithinPartitions("task", "late").mapInArrow(search, out_schema)
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"))
