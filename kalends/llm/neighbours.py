"""Approximate nearest neighbours by robust-pruned directed graphs, one for each shard (operator 9)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from kalends.llm.common import stored


def augment(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more component that makes all norms equal: the largest inner product is then the least distance."""
    norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
    extra = np.sqrt(np.maximum(norms.max(initial=0) - norms, 0))
    return np.c_[vectors, extra].astype(np.float32)


def beam_search(points: np.ndarray, graph: np.ndarray, starts: np.ndarray, queries: np.ndarray, width: int, step: int = 4):
    """Best ``width`` nodes and their inner products for each query; every round the ``step`` best nodes not yet expanded are."""
    n, q = len(points), len(queries)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True  # place of missing neighbours
    seen[:, starts] = True
    beam = np.full((q, max(width, len(starts))), n)
    score = np.full(beam.shape, -np.inf, np.float32)
    beam[:, : len(starts)], score[:, : len(starts)] = starts, queries @ points[starts].T
    fresh = beam < n
    rows = np.arange(q)
    while True:
        open_score = np.where(fresh, score, -np.inf)
        picks = np.argpartition(-open_score, min(step, open_score.shape[1]) - 1, axis=1)[:, :step]
        usable = np.take_along_axis(open_score, picks, axis=1) > -np.inf
        live = np.flatnonzero(usable.any(axis=1))
        if not len(live):
            break
        np.put_along_axis(fresh, picks, False, axis=1)
        nodes = np.where(usable[live], np.take_along_axis(beam[live], picks[live], axis=1), n)
        near = np.where((nodes < n)[:, :, None], graph[np.minimum(nodes, n - 1)], n).reshape(len(live), -1)
        near = np.where(near < 0, n, near)
        near.sort(axis=1)
        new = ~seen[live[:, None], near]
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[live[:, None], near] = True
        near = np.where(new, near, n)
        found = np.full(near.shape, -np.inf, np.float32)
        r, c = np.nonzero(new)
        found[r, c] = np.einsum("ij,ij->i", points[near[r, c]], queries[live[r]])
        all_nodes, all_scores = np.c_[beam[live], near], np.c_[score[live], found]
        all_fresh = np.c_[fresh[live], new]
        keep = np.argpartition(-all_scores, beam.shape[1] - 1, axis=1)[:, : beam.shape[1]]
        beam[live], score[live] = np.take_along_axis(all_nodes, keep, axis=1), np.take_along_axis(all_scores, keep, axis=1)
        fresh[live] = np.take_along_axis(all_fresh, keep, axis=1)
    order = np.argsort(-score, axis=1, kind="stable")[:, :width]
    return beam[rows[:, None], order], score[rows[:, None], order]


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, slack: float) -> np.ndarray:
    """Edges of each node ``own`` from its row of ``candidates`` (-1: none): nearest first, and none that a kept one is ``slack`` times nearer to."""
    candidates = np.sort(candidates, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    candidates[candidates == own[:, None]] = -1
    vectors = points[candidates]
    norm = float((points[0] ** 2).sum())
    away = np.sqrt(np.maximum(2 * norm - 2 * np.einsum("bcd,bd->bc", vectors, points[own]), 0))
    between = np.sqrt(np.maximum(2 * norm - 2 * vectors @ vectors.transpose(0, 2, 1), 0))
    open_away = np.where(candidates >= 0, away, np.inf)
    out = np.full((len(own), degree), -1)
    rows = np.arange(len(own))
    for k in range(degree):
        pick = open_away.argmin(axis=1)
        live = open_away[rows, pick] < np.inf
        if not live.any():
            break
        out[live, k] = candidates[rows, pick][live]
        drop = slack * between[rows, pick] <= away
        drop[rows, pick] = True
        open_away[drop & live[:, None]] = np.inf
    return out


def build_graph(points: np.ndarray, degree: int = 32, width: int = 64, slack: float = 1.2, batch: int = 256, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Directed graph over distinct points of equal norm, and its start nodes.

    Points come in batches that double up to ``batch``: a greedy beam search on the graph so far proposes neighbours, pruning
    keeps diverse ones, and each gets the edge back, pruned again where it has too many. Starts are the point nearest to the
    mean and some others, so that separate clusters are all reached.
    """
    n = len(points)
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    medoid = int((points @ points.mean(axis=0)).argmax()) if n else 0
    order = np.r_[medoid, order[order != medoid]]
    starts = order[: min(n, 16)]
    graph = np.full((n, degree), -1)
    graph[starts, : len(starts) - 1] = np.array([[x for x in starts if x != s] for s in starts]).reshape(len(starts), -1)[:, : degree]
    done = len(starts)
    while done < n:
        new = order[done : done + min(max(done, 1), batch)]
        found, _ = beam_search(points, graph, starts, points[new], width)
        graph[new] = robust_prune(points, new, np.where(found < n, found, -1), degree, slack)
        done += len(new)
        source = np.repeat(new, degree)
        target = graph[new].reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        turn = np.argsort(target, kind="stable")
        source, target = source[turn], target[turn]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for at in np.array_split(np.arange(len(nodes)), max(1, len(nodes) // 512)):
            if not len(at):
                continue
            wide = np.full((len(at), degree + count[at].max()), -1)
            wide[:, :degree] = graph[nodes[at]]
            r = np.repeat(np.arange(len(at)), count[at])
            c = np.arange(len(r)) - np.repeat(np.cumsum(count[at]) - count[at], count[at])
            wide[r, degree + c] = source[np.repeat(first[at], count[at]) + c]
            room = (wide >= 0).sum(axis=1) <= degree
            graph[nodes[at[room]]] = -np.sort(-wide[room], axis=1)[:, :degree]
            if not room.all():
                graph[nodes[at[~room]]] = robust_prune(points, nodes[at[~room]], wide[~room], degree, slack)
    return graph.astype(np.int32), starts.astype(np.int32)


INDEX = "dim int, shard int, ids binary, vectors binary, graph binary, starts binary"


def _index_shard(kind: str, degree: int, width: int, slack: float):
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(rows["vec"].to_numpy()).astype(kind)
        ids = rows["id"].to_numpy(np.int64)
        order = np.lexsort((*vectors.T[::-1], ids)) if len(ids) else np.arange(0)
        ids, vectors = ids[order], vectors[order]
        same = np.r_[False, (ids[1:] == ids[:-1]) & (vectors[1:] == vectors[:-1]).all(axis=1)]
        ids, vectors = ids[~same], vectors[~same]
        distinct = np.unique(vectors, axis=0)
        graph, starts = build_graph(augment(distinct), degree, width, slack)
        one = {"dim": rows["dim"].iloc[0], "shard": rows["shard"].iloc[0], "ids": ids.tobytes(), "vectors": vectors.tobytes(), "graph": graph.tobytes(), "starts": starts.tobytes()}
        return pd.DataFrame([one])

    return build


def search_shard(ids: np.ndarray, vectors: np.ndarray, graph: np.ndarray, starts: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, width: int):
    """For each query the ``k`` best rows of a shard other than its own: arrays (query id, row id, score in double precision)."""
    distinct, node = np.unique(vectors, axis=0, return_inverse=True)
    order = np.argsort(node.reshape(-1), kind="stable")  # rows of a node in order of id
    sizes = np.bincount(node.reshape(-1), minlength=len(distinct))
    begins = np.cumsum(sizes) - sizes
    points = augment(distinct)
    out = []
    for at in range(0, len(queries), 256):
        part, own = queries[at : at + 256], query_ids[at : at + 256]
        found, _ = beam_search(points, graph, starts, np.c_[part, np.zeros(len(part))].astype(np.float32), width)
        q, c = np.nonzero(found < len(distinct))
        nodes = found[q, c]
        exact = np.einsum("ij,ij->i", distinct[nodes].astype(np.float64), part[q].astype(np.float64))
        take = np.minimum(sizes[nodes], k + 1)  # of equal vectors the smallest ids suffice
        row = np.repeat(np.arange(len(nodes)), take)
        item = order[begins[nodes][row] + np.arange(len(row)) - np.repeat(np.cumsum(take) - take, take)]
        q, score, row_ids = q[row], exact[row], ids[item]
        keep = row_ids != own[q]
        q, score, row_ids = q[keep], score[keep], row_ids[keep]
        best = np.lexsort((row_ids, -score, q))
        q, score, row_ids = q[best], score[best], row_ids[best]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        out.append((own[q[rank < k]], row_ids[rank < k], score[rank < k]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def nearest(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *,
    k: int = 20, shard_rows: int = 20_000, block_rows: int = 512, degree: int = 32, build_width: int = 64, width: int = 200, slack: float = 1.2,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest inner product for each row of ``queries``, approximately.

    Rows are dealt by a hash of their id into shards of about ``shard_rows``; each shard is indexed whole, as a graph over its
    distinct vectors, so groups of copies make no dense spot. Queries, in blocks, are searched in every shard, and the best of all
    shards are kept. Scores are inner products of the given vectors in double precision.

    Returns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, nearest first, ties to the smaller id. Rows with the query's
    id are no candidates; rows that repeat both id and vector count once. Vectors that are null, zero or hold null or non-finite
    components take no part, nor do null ids; vectors of another length than the query's are no candidates. Other columns are
    not read; empty tables give an empty result.
    """
    kind = "<f8" if isinstance(vectors.schema[vec_col].dataType, ArrayType) and isinstance(vectors.schema[vec_col].dataType.elementType, DoubleType) else "<f4"

    def usable(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
        finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return rows.where(F.col("id").isNotNull() & finite & F.exists("vec", lambda x: x != 0)).withColumn("dim", F.size("vec"))

    rows = usable(vectors)
    total = rows.count()
    shards = max(1, -(-total // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    index = stored(dealt.groupBy("dim", "shard").applyInPandas(_index_shard(kind, degree, build_width, slack), INDEX), "index")
    asked = usable(queries).distinct()
    blocks = max(1, -(-asked.count() // block_rows))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        data = np.stack(group["vec"].to_numpy()).astype(kind)
        return pd.DataFrame([{"dim": group["dim"].iloc[0], "query_ids": group["id"].to_numpy(np.int64).tobytes(), "queries": data.tobytes()}])

    packed = asked.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(blocks)).cast("int")).groupBy("dim", "block").applyInPandas(pack, "dim int, query_ids binary, queries binary")
    packed = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def search(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c, t: np.frombuffer(batch.column(c)[r].as_py(), t)
                dim = batch.column("dim")[r].as_py()
                q, v, s = search_shard(
                    get("ids", np.int64), get("vectors", kind).reshape(-1, dim), get("graph", np.int32).reshape(-1, degree), get("starts", np.int32),
                    get("query_ids", np.int64), get("queries", kind).reshape(-1, dim), k, width,
                )
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], ["query_id", "vec_id", "score"])

    found = packed.join(index, ["dim", "shard"]).mapInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
