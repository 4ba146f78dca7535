"""Approximate nearest neighbours over learned partitions.

A bounded sample gets a neighbour graph, which is cut into balanced partitions with few
edges between them.  A small network learns to tell a vector's partition; it deals every row to its
most probable partition and routes a query to its several most probable ones, whose rows are
reranked exactly.  There are about as many partitions as the square root of the rows (``SAMPLE`` / 16
at most), and a query visits the least number of them that reaches ``RECALL`` on vectors of the sample
held out from the graph.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .vectors import Answers, asking, best, block_of, blocks_for, distinct_vectors, each_of, own_places, stacked, usable

SAMPLE = 8192
HELD_OUT = 1024
NEIGHBOURS = 12
HIDDEN = 96
RECALL = 0.93
BLOCK = 8192
QUERY_BLOCK = 2048
BATCH = 256
IDS = "array<struct<id:long,n:int>>"


def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """For each row the ``k`` rows of largest inner product (or all others, if fewer)."""
    k = max(0, min(k, len(x) - 1))
    out = np.zeros((len(x), k), dtype=np.int64)
    for at in range(0, len(x) if k else 0, BATCH):  # so many rows of products at a time are in memory
        s = -(x[at : at + BATCH] @ x.T)
        s[np.arange(len(s)), at + np.arange(len(s))] = np.inf
        out[at : at + BATCH] = np.argpartition(s, k - 1, axis=1)[:, :k]
    return out


def _bisect(edges: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """A balanced cut of a graph (rows of two ends): power iteration towards the second eigenvector of
    the random walk, split at the median, then swaps of the nodes that gain most from changing sides."""
    a, b = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    degree = np.bincount(a, minlength=n) + 1.0
    x = rng.standard_normal(n)
    for _ in range(60):
        x = (x + np.bincount(a, weights=x[b], minlength=n)) / degree
        x -= np.average(x, weights=degree)
        x /= np.linalg.norm(x) or 1.0
    side = np.zeros(n, dtype=bool)
    side[np.argsort(x, kind="stable")[n // 2 :]] = True
    for _ in range(30):
        gain = np.bincount(a, weights=np.where(side[a] != side[b], 1.0, -1.0), minlength=n)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right))
        better = int(np.searchsorted(-(gain[left[:m]] + gain[right[:m]]), -1.0, "right"))
        better = max(0, better // 2)
        if not better:
            break
        side[left[:better]], side[right[:better]] = True, False
    return side


def balanced_partitions(graph: np.ndarray, parts: int, seed: int = 11) -> np.ndarray:
    """A partition (0 to ``parts`` - 1, a power of two) for each node, by repeated bisection."""
    n = len(graph)
    rng, out = np.random.default_rng(seed), np.zeros(n, dtype=np.int64)
    edges = np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()], axis=1)
    width = parts
    while width > 1:
        width //= 2
        for p in np.unique(out):
            own = np.flatnonzero(out == p)
            if len(own) < 2:
                continue
            local = np.full(n, -1)
            local[own] = np.arange(len(own))
            inner = local[edges]
            side = _bisect(inner[(inner >= 0).all(axis=1)], len(own), rng)
            out[own[side]] += width
    return out


class Router:
    """A network of one hidden layer that gives the log-odds of each partition for a vector."""

    def __init__(self, dims: int, parts: int, seed: int = 13):
        rng = np.random.default_rng(seed)
        self.w = [
            rng.standard_normal((dims, HIDDEN)) / np.sqrt(dims), np.zeros(HIDDEN),
            rng.standard_normal((HIDDEN, parts)) / np.sqrt(HIDDEN), np.zeros(parts),
        ]

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        return np.maximum(x @ self.w[0] * 4 + self.w[1], 0) @ self.w[2] + self.w[3]

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 800, batch: int = 256, rate: float = 0.01) -> None:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        rng = np.random.default_rng(17)
        m, v = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        for t in range(1, steps + 1):
            i = rng.integers(len(x), size=min(batch, len(x)))
            h = np.maximum(x[i] @ self.w[0] * 4 + self.w[1], 0)
            z = h @ self.w[2] + self.w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(i)), y[i]] -= 1
            p /= len(i)
            back = (p @ self.w[2].T) * (h > 0)
            grads = [4 * x[i].T @ back, back.sum(axis=0), h.T @ p, p.sum(axis=0)]
            for j, g in enumerate(grads):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                self.w[j] -= rate * (1 - t / steps) * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)


def partitions_for(n: int) -> int:
    """The power of two next above the square root of ``n``, bounded by what the sample can tell apart."""
    return min(SAMPLE // 16, 1 << max(0, math.ceil(math.log2(max(1, n)) / 2)))


def fit_index(sample: np.ndarray, n: int, k: int, recall: float = RECALL) -> tuple[Router, int]:
    """The router for ``n`` vectors, and how many partitions a query visits.

    ``k`` of n vectors are as near to a query as its best ``k`` * m / n of m, so the held-out vectors
    look for as many (one at least) among the rest of the sample.
    """
    parts = partitions_for(n)
    held = sample[: min(HELD_OUT, math.ceil(len(sample) / 4))]
    rest = sample[len(held) :]
    router = Router(sample.shape[1], parts)
    if not len(rest):
        return router, parts
    router.fit(rest, balanced_partitions(neighbour_graph(rest), parts))
    home = router.logits(rest).argmax(axis=1)
    k = min(len(rest), max(1, round(k * len(rest) / n)))
    near = np.concatenate([np.argpartition(-(held[i : i + BATCH] @ rest.T), k - 1, axis=1)[:, :k] for i in range(0, len(held), BATCH)])
    visited = np.argsort(-router.logits(held), axis=1)
    place = np.argsort(visited, axis=1)  # of each partition in the order of visits
    reached = np.sort(np.take_along_axis(place, home[near], axis=1).ravel())
    return router, int(reached[min(len(reached) - 1, math.ceil(recall * len(reached)))]) + 1


def fitted(column: pd.Series | list, dims: int) -> np.ndarray:
    """The vectors of a column cut or filled with zeros to ``dims``, as the router takes them."""
    out = np.zeros((len(column), dims))
    for i, v in enumerate(column):
        out[i, : len(v)] = v[:dims]
    return out


def reranked(x: np.ndarray, q: np.ndarray, k: int, out: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, places, scores) with all candidates that can be among the ``k`` best of each query; a
    matrix product may be off in its last bits, so all within that error of the k-th are scored anew."""
    s = q @ x.T
    s[out] = -np.inf
    kth = np.partition(s, len(x) - k, axis=1)[:, len(x) - k] if len(x) > k else np.full(len(q), -np.inf)
    error = 4 * x.shape[1] * np.finfo(float).eps * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
    for i, v in enumerate(q):
        places = np.flatnonzero((s[i] >= kth[i] - error[i]) & (s[i] > -np.inf))
        yield i, places, (x[places] * v).sum(axis=1)


def search(rows: DataFrame, every: int, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of usable ``rows`` (vec_id, v)."""
    scratch = Scratch(rows.sparkSession, "ann")
    held = scratch.save(distinct_vectors(rows, k), "vectors")
    asked = scratch.save(asking(rows, every), "queries")
    n, m = held.count(), asked.count()
    found = [r[0] for r in held.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()]
    if not n:
        return best(rows.select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0.0).alias("score")).limit(0), k)
    dims = max(map(len, found))
    router, visits = fit_index(fitted(found, dims), n, k)
    del found
    parts = partitions_for(n)
    blocks, askers = blocks_for(2 * n, BLOCK * parts), blocks_for(m * visits, QUERY_BLOCK * parts)

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                b["part"] = router.logits(fitted(b["v"], dims)).argmax(axis=1)
                yield b

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                at = np.argsort(-router.logits(fitted(b["v"], dims)), axis=1, kind="stable")[:, :visits]
                b = b.loc[b.index.repeat(visits)]
                b["part"] = at.ravel()
                yield b

    def cells(rows: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return rows.select("*", F.size("v").alias("dims"), block_of("v", n_own).alias(own), each_of(n_other).alias(other))

    left = cells(held.mapInPandas(dealt, f"v array<double>, ids {IDS}, part int"), "block", blocks, "asker", askers)
    right = cells(asked.mapInPandas(routed, "vec_id long, v array<double>, part int"), "asker", askers, "block", blocks)

    def rerank(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = Answers(k)
        if len(a) and len(b):
            x, ids, own = stacked(a["v"]), a["ids"].tolist(), b["vec_id"].to_numpy(np.int64)
            for i in range(0, len(b), BATCH):
                mine = own[i : i + BATCH]
                for q, places, scores in reranked(x, stacked(b["v"].iloc[i : i + BATCH]), k, own_places(ids, mine)):
                    out.add(int(mine[q]), scores, [ids[p] for p in places])
        return out.frame("float64")

    keys = ["dims", "part", "block", "asker"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(rerank, "query_id long, vec_id long, score double")
    return best(met, k)


def nearest(rows: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest other rows found for each row whose id is divisible by ``every``.

    Nearness is the inner product in double precision.  Null ids, null, empty and zero vectors and
    vectors with null or non-finite components take no part.  All rows with one id are candidates
    of other ids; an id that asks with several vectors gets the best of all of them, and equal
    rows ask once.  Vectors of different lengths do not meet.  Equal vectors share a partition, and
    all of them are found or none.  An empty table gives an empty result; other columns are not read.
    """
    return search(usable(rows, id_col, vec_col), every, k)


def op4_learned_partitions(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``embeddings``."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
