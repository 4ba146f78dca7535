"""Exact top-k inner products by aggregation over sorted lists without random access.

Candidates are dealt to blocks; a block holds one list per component, sorted by value.  Queries
read all lists of a block in step, each from the end that its own component's sign makes the
better one.  What is read of a candidate bounds its score from below (the rest at the worst value of
each list) and above (the rest at the value the list has come to).  Candidates whose upper bound
falls below the k-th best lower bound are out, and a query stops reading when at most k are in.
Then their scores are resolved.  A first block is searched before the others, and the k-th best score
found there is a lower bound that every other block starts with.

Queries read in batches: for a depth the bounds of a batch are two matrix products, since an unread
entry of a list counts as the value the list has come to (above) or as its last one (below).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .vectors import Answers, asking, best, block_of, blocks_for, distinct_vectors, each_of, own_places, stacked, usable

SCALE = 256
BLOCK = 4096
QUERY_BLOCK = 8192
BATCH = 512
STEPS = 16
NONE = 1 << 62


class SortedLists:
    """The lists of a block of integer vectors, sorted once for all queries that come to it.

    ``read`` counts the entries read, of ``asked`` (all entries of the lists, once a query).
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        self.sorted = np.sort(x, axis=0)
        order = np.argsort(x, axis=0, kind="stable")
        self.place = np.empty_like(order)  # of each entry in its list, from the smallest
        np.put_along_axis(self.place, order, np.broadcast_to(np.arange(len(x))[:, None], x.shape), axis=0)
        self.read = self.asked = 0

    def bounds(self, depth: int, at: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """What the entries of the candidates ``at`` count at a depth, as (worst, best) for queries
        laid out as positive parts, then negative parts."""
        n, x, place = len(self.x), self.x[at], self.place[at]
        down, up = place >= n - depth, place < depth  # read from the largest, from the smallest
        worst = np.hstack([np.where(down, x, self.sorted[0]), np.where(up, x, self.sorted[-1])])
        reach = np.hstack([np.where(down, x, self.sorted[n - depth]), np.where(up, x, self.sorted[depth - 1])])
        return worst.T.astype(kind), reach.T.astype(kind)

    def top(
        self, queries: np.ndarray, floor: np.ndarray, k: int, out: tuple[np.ndarray, np.ndarray] | None = None, steps: int = STEPS
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, places, scores) for each query, such that all its ``k`` best candidates of at least
        its ``floor`` are among the places, equal scores included.  ``out``: pairs of a query and a
        place that is no candidate of it."""
        n = len(self.x)
        kind = _exact_type(queries, self.x)
        signed = np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)]).astype(kind)
        asking, at, floor = np.arange(len(queries)), np.arange(n), floor.copy()
        self.asked += len(queries) * self.x.size
        for step in range(1, steps + 1):
            depth = max(1, n * step // steps)
            worst, reach = self.bounds(depth, at, kind)
            low, high = signed[asking] @ worst, signed[asking] @ reach
            if out is not None:
                row, column = np.searchsorted(asking, out[0]), np.searchsorted(at, out[1])
                met = (np.append(asking, -1)[row] == out[0]) & (np.append(at, -1)[column] == out[1])
                low[row[met], column[met]] = high[row[met], column[met]] = -NONE
            if len(at) >= k:
                floor[asking] = np.maximum(floor[asking], np.partition(low, len(at) - k, axis=1)[:, len(at) - k])
            open_ = (high >= floor[asking][:, None]) & (high > -NONE)
            done = (open_.sum(axis=1) <= k) | (depth == n)
            for row in np.flatnonzero(done):
                places, q = at[open_[row]], asking[row]
                yield int(q), places, self.x[places] @ queries[q]
            self.read += int(done.sum()) * depth * self.x.shape[1]
            asking, open_ = asking[~done], open_[~done]
            if not len(asking):
                return
            at = at[open_.any(axis=0)]


def _exact_type(queries: np.ndarray, x: np.ndarray) -> type:
    """The fastest number type that holds every sum of products of whole numbers exactly."""
    most = float(np.abs(queries.astype(np.float64)).max(axis=0) @ np.abs(x.astype(np.float64)).max(axis=0))
    return np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else np.int64


def search(rows: DataFrame, queries: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products for each of ``queries``.

    Both are (vec_id, v array<long>); rows of a query's own id are no candidates, and vectors of
    other lengths than its own neither.  Blocks of candidates meet blocks of queries; each meeting
    returns at most ``k`` rows a query, of which the best ``k`` are taken.
    """
    scratch = Scratch(rows.sparkSession, "topk")
    held = scratch.save(distinct_vectors(rows, k), "vectors")
    asked = scratch.save(queries, "queries")
    parts, askers = blocks_for(held.count(), block), blocks_for(asked.count(), QUERY_BLOCK)
    dealt = held.select("v", "ids", F.size("v").alias("dims"), block_of("v", parts).alias("part"))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = Answers(k)
        if len(a) and len(b):
            lists, ids = SortedLists(stacked(a["v"]).astype(np.int64)), a["ids"].tolist()
            for i in range(0, len(b), BATCH):
                part = b.iloc[i : i + BATCH]
                own, floor = part["vec_id"].to_numpy(np.int64), part["floor"].to_numpy(np.int64)
                for q, places, scores in lists.top(stacked(part["v"]).astype(np.int64), floor, k, own_places(ids, own)):
                    fit = scores >= floor[q]
                    out.add(int(own[q]), scores[fit], [ids[p] for p in places[fit]])
        return out.frame("int64")

    def met(candidates: DataFrame, asking: DataFrame) -> DataFrame:
        keys = ["dims", "part", "asker"]
        left = candidates.withColumn("asker", each_of(askers))
        right = asking.withColumns({"dims": F.size("v"), "asker": block_of("vec_id", askers)})
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score long")

    first = scratch.save(met(dealt.where("part = 0"), asked.withColumns({"part": F.lit(0), "floor": F.lit(-NONE)})), "first")
    floors = best(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    bounded = scratch.save(asked.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-NONE))), "bounded")
    rest = met(dealt.where("part > 0"), bounded.withColumn("part", each_of(parts)))
    return best(first.unionByName(rest), k)


def quantized(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """Each component x as floor(scale * x)."""
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("long")))


def top_inner_products(rows: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` best other rows for each row whose id is divisible by ``every``.

    Null ids, null or empty vectors and vectors with null or non-finite components take no part.  All
    rows with one id are candidates of other ids; an id that asks with several vectors gets the
    best of all of them, and equal rows ask once.  Vectors of different lengths do not meet.  Equal
    scores go to smaller ids; with fewer candidates all are returned; an empty table gives an
    empty result; other columns are not read; scores must fit a long (up to 2**62).
    """
    own = quantized(usable(rows, id_col, vec_col, zero=True))
    return search(own, asking(own, every), k)


def op10_exact_topk(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``embeddings``."""
    return top_inner_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
