"""What vector searches share: which rows take part, copies met once, blocks and the best of each query."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(rows: DataFrame, id_col: str, vec_col: str, zero: bool = False) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part: id and vector not null or empty, all
    components finite, and unless ``zero`` one of them not 0.  Rows with one id all take part."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))

    def odd(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    fine = (F.size("v") > 0) & ~F.exists("v", odd)
    if not zero:
        fine = fine & F.exists("v", lambda x: x != 0)
    picked = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    return picked.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): each distinct vector once, with its k + 1 smallest ids and how many rows (k at most)
    each stands for.  Of equal vectors no other row can be among the best ``k`` of a query, its own id
    left out, so nothing is lost; ids beyond are cut off before the shuffle (a rank limit),
    however many copies there are."""
    own = rows.groupBy("v", "vec_id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n"))
    ranked = own.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    return ranked.groupBy("v").agg(F.array_sort(F.collect_list(F.struct(F.col("vec_id").alias("id"), "n"))).alias("ids"))


def asking(rows: DataFrame, every: int) -> DataFrame:
    """(vec_id, v): the queries, rows whose id is divisible by ``every``; equal ones ask once."""
    return rows.where(F.col("vec_id") % every == 0).distinct()


def blocks_for(n: int, size: int) -> int:
    return max(1, math.ceil(n / size))


def block_of(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def each_of(n: int) -> Column:
    """A row for each of the ``n`` blocks of the other side."""
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def best(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest scores of each query, ties to smaller ids."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def stacked(column: pd.Series) -> np.ndarray:
    """The vectors of a column, all of one length, as the rows of a matrix."""
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 1))


class Answers:
    """Rows (query_id, vec_id, score), the best ``k`` of each call, as columns."""

    def __init__(self, k: int):
        self.k, self.query_id, self.vec_id, self.score = k, [], [], []

    def add(self, query_id: int, scores: np.ndarray, ids: list) -> None:
        """Candidates with the id lists of ``distinct_vectors``; rows of the query's own id are left out."""
        found = sorted((-s, int(i["id"]), int(i["n"])) for s, own in zip(scores.tolist(), ids) for i in own if i["id"] != query_id)
        rows = [(s, i) for s, i, n in found[: self.k] for _ in range(n)][: self.k]
        self.query_id += [query_id] * len(rows)
        self.vec_id += [i for _, i in rows]
        self.score += [-s for s, _ in rows]

    def frame(self, score: str) -> pd.DataFrame:
        made = pd.DataFrame({"query_id": self.query_id, "vec_id": self.vec_id}, dtype="int64")
        made["score"] = np.array(self.score, dtype=score)
        return made


def own_places(ids: list, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, place) for each candidate vector that has no other id than a query's own."""
    sole = pd.DataFrame([(i, x[0]["id"]) for i, x in enumerate(ids) if len(x) == 1], columns=["place", "id"], dtype="int64")
    met = pd.DataFrame({"q": np.arange(len(own)), "id": own}).merge(sole, on="id")
    return met["q"].to_numpy(np.int64), met["place"].to_numpy(np.int64)
