"""Pairs of similar strings by prefix filtering: an inverted index on q-grams, with length and count filters.

Similarity is twice the common subsequence over both lengths.  Two strings that reach a threshold
differ by a bounded number of insertions and deletions, each of which spoils few q-grams, so they share a
known number of them.  A string is indexed under its rarest q-grams only, as many as make sure that it
meets every partner.

Under low thresholds nearly all strings of a block meet that way.  There a block is dealt into parts, every
two parts meet in a cell, and a cell counts shared characters by one matrix product and the common
subsequences of what is left with a bit a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import let
from ..functions.similarity import ratio_of
from .scratch import Scratch

#: From this threshold on pairs of characters are used, below it single characters, which always suffice, in cells.
PAIRS_FROM = 85.0
#: How many grams of the index two strings have to share, where their lengths allow as many.
MEETINGS = 3
#: Strings a part of a block; pairs a task, tasks at most; columns of the counts of characters; masks a table; pairs at a time.
PART, TASK_PAIRS, MOST_TASKS, COUNTED, MASKS, AT_A_TIME = 1024, 1 << 20, 10_000, 128, 1 << 22, 1 << 16


def _grams(value: Column, q: int) -> Column:
    """The q-grams of a string; a repeated one has its number, so they make a set."""
    every = F.transform(F.sequence(F.lit(1), F.greatest(F.length(value) - (q - 1), F.lit(1))), lambda i: F.substring(value, i, F.lit(q)))

    def numbered(grams: Column) -> Column:
        return F.transform(grams, lambda g, i: F.concat(g, F.size(F.filter(F.slice(grams, F.lit(1), i + 1), lambda h: h == g)).cast("string")))

    return F.when(F.length(value) >= q, let(every, numbered)).otherwise(F.array().cast("array<string>"))


def _shared(total: Column, threshold: float, q: int) -> Column:
    """The least number of q-grams that two strings share whose lengths sum to ``total``.

    With d insertions and deletions between them, d at most (1 - t) total: a deletion spoils q grams and an
    insertion q - 1, which leaves total / 2 - 1 - 1.5 d pairs of characters, or (total - d) / 2 characters.
    """
    d = total * (1 - threshold / 100)
    return F.ceil(total / 2 - 1 - 1.5 * d - 1e-9) if q == 2 else F.ceil((total - d) / 2 - 1e-9)


def candidate_pairs(strings: DataFrame, threshold: float) -> DataFrame:
    """(block, x, y) with x < y, the pairs of ``strings`` (block, s; distinct) that are compared in full.

    Rare q-grams come first in the index, so that what all strings of a block share is met last, and
    frequent ones are split by Spark where their rows make a partition large.
    """
    q, t = (2 if threshold >= PAIRS_FROM else 1), threshold / 100
    sized = strings.where("s <> ''").withColumn("n", F.length("s"))
    held = sized.withColumn("grams", _grams(F.col("s"), q)).where(F.size("grams") > 0)
    rows = held.select("block", "s", F.explode("grams").alias("gram"))
    often = rows.groupBy("block", "gram").agg(F.count("*").alias("n"))
    ordered = rows.join(often, ["block", "gram"]).groupBy("block", "s").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("ordered"))
    n = F.length("s")
    least = _shared(n + n * t / (2 - t), threshold, q)  # with its shortest partner
    # a string that shares two grams or more with every partner is indexed under as many more, and has to meet it as often
    meets = F.least(F.greatest(least, F.lit(1)), F.lit(MEETINGS))
    index = ordered.withColumn("meets", meets).withColumn("first", F.slice("ordered", F.lit(1), F.greatest(F.size("ordered") - F.greatest(least, F.lit(1)) + F.col("meets"), F.lit(0)).cast("int")))
    index = index.select("block", "s", "meets", F.explode("first").alias("g")).select("block", "s", "meets", F.col("g.gram").alias("gram"), F.length("s").alias("n"))
    a, b = index.alias("a"), index.alias("b")
    near = F.least("a.n", "b.n") * 2 >= (F.col("a.n") + F.col("b.n")) * (t - 1e-9)
    met = (F.col("a.block") == F.col("b.block")) & (F.col("a.gram") == F.col("b.gram")) & (F.col("a.s") < F.col("b.s")) & near
    pairs = a.join(b, met).groupBy("a.block", F.col("a.s").alias("x"), F.col("b.s").alias("y"))
    counted = pairs.agg(F.count("*").alias("shared"), F.min(F.least("a.meets", "b.meets")).alias("needed"))
    return counted.where("shared >= needed").select("block", "x", "y")


class _Strings:
    """Strings of a cell: ``codes``, their characters as numbers from 1 in a row each of 64 at most, zeros behind, and
    ``counts``, in which the product of two rows is the number of characters they share, or more."""

    def __init__(self, strings: list[str]):
        self.size = np.array([len(s) for s in strings], np.int64)
        flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(len(strings)), self.size)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        found, code = np.unique(flat, return_inverse=True)
        self.kinds = len(found) + 1
        self.codes = np.zeros((len(strings), 64), np.int32)
        near = place < 64
        self.codes[row[near], place[near]] = code[near] + 1
        # the k-th of a character in its string is a feature; the most frequent ones have a column of their own
        order = np.lexsort((code, row))
        key = row[order] * self.kinds + code[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        nth = np.arange(len(key)) - np.repeat(first, np.diff(np.r_[first, len(key)]))
        _, feature, often = np.unique(nth * self.kinds + code[order], return_inverse=True, return_counts=True)
        column = np.empty(len(often), np.int64)
        column[np.argsort(-often, kind="stable")] = np.arange(len(often)) % COUNTED
        self.counts = np.zeros((len(strings), COUNTED), np.float32)
        np.add.at(self.counts, (row[order], column[feature]), 1)

    def masks(self, rows: slice) -> np.ndarray:
        """The places of each character in ``rows``, a bit a place; none of the number 0."""
        codes = self.codes[rows]
        out = np.zeros((len(codes), self.kinds), np.uint64)
        for k in range(64):
            out[np.arange(len(codes)), codes[:, k]] |= np.uint64(1 << k)
        out[:, 0] = 0
        return out

    def common(self, masks: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of common subsequences of rows ``i`` of ``masks`` and strings ``j``, of 64 characters at most."""
        free = np.full(len(i), ~np.uint64(0))
        for k in range(int(self.size[j].max(initial=0))):
            hit = free & masks[i, self.codes[j, k]]
            free = (free + hit) | (free - hit)
        return np.bitwise_count(~free).astype(np.int64)


def _similar_in_cell(strings: list[str], own: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, score) of similar pairs: one of the first ``own`` strings and one of the others, or, where there are no
    others, any two of them once."""
    held, alone = _Strings(strings), own == len(strings)
    start = 0 if alone else own
    step = max(1, min(PART, MASKS // held.kinds))
    for at in range(0, own, step):
        rows = slice(at, min(at + step, own))
        shared = held.counts[rows] @ held.counts[start:].T
        need = (held.size[rows, None] + held.size[None, start:]) * (threshold / 200) - 1e-6
        i, j = np.nonzero(shared >= need)
        if alone:
            i, j = i[j > i + at], j[j > i + at]
        long = (held.size[i + at] > 64) | (held.size[j + start] > 64)
        far = [(p + at, q + start) for p, q in zip(i[long].tolist(), j[long].tolist())]
        for p, q in far:
            if (score := ratio_of(strings[p], strings[q])) >= threshold:
                yield np.array([p]), np.array([q]), np.array([score])
        i, j = i[~long], j[~long] + start
        order, masks = np.argsort(held.size[j], kind="stable"), held.masks(rows)
        for part in (order[k : k + AT_A_TIME] for k in range(0, len(order), AT_A_TIME)):
            p, q = i[part], j[part]
            score = 200.0 * held.common(masks, p, q) / (held.size[p + at] + held.size[q])
            good = score >= threshold
            yield p[good] + at, q[good], score[good]


def _pairs_in_cells(own: DataFrame, threshold: float) -> DataFrame:
    """``similar_pairs`` of distinct strings that are not null, each compared with every other of its block."""
    spark = own.sparkSession
    kept = Scratch(spark, "similar").save(own.where("s <> ''"), "strings")
    sizes = kept.groupBy("block").agg(F.count("*").alias("n")).where("n > 1")
    pairs = sizes.agg(F.sum(F.col("n").cast("double") * F.col("n") / 2)).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(int(pairs / TASK_PAIRS) + 1, MOST_TASKS))
    parts = F.ceil(F.col("n") / PART)
    dealt = kept.join(sizes, "block").select("block", "s", parts.alias("parts"), F.pmod(F.xxhash64("s"), parts).alias("part"))
    met = dealt.select("block", "s", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
    cells = met.select("block", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "s")

    def compared(g: pd.DataFrame) -> pd.DataFrame:
        first = (g["part"] == g["low"]).to_numpy()
        strings = [*g["s"][first], *g["s"][~first]]
        alone = g["low"].iloc[0] == g["high"].iloc[0]
        made = list(_similar_in_cell(strings, int(first.sum()), threshold)) if alone or 0 < first.sum() < len(first) else []
        rows = [(*sorted((strings[p], strings[q])), v) for i, j, score in made for p, q, v in zip(i.tolist(), j.tolist(), score.tolist())]
        out = pd.DataFrame(rows, columns=["x", "y", "score"])
        out.insert(0, "block", g["block"].iloc[0])
        return out

    keys = ["block", "low", "high"]
    return cells.repartition(tasks, *keys).groupBy(*keys).applyInPandas(compared, "block string, x string, y string, score double")


def similar_pairs(strings: DataFrame, threshold: float) -> DataFrame:
    """(block, x, y, score) with x < y: all pairs of distinct strings of a block that score ``threshold`` (above 0)
    or more.  Reads ``block`` and ``s``; nulls take no part, and an empty string is like no other."""

    @F.pandas_udf("double")
    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([ratio_of(p, q) for p, q in zip(x, y)], dtype="float64")

    own = strings.where(F.col("block").isNotNull() & F.col("s").isNotNull()).select("block", "s").distinct()
    if threshold < PAIRS_FROM:
        return _pairs_in_cells(own, threshold)
    return candidate_pairs(own, threshold).withColumn("score", score("x", "y")).where(F.col("score") >= threshold)
