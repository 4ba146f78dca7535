"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .resident import resident

BITS = 20
SAMPLE = 12_000
EPOCHS = 5
CACHE = 300_000
_KEEP = 0x7FFFFFFFFFFFFFFF


class Words(dict):
    """Row numbers of words; ``table`` has the hashes of a word and of its first 4, 5 and 6 letters.

    A word is a run between white space, lower-cased, without what is no letter or digit at its
    ends; row 0 stands for runs of which nothing is left.  The table starts anew after ``CACHE``
    runs, so memory stays bounded.
    """

    def __init__(self) -> None:
        super().__init__()
        self.table = np.zeros((1024, 4), dtype=np.int64)
        self.size = 1

    def __missing__(self, run: str) -> int:
        word = run.lower()
        if not (word[0].isalnum() and word[-1].isalnum()):
            kept = [i for i, c in enumerate(word) if c.isalnum()]
            word = word[kept[0] : kept[-1] + 1] if kept else ""
        if not word:
            self[run] = 0
            return 0
        at = self[run] = self.size
        self.size += 1
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at] = [_mixed(x) for x in (word, word[:4], word[:5], word[:6])]
        return at

    def of(self, text: str) -> np.ndarray:
        """One row of four hashes a word."""
        if len(self) > CACHE:
            self.clear()
            self.size, self.table = 1, self.table[:1024]
        runs = text.split()
        at = np.fromiter(map(self.__getitem__, runs), dtype=np.int64, count=len(runs))
        return self.table[at[at > 0]]


def _mixed(word: str) -> int:
    return (xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 1) & _KEEP) or 1


def features(h: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hashed positions, repeats included: words, word beginnings, bigrams and one-word skip-grams."""
    mask = np.int64((1 << bits) - 1)
    with np.errstate(over="ignore"):
        w = h[:, 0]
        beginnings = [(h[:, k] * np.int64(2 * k + 1) + np.int64(7919 * k)) >> 20 for k in (1, 2, 3)]
        pair = (w[:-1] * np.int64(0x9E3779B1) ^ w[1:] * np.int64(0x85EBCA6B)) >> 17
        skip = (w[:-2] * np.int64(0xC2B2AE35) ^ w[2:] * np.int64(0x27D4EB2F)) >> 19
    return np.concatenate([w >> 20, *beginnings, pair, skip]) & mask


class Ftrl:
    """FTRL-proximal with per-coordinate rates; a weight stays 0 until its |z| exceeds ``l1``."""

    def __init__(self, size: int, alpha: float = 2.0, beta: float = 1.0, l1: float = 6.0, l2: float = 1.0):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / rate)

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def fit(labelled: DataFrame, bits: int = BITS, epochs: int = EPOCHS, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and bias learnt in one task from (text, label); give it a bounded table.

    Returns float32 weights of length 2**bits, nonzero at few places.  No rows: all zero.
    """

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, rows = _worker_words(), []
        for b in batches:
            for text, label in zip(b["text"], b["label"]):
                rows.append((np.unique(features(words.of(text), bits)).astype(np.int32), float(label)))
        rows.sort(key=lambda r: (len(r[0]), r[1], r[0].tobytes()))
        model, rng = Ftrl(1 << bits), np.random.default_rng(seed)
        bias = np.array([1 << bits], dtype=np.int32)
        for _ in range(epochs):
            for i in rng.permutation(len(rows)):
                model.learn(np.concatenate([rows[i][0], bias]), rows[i][1])
        w = model.weights(slice(None))
        at = np.flatnonzero(w)
        yield pd.DataFrame({"at": at, "w": w[at]})

    found = labelled.repartition(1).mapInPandas(train, "at long, w double").toPandas()
    weights = np.zeros(1 << bits, dtype=np.float32)
    bias = found.loc[found["at"] == 1 << bits, "w"].sum()
    found = found[found["at"] < 1 << bits]
    weights[found["at"].to_numpy(np.int64)] = found["w"]
    return weights, float(bias)


def score_column(spark, weights: np.ndarray, bias: float, text: Column) -> Column:
    """The score (0 to 1) of a text column; null and empty texts score the bias alone."""
    sent = spark.sparkContext.broadcast((weights, bias))  # 4 MB at 20 bits, whatever the input

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, base = sent.value
        bits, words = len(w).bit_length() - 1, _worker_words()
        for texts in batches:
            out = np.zeros(len(texts))
            for i, text in enumerate(texts):
                at = features(words.of(text), bits)
                out[i] = base + w[np.unique(at[w[at] != 0])].sum(dtype=np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return run(F.coalesce(text, F.lit("")))


def _worker_words() -> Words:
    return resident("toxicity", Words)


def held_out(doc_id: str) -> Column:
    """True where crc32 of the id as text is divisible by 5; such rows are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """(text, label) of at most ``sample`` labelled ids outside the held-out fold, by a hash order.

    The picked ids are bounded by ``sample``, so they are broadcast and the texts are not shuffled.
    An id labelled twice counts with its larger label, and of rows with one id the smallest text is
    learnt from; null ids and null labels count for nothing.
    """
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return own.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label")).select("text", "label")


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (columns doc_id, text).

    Learns from ``labels`` (doc_id, toxic) as ``training_rows`` picks them, then scores whole texts.
    Null and empty texts score the bias; repeated rows score alike; a null doc_id is scored and
    not held out; no labels at all give 0.5 everywhere.
    """
    weights, bias = fit(training_rows(docs, labels, sample=sample), bits)
    scored = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), score_column(docs.sparkSession, weights, bias, F.col("text")).alias("score")
    )
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5, all columns as they are, whatever their names.

    Null and empty texts score the bias and very long ones are scored whole; a null doc_id stays or goes
    by its text; repeated rows stay or go together; with no labels to learn from nothing is rejected and every
    row stays; an empty table gives an empty result.
    """
    weights, bias = fit(training_rows(docs, labels, sample=sample), bits)
    if bias == 0 and not weights.any():  # nothing was learnt
        return docs
    return docs.where(score_column(docs.sparkSession, weights, bias, F.col("text")) < 0.5)


def op9_toxicity_ftrl(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``documents`` with the labels of ``labels``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
