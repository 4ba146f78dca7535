"""Language-model scores by masked pseudo-likelihood.

Words are hashed to buckets, whose counts over the whole corpus give each word its share p.  A
network looks at a window of words on both sides of a place and tilts these shares: with h its hidden
layer and o(w) the output vector of w, the word w has the probability

    P(w | both sides) = p(w) exp(h o(w)) / Z,   Z = (1 - p(w)) E[exp(h o(x))] + p(w) exp(h o(w)),

the mean being over words x drawn by their shares (a fixed draw when scoring).  Words are rows of the
network: the most frequent ones have rows of their own, the others share the rest by a hash; there are
about half as many rows as the square root of the corpus' words, so the network grows with the corpus.  A
document's score is the sum of log P over all its words.

The network learns from every place of every document: documents are dealt by a hash to shards of
about the same size, each shard trains a copy in a fixed order, and the copies are averaged, weighted
by places.  Shards, orders and sums (of whole numbers) do not depend on how rows are partitioned.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .resident import resident
from .scratch import Scratch

BUCKETS = 1 << 20
SIDE = 2
HIDDEN = 24
ROWS = (64, 1 << 16)
DRAWN = 32
DRAWN_TO_SCORE = 64
BATCH = 1024
RATE = 0.1
SHARD_DOCS = 8192
GROUP_WORDS = 100_000
CACHE = 400_000
FIXED = 1 << 16
CHUNK = 16_384
OFFSETS = tuple(o for o in range(-SIDE, SIDE + 1) if o)


class WordBuckets(dict):
    def __missing__(self, word: str) -> int:
        made = self[word] = zlib.crc32(word.lower().encode("utf-8", "replace")) % BUCKETS
        return made


def buckets(text: str) -> np.ndarray:
    """The bucket of each word; words are runs between white space, lower-cased."""
    known = resident("pseudo_likelihood", WordBuckets)
    if len(known) > CACHE:
        known.clear()
    words = text.split()
    return np.fromiter(map(known.__getitem__, words), dtype="<i4", count=len(words))


def tokens(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, words): the buckets of each text as bytes of 32-bit numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "words": [buckets(t).tobytes() for t in b["text"]]})

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return picked.mapInPandas(run, "doc_id long, words binary")


def _cut(numbers: np.ndarray) -> pd.DataFrame:
    """(at, numbers): whole numbers in pieces of ``CHUNK``, to be added up across tasks."""
    cuts = range(0, len(numbers), CHUNK)
    return pd.DataFrame({"at": list(cuts), "numbers": [numbers[i : i + CHUNK].tobytes() for i in cuts]})


def _added(pieces: DataFrame, size: int) -> np.ndarray:
    """The sum over all tasks of what ``_cut`` gave, ``size`` numbers; sums of whole numbers have no order."""

    def add(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"at": [key[0]], "numbers": [sum(np.frombuffer(x, dtype=np.int64) for x in b["numbers"]).tobytes()]})

    out = np.zeros(size, dtype=np.int64)
    for r in pieces.groupBy("at").applyInPandas(add, "at long, numbers binary").collect():
        piece = np.frombuffer(r["numbers"], dtype=np.int64)
        out[r["at"] : r["at"] + len(piece)] = piece
    return out


def corpus_counts(made: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all of ``made`` (words); ``BUCKETS`` numbers come to the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for b in batches:
            at, n = np.unique(np.frombuffer(b"".join(b["words"]), dtype="<i4"), return_counts=True)
            total[at] += n
        yield _cut(total)

    return _added(made.select("words").mapInPandas(run, "at long, numbers binary"), BUCKETS)


class Vocabulary:
    """For each bucket its row in the network (``of``) and its share of all words; for each row how many
    words it has in all.  ``top``: the buckets that have the first rows to themselves."""

    def __init__(self, rows: int, top: np.ndarray, share: np.ndarray, weight: np.ndarray | None = None):
        self.parts = rows, top, share, weight
        self.rows, self.share, self.weight = rows, share, weight
        own = rows * 3 // 4
        self.of = np.arange(BUCKETS, dtype=np.int32)
        self.of %= rows - own
        self.of += own
        self.of[top] = np.arange(len(top), dtype=np.int32)
        self.ends: np.ndarray | None = None

    @staticmethod
    def of_counts(counts: np.ndarray) -> "Vocabulary":
        total = int(counts.sum())
        rows = int(np.clip(1 << max(0, round(np.log2(max(1, total)) / 2) - 1), *ROWS))
        met = np.flatnonzero(counts)
        top = met[np.lexsort((met, -counts[met]))[: rows * 3 // 4]].astype(np.int32)
        made = Vocabulary(rows, top, (counts / max(1, total)).astype(np.float32))
        weight = np.bincount(made.of, weights=counts, minlength=rows)
        made.weight, made.parts = weight, (*made.parts[:3], weight)
        return made

    def draw(self, at: np.ndarray) -> np.ndarray:
        """Rows at places from 0 to 1 of the corpus, laid out row by row."""
        if self.ends is None:
            self.ends = np.cumsum(self.weight)
        return np.minimum(np.searchsorted(self.ends, at * self.ends[-1], "right"), self.rows - 1)


def _order(at: np.ndarray) -> np.ndarray:
    """The stable order of whole numbers under 2**32, by halves of 16 bits, which NumPy sorts by digits."""
    order = np.argsort(at.astype(np.uint16), kind="stable")
    above = (at >> 16).astype(np.uint16)
    return order[np.argsort(above[order], kind="stable")] if above.any() else order


def _add_by_row(table: np.ndarray, squares: np.ndarray, at: np.ndarray, steps: np.ndarray, rate: float) -> None:
    """Adds the sum of ``steps`` of each row, in a measure that falls with the squares added before; where there are
    several rows for a step, they follow each other."""
    order = _order(at)
    at, each = at[order], len(at) // len(steps)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    own, total = at[first], np.add.reduceat(steps[order // each], first, axis=0)
    held = squares[own] + np.einsum("ij,ij->i", total, total) / np.float32(HIDDEN)
    squares[own] = held
    table[own] += total * (np.float32(rate) / np.sqrt(held + np.float32(1e-8)))[:, None]


class Network:
    """Input rows for each place beside the word (one more for beyond the text's ends), a hidden layer
    without weights of its own, and output rows."""

    def __init__(self, rows: int, seed: int = 23):
        rng = np.random.default_rng(seed)
        self.rows = rows
        self.table = (rng.standard_normal((len(OFFSETS) * (rows + 1), HIDDEN)) * 0.1).astype(np.float32)
        self.out = (rng.standard_normal((rows, HIDDEN)) * 0.1).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.table.ravel(), self.out.ravel()])

    def load(self, flat: np.ndarray) -> "Network":
        a = self.table.size
        self.table, self.out = (x.astype(np.float32) for x in (flat[:a].reshape(self.table.shape), flat[a:].reshape(self.out.shape)))
        return self

    def around(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The input rows of the window around each place (``padded`` has SIDE ends before and after each text)."""
        return np.stack([padded[at + SIDE + o] + i * (self.rows + 1) for i, o in enumerate(OFFSETS)], axis=1)

    def hidden(self, around: np.ndarray) -> np.ndarray:
        h = self.table[around[:, 0]]
        for i in range(1, len(OFFSETS)):
            h += self.table[around[:, i]]
        return np.tanh(h)

    def tilt(self, h: np.ndarray, words: np.ndarray, drawn: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(h o(w), exp(h o(x)) for the drawn x, Z)."""
        hit = np.clip(np.einsum("ij,ij->i", h, self.out[words]), -30, 30)
        others = np.exp(np.clip(h @ self.out[drawn].T, -30, 30))
        return hit, others, (1 - share) * others.mean(axis=1) + share * np.exp(hit)

    def log_probabilities(self, padded: np.ndarray, at: np.ndarray, share: np.ndarray, drawn: np.ndarray) -> np.ndarray:
        """log P of the word at each place."""
        out = np.empty(len(at))
        for i in range(0, len(at), 8192):
            own = at[i : i + 8192]
            hit, _, z = self.tilt(self.hidden(self.around(padded, own)), padded[own + SIDE], drawn, share[i : i + 8192])
            out[i : i + 8192] = np.log(share[i : i + 8192]) + hit - np.log(z)
        return out

    def steps(self, around: np.ndarray, words: np.ndarray, share: np.ndarray, drawn: np.ndarray) -> tuple[np.ndarray, ...]:
        """Gradients of the summed log P: of each place's input, output row, and of the drawn rows."""
        h = self.hidden(around)
        hit, others, z = self.tilt(h, words, drawn, share)
        up = 1 - share * np.exp(hit) / z
        down = others * (-(1 - share) / (z * len(drawn)))[:, None]
        back = up[:, None] * self.out[words] + down @ self.out[drawn]
        return back * (1 - h * h), up[:, None] * h, down.T @ h


class Learner:
    """A copy of the network that learns from one shard of texts, in their order."""

    def __init__(self, start: np.ndarray, vocabulary: Vocabulary, shard: int):
        self.network, self.vocabulary = Network(vocabulary.rows).load(start), vocabulary
        self.squares = np.zeros(len(self.network.table), dtype=np.float32), np.zeros(len(self.network.out), dtype=np.float32)
        self.rng, self.places = np.random.default_rng([29, shard]), 0

    def learn(self, texts: list[np.ndarray]) -> None:
        net, voc = self.network, self.vocabulary
        flat, padded, places, _ = laid_out(texts, voc)
        share = voc.share[flat]
        order = self.rng.permutation(len(places))
        for i in range(0, len(order), BATCH):
            own = order[i : i + BATCH]
            around, words = net.around(padded, places[own]), padded[places[own] + SIDE]
            drawn = voc.draw(self.rng.random(DRAWN))
            into, up, down = net.steps(around, words, share[own], drawn)
            _add_by_row(net.table, self.squares[0], around.ravel(), into, RATE)
            _add_by_row(net.out, self.squares[1], np.concatenate([words, drawn]), np.concatenate([up, down]), RATE)
        self.places += len(places)


def laid_out(texts: list[np.ndarray], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, padded rows, places, lengths) of texts laid end to end; a place p is a word's, whose row
    stands at padded[p + SIDE]."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    flat = np.concatenate(texts) if len(texts) else np.zeros(0, dtype="<i4")
    first = np.cumsum(lengths + SIDE) - lengths - SIDE
    places = np.arange(len(flat)) + np.repeat(first - (np.cumsum(lengths) - lengths), lengths)
    padded = np.full(len(flat) + SIDE * (len(texts) + 1), vocabulary.rows, dtype=np.int32)
    padded[places + SIDE] = vocabulary.of[flat]
    return flat, padded, places, lengths


def _grouped(words: pd.Series) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(from, to, texts) of neighbouring rows, some 100,000 words each."""
    at, held, n = 0, [], 0
    for i, raw in enumerate(words):
        held.append(np.frombuffer(raw, dtype="<i4"))
        n += len(held[-1])
        if n >= GROUP_WORDS or i + 1 == len(words):
            yield at, i + 1, held
            at, held, n = i + 1, [], 0


def train(made: DataFrame, network: Network, parts_sent, n: int) -> Network:
    """One pass over all places; ``n``: the rows of ``made`` (doc_id, words); ``parts_sent``: a broadcast of
    the vocabulary's parts.  The start of the network is made anew in each task."""
    spark, rows, size = made.sparkSession, network.rows, len(network.flat())
    shards, parts = max(1, round(n / SHARD_DOCS)), int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start, voc = Network(rows).flat(), Vocabulary(*parts_sent.value)
        total, places, own, shard = np.zeros(len(start), dtype=np.int64), 0, None, None
        held: list[np.ndarray] = []
        words = 0

        def ended() -> None:
            nonlocal total, places
            own.learn(held)
            # whole numbers, so that sums do not depend on their order
            total += np.rint((own.network.flat() - start) * np.float32(FIXED)).astype(np.int64) * own.places
            places += own.places

        for b in batches:
            for at, raw in zip(b["shard"], b["words"]):
                if at != shard:
                    if own is not None:
                        ended()
                    own, shard, held, words = Learner(start, voc, int(at)), at, [], 0
                held.append(np.frombuffer(raw, dtype="<i4"))
                words += len(held[-1])
                if words >= GROUP_WORDS:
                    own.learn(held)
                    held, words = [], 0
        if own is not None:
            ended()
            yield _cut(np.append(total, places))

    dealt = made.withColumn("h", F.xxhash64("words", "doc_id")).withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    sorted_ = dealt.repartition(parts, "shard").sortWithinPartitions("shard", "h", "doc_id")
    total = _added(sorted_.select("shard", "words").mapInPandas(run, "at long, numbers binary"), size + 1)
    if total[-1]:
        network.load(network.flat() + total[:-1] / total[-1] / FIXED)
    return network


def pseudo_log_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, log_likelihood, per_word) for every row of ``docs``.

    ``log_likelihood`` sums over all words of the whole text, however long; ``per_word`` is its mean.
    Null and empty texts have no words, 0 and a null mean; repeated rows score alike and count as often
    as they occur; null ids stay; an empty table gives an empty result; other columns are not read.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "pseudo_likelihood")
    made = scratch.save(tokens(docs, id_col, text_col), "tokens")
    vocabulary = Vocabulary.of_counts(corpus_counts(made))
    # a share for each bucket (4 MB at any size), and later the network (42 MB at most)
    parts_sent = spark.sparkContext.broadcast(vocabulary.parts)
    network = train(made, Network(vocabulary.rows), parts_sent, made.count())
    sent = spark.sparkContext.broadcast(network.flat())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flat, voc = sent.value, Vocabulary(*parts_sent.value)
        net = Network(voc.rows).load(flat)
        drawn = voc.draw((np.arange(DRAWN_TO_SCORE) + 0.5) / DRAWN_TO_SCORE)
        for b in batches:
            n, score = np.zeros(len(b), dtype=np.int64), np.zeros(len(b))
            for at, to, texts in _grouped(b["words"]):
                own, padded, places, lengths = laid_out(texts, voc)
                each = net.log_probabilities(padded, places, voc.share[own], drawn)
                n[at:to] = lengths
                score[at:to] = np.bincount(np.repeat(np.arange(len(texts)), lengths), weights=each, minlength=len(texts))
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_words": n, "log_likelihood": score})

    scored = made.mapInPandas(run, "doc_id long, n_words long, log_likelihood double")
    return scored.withColumn("per_word", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def op8_pseudo_likelihood(spark, sf_dir: str) -> DataFrame:
    """Scores all ``documents``."""
    return pseudo_log_likelihood(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
