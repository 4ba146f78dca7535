"""Best-fit packing of tokenized documents by the sum-of-squares rule."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_words import slices, split_words
from .resident import resident
from .scratch import Scratch

CAPACITY = 2048
SHARD_PIECES = 32_768
CACHE = 600_000
SEPARATOR = "\ue000"
_NEVER = np.int64(1) << 60


class WordIds:
    """Token ids of runs between white space, for a tokenizer that splits at white space first.

    Such a tokenizer gives a run the same ids alone as inside a text, added tokens in it included (they
    take no white space around them), so each distinct run is encoded once: new runs are sent in lines, parted by a private-use character that is a token
    sequence of its own.  The tables hold ``CACHE`` runs at most (or those of one slice); when they are
    full, runs that were met only once are forgotten.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.mark = np.array(self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids, dtype=np.uint32)
        self._reset()

    def _reset(self) -> None:
        self.at: dict[str, int] = {}
        self.pool, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.first, self.length = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)
        self.again = np.zeros(1 << 14, dtype=bool)

    def _forget(self) -> None:
        """Drops runs met only once, or all where too few would go."""
        runs, n = list(self.at), len(self.at)
        kept = np.flatnonzero(self.again[:n])
        first, length, pool = self.first[kept], self.length[kept], self.pool
        self._reset()
        if len(kept) <= CACHE // 2:
            ends = np.cumsum(length)
            flat = pool[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - length), length)]
            self._store([runs[i] for i in kept.tolist()], flat, length)

    def _store(self, runs: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        n = len(self.at)
        while n + len(runs) > len(self.first):
            self.first, self.length, self.again = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.length, self.again))
        self.pool[self.used : self.used + len(flat)] = flat
        self.first[n : n + len(runs)] = self.used + np.cumsum(lengths) - lengths
        self.length[n : n + len(runs)] = lengths
        self.used += len(flat)
        self.at.update(zip(runs, range(n, n + len(runs))))

    def _one_by_one(self, runs: list[str]) -> None:
        made = [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch(runs, add_special_tokens=False)]
        self._store(runs, np.concatenate(made), np.fromiter(map(len, made), dtype=np.int64, count=len(made)))

    def _learn(self, runs: list[str], line: int = 64) -> None:
        odd = [r for r in runs if SEPARATOR in r or not r]
        plain = [r for r in runs if SEPARATOR not in r and r]
        if odd:
            self._one_by_one(odd)
        if not plain:
            return
        lines = [f" {SEPARATOR} ".join(plain[i : i + line]) + f" {SEPARATOR}" for i in range(0, len(plain), line)]
        ids = np.array(
            [i for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False) for i in e.ids], dtype=np.uint32
        )
        k = len(self.mark)
        found = np.ones(max(0, len(ids) - k + 1), dtype=bool)
        for j in range(k):
            found &= ids[j : len(ids) - k + 1 + j] == self.mark[j]
        ends = np.flatnonzero(found)
        if len(ends) != len(plain):  # the mark's ids inside a run: not to be had from lines
            self._one_by_one(plain)
            return
        lengths = np.diff(ends, prepend=-k) - k
        keep = np.ones(len(ids), dtype=bool)
        for j in range(k):
            keep[ends + j] = False
        self._store(plain, ids[keep], lengths)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): the ids of all texts end to end, and how many each has."""
        distinct, codes, words = split_words(texts)
        runs = distinct.to_pylist()
        new = [r for r in runs if r not in self.at]
        if len(self.at) + len(new) > CACHE:
            self._forget()
            new = [r for r in runs if r not in self.at]
        held = len(self.at)
        if new:
            self._learn(new)
        at = np.fromiter(map(self.at.__getitem__, runs), dtype=np.int64, count=len(runs))
        self.again[at[at < held]] = True
        row = at[codes]
        lengths, first = self.length[row], self.first[row]
        ends = np.cumsum(lengths)
        flat = self.pool[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - lengths), lengths)]
        total = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(words)])]
        return flat, np.diff(total)


def word_ids(path: str) -> WordIds:
    return resident(("packing", path), lambda: WordIds(path))


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and ``end_id``, cut into
    pieces of ``capacity`` where longer."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        for batch in batches:
            for part in slices(batch, "text"):
                flat, n = encoder.encode(part.column("text"))
                ends = np.cumsum(n)
                flat = np.insert(flat, ends, end_id).astype("<u4")
                n = n + 1
                first = np.cumsum(n) - n
                count = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(n[doc] - start, capacity)
                raw, at = memoryview(flat.tobytes()), (first[doc] + start) * 4
                crc = [zlib.crc32(raw[a : a + 4 * m]) for a, m in zip(at.tolist(), length.tolist())]
                made = [
                    part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    offsets = pa.array(np.append(at // 4, len(flat)), pa.int32())
                    made, names = [*made, pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int32)))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(made, names)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return picked.mapInArrow(run, schema)


class SumOfSquares:
    """Bins of one size.  An item goes where the sum over gaps g of (open bins with gap g) squared
    becomes smallest; of equal places the fullest bin.  A full bin is closed and counts no more."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open = np.zeros(capacity + 1, dtype=np.int64)
        self.by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bins = 0

    def _put(self, size: int, gap: int | None) -> int:
        if gap is None:
            at, gap = self.bins, self.capacity
            self.bins += 1
        else:
            at = self.by_gap[gap].pop()
            self.open[gap] -= 1
        if gap > size:
            self.open[gap - size] += 1
            self.by_gap[gap - size].append(at)
        return at

    def place(self, size: int) -> int:
        """The number of the bin that takes an item of ``size`` (1 to capacity)."""
        c, n = self.capacity, self.open
        if size == c:
            return self._put(size, None)
        change = 2 * (n[: c - size] - n[size:c]) + 2  # of moving a bin from gap g to gap g - size
        change[0] -= 2 * n[0] + 1
        change[n[size:c] == 0] = _NEVER
        best = int(change.argmin())
        return self._put(size, size + best if change[best] <= 2 * n[c - size] + 1 else None)

    def best_fit(self, size: int) -> int:
        fits = np.flatnonzero(self.open[size : self.capacity])
        return self._put(size, size + int(fits[0]) if len(fits) else None)


def _packed(sizes: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    rule, bins = SumOfSquares(capacity), np.zeros(len(sizes), dtype=np.int64)
    for i in order.tolist():
        bins[i] = rule.place(int(sizes[i]))
    again = np.flatnonzero(np.bincount(bins, weights=sizes, minlength=rule.bins)[bins] < capacity)
    if len(again):
        last, moved = SumOfSquares(capacity), np.zeros(len(again), dtype=np.int64)
        for i in np.argsort(-sizes[again], kind="stable").tolist():
            moved[i] = last.best_fit(int(sizes[again[i]]))
        if last.bins < len(np.unique(bins[again])):
            bins[again] = rule.bins + moved
            bins = np.unique(bins, return_inverse=True)[1]
    return bins


def pack(sizes: np.ndarray, capacity: int = CAPACITY, seed: int = 3) -> np.ndarray:
    """A bin for each item, placed by the sum-of-squares rule.

    The rule keeps gaps of all sizes in stock; at the end of the input a stock is of no use, so the
    items of bins left open are placed once more, largest first and tightest gap first.  Both a
    shuffled order and the largest first are tried, and the one with fewer bins is kept.
    """
    sizes = np.asarray(sizes, dtype=np.int64)
    orders = (np.random.default_rng(seed).permutation(len(sizes)), np.argsort(-sizes, kind="stable"))
    return min((_packed(sizes, order, capacity) for order in orders), key=lambda b: b.max(initial=-1))


def sequences(made: DataFrame, n_pieces: int, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``made`` (see ``pieces``, and a number ``row`` of its own each) with sequence_id and offset.

    Pieces are dealt by a hash of their row numbers to shards of about ``shard_pieces``, copies too,
    packed each in one task (one row of a few numbers a piece, so a shard is small); what a shard
    leaves open is a few bins.  A sequence's number is its shard's times 2**32 plus its number there.
    """
    shards = max(1, round(n_pieces / shard_pieces))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("row").reset_index(drop=True)
        b["sequence_id"] = pack(b["length"].to_numpy(), capacity)
        b["offset"] = b.groupby("sequence_id")["length"].cumsum() - b["length"]
        b["sequence_id"] += int(key[0]) << 32
        return b[[*columns, "sequence_id", "offset"]]

    dealt = made.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def pack_documents(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece of ``docs``.

    A null or empty text is the end id alone; repeated rows are packed each; a null id stays null;
    an empty table gives an empty result.  ``path``: the tokenizer's file, at the same place on every
    machine.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    made = Scratch(docs.sparkSession, "packing").save(
        pieces(docs, path, capacity, 0, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "pieces"
    )
    return sequences(made, made.count(), capacity)


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Contract query: sequences of 2048 tokens over all ``documents``."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
