"""Substring dedup by recompression.

Recompression turns a word sequence into ever fewer symbols by rounds that look at neighbours
only.  A round first names every maximal run ``a a .. a`` by (a, length), then splits the alphabet
into left and right symbols by a hash bit and names every neighbouring pair (left, right).  Names
are 64-bit hashes of (round, parts), so they are the same in every task and document without a
dictionary being shuffled; equal names of different content would only add candidates, since
what is removed is verified below.

Beside its span each symbol carries the span of words that its making looked at (a run also looks
at both neighbours, a symbol left over at the one it could have paired with).  Symbols whose looked-at
span lies inside a window depend on that window's words alone: equal windows have equal interior
symbols.  So each window takes as its anchor the interior symbol of the highest level with any,
smallest by a hash, then leftmost; level 0 (single words) always has one.  Windows with equal words
have equal anchors, hence a window whose anchor's name occurs once cannot repeat.  Where names are
shared, the windows themselves are compared by 128-bit hashes over their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .resident import resident
from .scratch import Scratch, columns, fresh

WINDOW = 35
LEVELS = 3
GROUP_WORDS = 100_000
CACHE = 400_000
BROADCAST_KEYS = 500_000
HOT = 200
SALTS = 64
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class WordNames(dict):
    """Row numbers of words; ``table`` has the two halves of each word's 128-bit hash."""

    def __init__(self) -> None:
        super().__init__()
        self.table = np.zeros((1024, 2), dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at] = np.frombuffer(xxhash.xxh3_128_digest(word, 11), dtype=np.uint64)
        return at

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE:
            self.clear()
            self.table = self.table[:1024]
        at = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        return self.table[at]


def _names() -> WordNames:
    return resident("recompression", WordNames)


def _salt(n: int) -> np.uint64:
    return np.uint64(n * int(_A) & 0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class Symbols:
    """One level: per symbol its name, first word, looked-at span [low, high) and document."""

    def __init__(self, name, start, low, high, doc, bounds):
        self.name, self.start, self.low, self.high, self.doc, self.bounds = name, start, low, high, doc, bounds

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """``low`` of the symbol before and ``high`` of the one after; beyond a document's ends no
        window reaches, so there they lie one word outside."""
        first, last = self.bounds
        before, after = np.empty_like(self.low), np.empty_like(self.high)
        before[1:], after[:-1] = self.low[:-1], self.high[1:]
        edge = np.flatnonzero(np.diff(self.doc))
        for at in (edge + 1, np.array([0])):
            before[at] = first[self.doc[at]] - 1
        for at in (edge, np.array([len(self.doc) - 1])):
            after[at] = last[self.doc[at]] + 1
        return before, after

    def runs(self, level: int) -> "Symbols":
        same = np.zeros(len(self.name), dtype=bool)
        same[1:] = (self.name[1:] == self.name[:-1]) & (self.doc[1:] == self.doc[:-1])
        head = np.flatnonzero(~same)
        tail = np.append(head[1:], len(same)) - 1
        length = tail - head + 1
        before, after = self._neighbours()
        long = _mix(self.name[head] * _A + length.astype(np.uint64) + _salt(2 * level + 101))
        name = np.where(length > 1, long, self.name[head])
        return Symbols(name, self.start[head], before[head], after[tail], self.doc[head], self.bounds)

    def pairs(self, level: int) -> "Symbols":
        left = (_mix(self.name + _salt(level + 201)) & np.uint64(1)).astype(bool)
        first = np.zeros(len(left), dtype=bool)
        first[:-1] = left[:-1] & ~left[1:] & (self.doc[1:] == self.doc[:-1])
        second = np.zeros(len(left), dtype=bool)
        second[1:] = first[:-1]
        before, after = self._neighbours()
        low = np.where(left, self.low, before)
        high = np.where(left, after, self.high)
        head = np.flatnonzero(~second)
        paired = first[head]
        mate = np.minimum(head + 1, len(left) - 1)
        named = _mix(_mix(self.name[head] + _salt(2 * level + 102)) * _A + self.name[mate])
        return Symbols(
            np.where(paired, named, self.name[head]), self.start[head],
            np.where(paired, self.low[head], low[head]), np.where(paired, self.high[mate], high[head]),
            self.doc[head], self.bounds,
        )


def recompress(words: np.ndarray, lengths: np.ndarray, levels: int = LEVELS) -> list[Symbols]:
    """Symbols of levels 0..``levels`` over documents laid end to end; ``words``: 64-bit word names."""
    last = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(words))
    made = [Symbols(words, at, at, at + 1, doc, (last - lengths, last))]
    for level in range(levels):
        made.append(made[-1].runs(level).pairs(level))
    return made


def rolling(words: np.ndarray, base: np.uint64) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that gives the polynomial hashes, modulo 2**64, of the words from a to b."""
    powers = np.cumprod(np.full(len(words), base, dtype=np.uint64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * powers)])
    back = np.cumprod(np.full(len(words), pow(int(base), -1, 1 << 64), dtype=np.uint64))
    return lambda a, b: (sums[b] - sums[a]) * back[a]


def anchors(words: np.ndarray, lengths: np.ndarray, window: int = WINDOW, levels: int = LEVELS):
    """(start, key, place) for every window: its first word, its anchor's key (level and name) and
    the anchor's first word."""
    last = np.cumsum(lengths)
    inside = np.maximum(lengths - window + 1, 0)
    starts = np.repeat(last - lengths - np.cumsum(inside) + inside, inside) + np.arange(inside.sum())
    key, place = np.zeros(len(starts), dtype=np.uint64), np.zeros(len(starts), dtype=np.int64)
    todo = np.arange(len(starts))
    if not len(starts):
        return starts, key, place
    made, looked_at = recompress(words, lengths, levels), rolling(words, _BASES[0])
    for level in range(levels, -1, -1):
        sym = made[level]
        own = starts[todo]
        lo = np.searchsorted(sym.low, own, "left")
        hi = np.searchsorted(sym.high, own + window, "right") - 1
        some = lo <= hi
        lo, hi, now = lo[some], hi[some], todo[some]
        if len(now):
            # hash above, place below: the smallest is the least hash, then the leftmost
            hashed = _mix(sym.name + np.uint64(977)) >> np.uint64(24)
            order = np.arange(len(hashed), dtype=np.uint64)
            if len(hashed) < 1 << 24:
                rank = (hashed << np.uint64(24)) | order
            else:
                order = np.argsort(hashed, kind="stable").astype(np.uint64)
                rank = np.empty(len(order), dtype=np.uint64)
                rank[order] = np.arange(len(order), dtype=np.uint64)
            span = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
            best = np.zeros(len(now), dtype=np.uint64)
            table = rank
            for k in range(int(span.max()) + 1):
                of = span == k
                best[of] = np.minimum(table[lo[of]], table[hi[of] - (1 << k) + 1])
                table = np.minimum(table[: -(1 << k)], table[(1 << k) :]) if len(table) > 1 << k else table
            chosen = order[best & np.uint64((1 << 24) - 1) if len(order) < 1 << 24 else best].astype(np.int64)
            # the words that the symbol's making looked at lie in the window, so the key may tell them all
            key[now] = _mix(looked_at(sym.low[chosen], sym.high[chosen]) + sym.name[chosen] + _salt(level + 301))
            place[now] = sym.start[chosen]
        todo = todo[~some]
        if not len(todo):
            break
    return starts, key, place


def window_hashes(table: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit polynomial hashes of the words of each window, the halves of one 128-bit value."""
    return tuple(_mix(rolling(column, base)(starts, starts + window)) for column, base in zip(table.T, _BASES))


def _groups(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[list[bytes]]]]:
    """(from, to, word hashes, lengths, words) of neighbouring texts, some 100,000 words each."""
    at, held, split = 0, 0, []
    for i, text in enumerate(texts):
        split.append((text or b"").split())
        held += len(split[-1])
        if held >= GROUP_WORDS or i + 1 == len(texts):
            lengths = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
            yield at, i + 1, _names().of([w for s in split for w in s]), lengths, split
            at, held, split = i + 1, 0, []


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _summaries(window: int, levels: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at, to, table, lengths, split in _groups(b["raw"].tolist()):
                starts, key, place = anchors(table[:, 0], lengths, window, levels)
                # one entry for each place that serves as an anchor
                new = np.ones(len(starts), dtype=bool)
                order = np.lexsort((key, place))
                new[1:] = (place[order][1:] != place[order][:-1]) | (key[order][1:] != key[order][:-1])
                key, place = key[order][new].view(np.int64), place[order][new]
                cuts = np.searchsorted(place, np.cumsum(lengths)[:-1])
                yield pd.DataFrame({
                    "key": b["key"].iloc[at:to].to_numpy(), "n_words": lengths, "full_sha": [_sha(s) for s in split],
                    "anchors": np.split(key, cuts),
                })

    return run


def _windows(window: int, levels: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cid, copies, names = b["cid"].to_numpy(), b["copies"].to_numpy(), b["names"].tolist()
            for at, to, table, lengths, _ in _groups(b["raw"].tolist()):
                starts, key, _ = anchors(table[:, 0], lengths, window, levels)
                shared = np.isin(key, np.unique(np.concatenate([np.asarray(x, dtype=np.int64) for x in names[at:to]])).view(np.uint64))
                starts = starts[shared]
                if not len(starts):
                    continue
                a, c = window_hashes(table, starts, window)
                last = np.cumsum(lengths)
                doc = np.searchsorted(last, starts, "right")
                yield pd.DataFrame({
                    "w1": a.view(np.int64), "w2": c.view(np.int64), "cid": cid[at:to][doc],
                    "start": (starts - (last - lengths)[doc]).astype(np.int32),
                    "many": copies[at:to][doc] > 1,
                })

    return run


def _cut(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, sha, kept_text = [], [], []
            for raw, starts in zip(b["raw"], b["starts"]):
                words = raw.split()
                mark = np.zeros(len(words) + 1, dtype=np.int64)
                at = np.asarray(starts, dtype=np.int64)
                np.add.at(mark, at, 1)
                np.add.at(mark, at + window, -1)
                stay = np.cumsum(mark[:-1]) == 0
                kept = b" ".join([words[i] for i in np.flatnonzero(stay)])
                n.append(len(words) - int(stay.sum()))
                sha.append(hashlib.sha256(kept).hexdigest())
                kept_text.append(kept.decode("utf-8", "replace"))
            yield pd.DataFrame({"cid": b["cid"], "n_removed": n, "kept_sha256": sha, "kept": kept_text})

    return run


def _with_key_of(rows: DataFrame, keys: DataFrame, by: list[str], spread: list[str]) -> DataFrame:
    """The ``rows`` whose columns ``by`` are among ``keys`` (``by``, n: how many rows have it).  Keys of more
    than one in ``HOT`` of all such rows, so at most that many, are dealt to ``SALTS`` groups by a hash of ``spread``."""
    total = keys.agg(F.sum("n")).first()[0] or 0
    hot = [r[0] for r in keys.where(F.col("n") > total / HOT).select(by[0]).distinct().collect()]
    if not hot:
        return rows.join(keys.select(*by), by, "left_semi")
    is_hot, one = F.col(by[0]).isin(hot), F.lit(0)
    dealt = rows.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64(*spread), F.lit(SALTS))).otherwise(one).cast("int"))
    every = keys.select(*by, F.explode(F.when(is_hot, F.sequence(one, F.lit(SALTS - 1))).otherwise(F.array(one))).alias("salt"))
    return dealt.join(every, [*by, "salt"], "left_semi").drop("salt")


def text_key(text_col: str = "text") -> F.Column:
    """The MD5 of a text as 16 bytes; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def repeats(docs: DataFrame, text_col: str = "text", window: int = WINDOW, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """What repeats among the texts of ``docs``.

    Returns ``classes`` (key, cid, copies, n_words, full_sha), one row per distinct text, and
    ``cut`` (cid, n_removed, kept_sha256, kept), one row per distinct text that occurs once and
    loses words.  A text of ``window`` words or more that occurs twice loses all; such texts
    are counted and never expanded.
    """
    scratch = Scratch(docs.sparkSession, "recompression")
    texts = docs.select(text_key(text_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"))
    parsed = texts.mapInPandas(
        _summaries(window, levels), "key binary, n_words long, full_sha string, anchors array<long>"
    ).withColumn("rid", F.monotonically_increasing_id())
    rows = scratch.save(parsed, "rows")
    classes = scratch.save(
        rows.groupBy("key").agg(
            F.min("rid").alias("cid"), F.count("*").alias("copies"), F.max("n_words").alias("n_words"),
            F.max("full_sha").alias("full_sha"),
        ),
        "classes",
    )
    # anchors of one row of each distinct text, and those whose name another place has as well
    own = (
        rows.where(F.size("anchors") > 0).join(classes.select(F.col("cid").alias("rid")), "rid", "left_semi")
        .select(F.col("rid").alias("cid"), F.explode("anchors").alias("name"))
    )
    shared = scratch.save(own.groupBy("name").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    listed = scratch.save(
        _with_key_of(own, shared, ["name"], ["cid"]).groupBy("cid").agg(F.collect_set("name").alias("names"))
        .join(classes.select("key", "cid", "copies"), "cid"),
        "listed",
    )
    scratch.drop("rows", "shared")
    keys = listed.select("key", "cid")
    few = keys.count() <= BROADCAST_KEYS  # 24 bytes a key, so at most some 40 MB are broadcast
    found = texts.join(F.broadcast(keys) if few else keys, "key").groupBy("cid").agg(F.first("raw").alias("raw"))
    held = scratch.save(found.join(listed.select("cid", "copies", "names"), "cid"), "held")
    # every window whose anchor is shared, by its own words
    rolled = held.mapInPandas(_windows(window, levels), "w1 long, w2 long, cid long, start int, many boolean")
    twice = scratch.save(rolled.groupBy("w1", "w2").agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("n")).where("n > 1"), "twice")
    hit = _with_key_of(rolled.where("not many"), twice, ["w1", "w2"], ["cid", "start"])
    starts = hit.groupBy("cid").agg(F.collect_list("start").alias("starts"))
    cut = held.where("copies = 1").select("cid", "raw").join(starts, "cid").mapInPandas(
        _cut(window), "cid long, n_removed long, kept_sha256 string, kept string"
    )
    return classes, cut


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of ``docs``.

    A word is a run without ASCII white space.  Each word inside a window of ``window`` words whose
    sequence starts anywhere else in the table, in the same text too, is removed; all windows are
    judged on the input.  A null text has no words; shorter texts lose none; repeated rows count as
    occurrences; a null id stays; an empty table gives an empty result.
    """
    classes, cut = repeats(docs, text_col, window)
    every = (F.col("copies") > 1) & (F.col("n_words") >= window)
    facts = classes.join(cut.drop("kept"), "cid", "left").select(
        "key", "n_words",
        F.when(every, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(every, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "full_sha")).alias("kept_sha256"),
    )
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("key"))
    return ids.join(facts, "key").select("doc_id", "n_words", "n_removed", "kept_sha256")


def without_repeats(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated words cut out of ``text_col``; other texts and columns unchanged,
    whatever their names.

    Null texts and texts of fewer than ``window`` words stay; repeated rows of more words lose all of
    them and stay as empty texts; an empty table gives an empty result.
    """
    classes, cut = repeats(docs, text_col, window)
    every = (F.col("copies") > 1) & (F.col("n_words") >= window)
    key, kept = fresh("own_key", docs.columns), fresh("own_kept", docs.columns)
    changed = classes.join(cut.select("cid", "kept"), "cid", "left").where(every | F.col("kept").isNotNull()).select(
        F.col("key").alias(key), F.when(every, F.lit("")).otherwise(F.col("kept")).alias(kept)
    )
    joined = docs.withColumn(key, text_key(text_col)).join(changed, key, "left")
    return joined.withColumn(text_col, F.coalesce(kept, text_col)).select(*columns(docs))


def op7_substring_recompression(spark, sf_dir: str) -> DataFrame:
    """Contract query: windows of 35 words over all ``documents``."""
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
