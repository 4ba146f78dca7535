"""Collocations of each language: contiguous pattern growth over projected occurrence pointers.

Three passes over the texts.  The first counts words.  The second counts pairs of words by a 64-bit
hash, which rules out pairs that can't be frequent and never a frequent one.  The third points at
each occurrence of a frequent word that a possibly frequent pair begins with, and says what follows;
pointers with the same words ahead are one row with a count.  Each prefix's pointers go to one task,
which extends the prefix to the right, depth first.  What is ruled out is told to the tasks by bit sets
of fixed size: however large the corpus, they only ever let more through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow_words import slices
from .scratch import Scratch

LEAST, MOST_WORDS, SHARE, TOP = 10, 3, 50, 2000
WORD_BITS, PAIR_BITS = 24, 27
#: Groups of a language's phrases that are ranked apart first.
SALTS = 16
#: Texts of about so many bytes are worked on at once; some twenty times as much is held meanwhile.
SLICE_BYTES = 3 << 20
#: A prefix with more pointers than this share of all is dealt out by its next words.
HOT_SHARE = 200

#: One byte for one: A to Z in lower case, ends of pieces to a line feed, tabs to blanks.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[[ord(c) for c in ".,;:!?\x0b\x0c\r"]] = ord("\n")
FOLD[9] = ord(" ")


def pieces_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, code of each word in reading order, number of its piece, number of its text)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pa.concat_arrays([texts]) if texts.offset == 0 else pa.concat_arrays([texts.slice(0, 0), texts])
    _, offsets, data = texts.buffers()
    folded = pa.py_buffer(FOLD[np.frombuffer(data, dtype=np.uint8)]) if data is not None else pa.py_buffer(b"")
    own = pa.LargeStringArray.from_buffers(len(texts), offsets, folded, None, 0, texts.offset)
    lines = pc.split_pattern(own, "\n")
    text_of_line = np.repeat(np.arange(len(own)), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    words = pc.split_pattern(lines.flatten(), " ")
    line_of_word = np.repeat(np.arange(len(text_of_line)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    flat = words.flatten()
    full = pc.not_equal(flat, "")
    line = line_of_word[full.to_numpy(zero_copy_only=False)]
    coded = pc.dictionary_encode(flat.filter(full))
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), line, text_of_line[line] if len(line) else line


def _mixed(x: np.ndarray) -> np.ndarray:
    """Hashes mixed once more, 64 bits to 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))


def _hashes(distinct: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct.cast(pa.large_binary()).to_pylist()), dtype=np.uint64, count=len(distinct))


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(_mixed(first) * np.uint64(0xD6E8FEB86659FD93) + second)


def _with_lang(words: np.ndarray, langs: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(words ^ (langs * np.uint64(0xC2B2AE3D27D4EB4F)))


class _Slice:
    """The words of some neighbouring rows: codes, and per word its language and its hash within that."""

    def __init__(self, part: pa.RecordBatch):
        self.distinct, self.code, self.piece, text = pieces_of(part.column("text"))
        coded = pc.dictionary_encode(part.column("lang"))
        self.langs, per_text = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.lang = per_text[text] if len(text) else np.zeros(0, dtype=np.int64)

    def hashes(self) -> np.ndarray:
        words, langs = _hashes(self.distinct), _hashes(self.langs)
        return _with_lang(words[self.code], langs[self.lang]) if len(self.code) else np.zeros(0, dtype=np.uint64)


def _bits_of(found: DataFrame, column: str, bits: int) -> np.ndarray:
    """A set of ``2**bits`` bits with those set that ``column`` names; as many bytes as that, whatever the input."""
    rows = found.select(F.bitmap_bucket_number(column).alias("bucket"), F.bitmap_bit_position(column).alias("bit"))
    maps = rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map")).collect()
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for r in maps:  # buckets count from 1, bits within a byte from the lowest
        out[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(r["map"], dtype=np.uint8)
    return out


def _is_set(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _place(h: np.ndarray, bits: int) -> np.ndarray:
    """Numbers from 1 to 2**bits - 1, as the bitmap functions count them from 1."""
    return np.maximum((h >> np.uint64(64 - bits)).astype(np.int64), 1)


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, f, place): how often each word occurs in each language, and its bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                s = _Slice(part)
                key, at, n = np.unique(s.lang * max(1, len(s.distinct)) + s.code, return_index=True, return_counts=True)
                place = _place(s.hashes()[at], WORD_BITS)
                made = [s.langs.take(pa.array(s.lang[at])), s.distinct.take(pa.array(s.code[at])).cast(pa.string()), pa.array(n.astype(np.int64)), pa.array(place)]
                yield pa.RecordBatch.from_arrays(made, ["lang", "word", "n", "place"])

    counted = texts.mapInArrow(run, "lang string, word string, n long, place long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("f"), F.min("place").alias("place"))


def pair_counts(texts: DataFrame, word_bits: np.ndarray, least: int) -> DataFrame:
    """(place,) of each pair of frequent words, by its hash, that occurs ``least`` times or more."""
    sent = texts.sparkSession.sparkContext.broadcast(word_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                s = _Slice(part)
                h = s.hashes()
                good = _is_set(sent.value, _place(h, WORD_BITS) - 1)
                both = np.flatnonzero((s.piece[1:] == s.piece[:-1]) & good[1:] & good[:-1])
                pair, n = np.unique(_pair_hash(h[both], h[both + 1]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    counted = texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    place = F.shiftrightunsigned("h", 64 - PAIR_BITS)
    return counted.select(F.greatest(place, F.lit(1)).alias("place"))


def pointers(texts: DataFrame, pair_bits: np.ndarray, most_words: int) -> DataFrame:
    """(lang, w0, ..., n): the words from each place on that a possibly frequent pair begins at, as far as
    each next pair is possibly frequent too, ``most_words`` at most, null beyond; ``n`` places of each."""
    sent = texts.sparkSession.sparkContext.broadcast(pair_bits)
    names = [f"w{k}" for k in range(most_words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                s = _Slice(part)
                h, m = s.hashes(), len(s.code)
                follows = np.zeros(m + most_words, dtype=bool)
                both = np.flatnonzero(s.piece[1:] == s.piece[:-1])
                follows[both] = _is_set(sent.value, _place(_pair_hash(h[both], h[both + 1]), PAIR_BITS) - 1)
                at = np.flatnonzero(follows[:m])
                ahead, going = [s.code[at]], np.ones(len(at), dtype=bool)
                for k in range(1, most_words):
                    going = going & follows[at + k - 1]
                    ahead.append(np.where(going, s.code[np.minimum(at + k, max(m - 1, 0))] if m else 0, -1))
                rows = np.column_stack([s.lang[at], *ahead])
                order = np.lexsort(rows.T[::-1])
                rows = rows[order]
                first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)]) if len(rows) else np.zeros(0, dtype=np.int64)
                n, rows = np.diff(np.r_[first, len(order)]), rows[first]
                words = [s.distinct.take(pa.array(rows[:, 1 + k], mask=rows[:, 1 + k] < 0)).cast(pa.string()) for k in range(most_words)]
                yield pa.RecordBatch.from_arrays([s.langs.take(pa.array(rows[:, 0])), *words, pa.array(n.astype(np.int64))], ["lang", *names, "n"])

    schema = "lang string, " + ", ".join(f"{w} string" for w in names) + ", n long"
    return texts.mapInArrow(run, schema).groupBy("lang", *names).agg(F.sum("n").alias("n"))


def grow(columns: list[np.ndarray], n: np.ndarray, at: np.ndarray, depth: int, least: int, prefix: tuple, out: list[tuple]) -> None:
    """Extends ``prefix`` to the right, depth first, over its projected pointers.

    ``columns[k]`` numbers the words k places on (-1: none), ``n`` counts the pointers of each row, and ``at`` are
    the prefix's rows.  Each extension with ``least`` pointers or more goes to ``out`` with its count,
    then its own rows are extended.
    """
    if depth == len(columns):
        return
    going = at[columns[depth][at] >= 0]
    if not len(going):
        return
    order = going[np.argsort(columns[depth][going], kind="stable")]
    words = columns[depth][order]
    first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
    total = np.add.reduceat(n[order], first)
    for i in np.flatnonzero(total >= least).tolist():
        longer = (*prefix, int(words[first[i]]))
        out.append((longer, int(total[i])))
        grow(columns, n, order[first[i] : first[i + 1] if i + 1 < len(first) else len(order)], depth + 1, least, longer, out)


def frequent_phrases(pointed: DataFrame, most_words: int, least: int, scratch: Scratch) -> DataFrame:
    """(lang, words, f): phrases of 2 to ``most_words`` words with ``least`` occurrences or more.

    A task takes a prefix's pointers: a word's, or where one word has over 1/200 of all rows, those of each of
    its next words; and so on.  There are at most 200 such prefixes of each length, so they are told
    to all tasks.  Of prefixes that are dealt out, the phrase itself is counted by partial sums.
    """
    names = [f"w{k}" for k in range(most_words)]
    spark, total = pointed.sparkSession, pointed.count()
    dealt, found, length = pointed.withColumn("task", F.lit(1)), None, 1
    while length < most_words:
        key = ["lang", *names[:length]]
        hot = dealt.where(F.col("task") == length).groupBy(*key).count().where(F.col("count") > total / HOT_SHARE).select(*key, F.lit(length + 1).alias("more"))
        if hot.isEmpty():
            break
        dealt = scratch.save(dealt.join(F.broadcast(hot), key, "left").withColumn("task", F.when(F.col("task") == length, F.coalesce("more", "task")).otherwise(F.col("task"))).drop("more"), f"dealt_{length}")
        length += 1
        counted = dealt.where((F.col("task") >= length) & F.col(names[length - 1]).isNotNull()).groupBy("lang", *names[:length]).agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        counted = counted.select("lang", F.array(*names[:length]).alias("words"), "f")
        found = counted if found is None else found.unionAll(counted)
    # rows with no word after a prefix of the task's length extend nothing
    key = [F.when(F.col("task") > k, F.col(w)) for k, w in enumerate(names)]
    open_ = dealt.where((F.col("task") < most_words) & F.element_at(F.array(*names), F.col("task") + 1).isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole prefixes at a time; the last of a batch may go on in the next."""
        held: list[pa.RecordBatch] = []
        for b in batches:
            mark = b.column("key")
            new = np.flatnonzero(pc.not_equal(mark[1:], mark[:-1]).to_numpy(zero_copy_only=False)) + 1
            if held and b.num_rows and held[-1].column("key")[-1] != mark[0]:
                new = np.r_[0, new]
            if len(new):
                cut = int(new[-1])
                yield grown_from(pa.Table.from_batches([*held, b.slice(0, cut)]))
                held, b = [], b.slice(cut)
            if b.num_rows:
                held.append(b)
        if held:
            yield grown_from(pa.Table.from_batches(held))

    def grown_from(rows: pa.Table) -> pa.RecordBatch:
        mark = rows.column("key").combine_chunks()
        first = np.r_[0, np.flatnonzero(pc.not_equal(mark[1:], mark[:-1]).to_numpy(zero_copy_only=False)) + 1, rows.num_rows]
        coded = [pc.dictionary_encode(rows.column(w).combine_chunks()) for w in names]
        columns = [pc.fill_null(c.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64) for c in coded]
        known = [c.dictionary.to_pylist() for c in coded]
        n, tasks, langs = rows.column("n").to_numpy(), rows.column("task").to_numpy(), rows.column("lang").combine_chunks()
        lang, words, f = [], [], []
        for a, b in zip(first.tolist(), first[1:].tolist()):
            out: list[tuple] = []
            own = tuple(int(c[a]) for c in columns[: tasks[a]])
            grow(columns, n, np.arange(a, b), int(tasks[a]), least, own, out)
            lang += [langs[a].as_py()] * len(out)
            words += [[known[k][c] for k, c in enumerate(p)] for p, _ in out]
            f += [count for _, count in out]
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(words, pa.list_(pa.string())), pa.array(f, pa.int64())], ["lang", "words", "f"])

    # the whole prefix is the key
    marked = open_.withColumn("key", F.to_json(F.struct("lang", "task", *(k.alias(w) for k, w in zip(key, names)))))
    grown = marked.repartition("key").sortWithinPartitions("key", *names).select("key", "lang", "task", *names, "n").mapInArrow(run, "lang string, words array<string>, f long")
    return grown if found is None else grown.unionAll(found)


def collocations(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, share: int = SHARE, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language, as the contract defines them.

    Reads text and lang; other columns are not read.  Null texts are empty, a null lang is ``und``;
    repeated rows count each; texts of any length are read whole; ties are ordered to the last by the phrase's
    UTF-8 bytes; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    words = scratch.save(word_counts(texts), "words")
    frequent = words.where(F.col("f") >= least)
    pairs = pair_counts(texts, _bits_of(frequent, "place", WORD_BITS), least)
    pair_bits = _bits_of(scratch.save(pairs, "pairs"), "place", PAIR_BITS)
    pointed = scratch.save(pointers(texts, pair_bits, most_words), "pointers")
    phrases = scratch.save(frequent_phrases(pointed, most_words, least, scratch), "phrases")
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))

    # each cut's two parts are frequent themselves, so their counts are at hand
    known = frequent.select("lang", F.array("word").alias("part"), F.col("f").alias("count"))
    known = known.unionAll(phrases.where(F.size("words") < most_words).select("lang", F.col("words").alias("part"), F.col("f").alias("count")))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.withColumns({"left": F.slice("words", F.lit(1), F.col("k")), "right": F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))})
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("part").alias(side), F.col("count").alias(name)), ["lang", side])
    whole = "CAST({} AS DECIMAL(19, 0))"
    score = F.expr(f"CAST(CAST(1000000 AS DECIMAL(7, 0)) * ({whole.format('f')} * {whole.format('f')}) AS DECIMAL(38, 0)) div ({whole.format('l')} * {whole.format('r')})")
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    judged = cuts.withColumn("score", score).groupBy("lang", "words", "f").agg(lowest)

    # every longer phrase tells the phrases inside it how often it occurs
    inside = phrases.where(F.size("words") > 2).withColumn("size", F.explode(F.sequence(F.lit(2), F.size("words") - 1)))
    inside = inside.withColumn("i", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)))
    longer = inside.groupBy("lang", F.slice("words", F.col("i"), F.col("size")).alias("words")).agg(F.max("f").alias("longer"))
    kept = judged.join(longer, ["lang", "words"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * share))
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("f"), "phrase")
    # the best of each of some groups of phrases first, so that what meets in one task has a bound
    some = Window.partitionBy("lang", "salt").orderBy(F.desc("cut.score"), F.desc("f"), "phrase")
    salted = kept.withColumn("phrase", F.array_join("words", " ")).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    fewer = salted.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    ranked = fewer.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(total) if total.count() <= 10_000 else total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score")
    )


def op12_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``documents``."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))
