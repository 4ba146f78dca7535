"""Prefix trie of conversations: polynomial prefix fingerprints, verified groups, rollup to the parents.

Texts are moved once, to tell turns apart; all else works on narrow rows (conversation, place, turn's
number).  A conversation's fingerprint at depth d is the sum of t_i * B**i over its first d turns,
modulo two primes.  Running sums, so ranges of rows are scanned apart and their sums carried on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranges import brought, edges, in_ranges, with_brought
from .scratch import Scratch

#: Two primes below 2**31 and a base for each: products stay within 64 bits.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 794328461)
FAMILY, HEADS = 5, 9
BUCKET_BITS = 8


def powers(base: int, exponents: np.ndarray, prime: int) -> np.ndarray:
    """base ** exponents modulo ``prime``, by squaring."""
    out, square, left = np.ones(len(exponents), dtype=np.int64), base % prime, exponents.astype(np.int64)
    while left.any():
        out = np.where(left & 1, out * square % prime, out)
        square, left = square * square % prime, left >> 1
    return out


def _first_of_run(conv: np.ndarray) -> np.ndarray:
    """For each row, where its run of equal values begins."""
    starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
    return np.repeat(starts, np.diff(np.r_[starts, len(conv)]))


def _with_places(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``turns`` (conv_id, turn, role_order, h, split, bytes) with ``pos``, from 0 in each conversation."""

    def run(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for b in batches:
            conv = b.column("conv_id").to_numpy(zero_copy_only=False)
            if not len(conv):
                continue
            place = np.arange(len(conv)) - _first_of_run(conv) + 1
            if conv[0] == last:
                place[conv == last] += seen
            last, seen = conv[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(conv), part), pa.int32()), b.column("conv_id"), pa.array(place, pa.int64()), b.column("h"), b.column("split"), b.column("bytes")],
                ["part", "conv_id", "local", "h", "split", "bytes"],
            )

    schema = "part int, conv_id long, local long, h long, split int, bytes long"
    placed = scratch.save(in_ranges(turns, ["conv_id", F.col("turn").asc_nulls_first(), "role", "h", "split"], run, schema), "places")
    carries = brought(edges(placed, "part", "conv_id", "local", ["local"]), ["local"])
    joined = with_brought(placed, "part", "conv_id", "long", carries, {"before": "long"})
    return joined.select("conv_id", (F.col("local") - 1 + F.coalesce("before", F.lit(0))).alias("pos"), "h", "split", "bytes")


def _with_prints(rows: DataFrame, scratch: Scratch, primes: tuple[int, int]) -> DataFrame:
    """``rows`` (conv_id, depth, h, split, bytes, ends) with the fingerprints p and q of the first depth turns."""

    def run(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, [0, 0]
        for b in batches:
            conv = b.column("conv_id").to_numpy(zero_copy_only=False)
            if not len(conv):
                continue
            depth, mixed = b.column("depth").to_numpy(), b.column("h").to_numpy().view(np.uint64)
            split, first, made = b.column("split").to_numpy().astype(np.int64), _first_of_run(conv), []
            for k, (prime, base) in enumerate(zip(primes, BASES)):
                turn = ((mixed >> np.uint64(7 * k)) % np.uint64(prime)).astype(np.int64)
                term = (turn + 7919 * split + 1) % prime * powers(base, depth, prime) % prime
                run_sum = np.cumsum(term)  # below 2**31 a term, so a batch can't pass 64 bits
                here = (run_sum - (run_sum - term)[first]) % prime
                if conv[0] == last:
                    here[conv == last] = (here[conv == last] + held[k]) % prime
                held[k] = int(here[-1])
                made.append(here)
            last = conv[-1]
            columns = [b.column(c) for c in ("conv_id", "depth", "h", "split", "bytes", "ends")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(conv), part), pa.int32()), *columns, *(pa.array(m, pa.int64()) for m in made)],
                ["part", "conv_id", "depth", "h", "split", "bytes", "ends", "p", "q"],
            )

    schema = "part int, conv_id long, depth long, h long, split int, bytes long, ends boolean, p long, q long"
    local = scratch.save(in_ranges(rows, ["conv_id", "depth"], run, schema), "prints")
    carries = brought(edges(local, "part", "conv_id", "depth", ["p", "q"]), ["p", "q"])
    carries = [(part, conv, p % primes[0], q % primes[1]) for part, conv, p, q in carries]
    joined = with_brought(local, "part", "conv_id", "long", carries, {"p0": "long", "q0": "long"})
    whole = {c: (F.col(c) + F.coalesce(F.col(f"{c}0"), F.lit(0))) % prime for c, prime in zip("pq", primes)}
    return joined.withColumns(whole).drop("part", "p0", "q0")


def _numbered(turns: DataFrame, scratch: Scratch, mask: int) -> DataFrame:
    """``turns`` without texts, with ``h``, a hash of role and text, and ``split``.

    Every turn is compared with the representative of its hash, the least of them: the least and the
    greatest are equal unless hashes collide, and then the different turns of a hash are told apart by
    ``split``.  Both are found with partial sums, so a turn that a third of all conversations share is no hot key.
    """
    hashed = turns.withColumn("h", F.xxhash64("role", "text").bitwiseAND(F.lit(mask)))
    said = F.struct("role", "text")
    mixed = scratch.save(hashed.groupBy("h").agg(F.min(said).alias("a"), F.max(said).alias("z")).where("a <> z").select("h"), "mixed")
    narrow = hashed.withColumn("bytes", F.octet_length("text").cast("long"))
    if mixed.isEmpty():
        return narrow.withColumn("split", F.lit(0)).drop("text")
    # a hash has more than one text only by chance: its distinct texts are few
    each = hashed.join(mixed, "h").select("h", "role", "text").distinct()
    order = F.array_sort(F.collect_list(F.struct("role", "text")))
    numbers = each.groupBy("h").agg(order.alias("all")).select("h", F.posexplode("all").alias("split", "said")).select("h", "split", "said.role", "said.text")
    joined = narrow.join(numbers, ["h", "role", "text"], "left")
    return joined.withColumn("split", F.coalesce("split", F.lit(0))).drop("text")


def heads_taken(conv_id: Column) -> Column:
    """How many turns a conversation takes from the head of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows (conv_id, depth from 1, h, split, bytes, ends) of every rebuilt conversation.

    ``turns``: (conv_id, pos, h, split, bytes); ``sizes``: (conv_id, n).  The head of c's family is
    c - c % 5; its first turns are joined to at most nine ids, and only then to the conversations.
    """
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    own = sizes.select("conv_id", "n", family.alias("family"), heads_taken(F.col("conv_id")).alias("take"))
    lengths = sizes.select(F.col("conv_id").alias("family"), F.col("n").alias("there"))
    plan = own.join(lengths, "family", "left").withColumn("given", F.least("take", F.coalesce("there", F.lit(0))))
    plan = plan.withColumn("length", F.col("given") + F.greatest(F.col("n") - F.col("take"), F.lit(0)))
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS - 1)).withColumnRenamed("conv_id", "family")
    taken = heads.join(plan, "family").where("pos < given").select("conv_id", (F.col("pos") + 1).alias("depth"), "h", "split", "bytes", "length")
    kept = turns.join(plan, "conv_id").where("pos >= take")
    kept = kept.select("conv_id", (F.col("pos") - F.col("take") + F.col("given") + 1).alias("depth"), "h", "split", "bytes", "length")
    rows = taken.unionAll(kept)
    return rows.select("conv_id", "depth", "h", "split", "bytes", (F.col("depth") == F.col("length")).alias("ends"))


def _with_paths(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` with ``path``, empty unless fingerprints collide.

    All members of a group (depth, p, q) are compared with its representative, the least of their last
    turns.  Where all groups agree, equal fingerprints and equal last turns make equal fingerprints
    one turn before, so by induction groups are exact.  A group that holds several turns is split by
    them; a path names the splits that a conversation has gone through, so what follows is split too.
    """
    turn = F.struct("h", "split")
    groups = rows.groupBy("depth", "p", "q").agg(F.min(turn).alias("a"), F.max(turn).alias("z")).where("a <> z")
    mixed = scratch.save(groups.select("depth", "p", "q", "a"), "collisions")
    if mixed.isEmpty():
        return rows.withColumn("path", F.lit(""))
    other = rows.join(mixed, ["depth", "p", "q"]).where(turn != F.col("a"))
    marks = other.select("conv_id", F.col("depth").alias("at"), F.concat_ws(":", "depth", "h", "split").alias("mark"))
    marked = rows.select("conv_id", "depth").join(marks, "conv_id").where("at <= depth").groupBy("conv_id", "depth")
    paths = marked.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "mark"))), lambda m: m["mark"]), ",").alias("path"))
    return rows.join(paths, ["conv_id", "depth"], "left").withColumn("path", F.coalesce("path", F.lit("")))


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of nodes where conversations end; ``ends``: (conv_id, depth, member).

    Members are joined in pieces of neighbouring ids, 256 at most, and a node's pieces are hashed as a
    stream, so no list of all members is ever held.
    """
    piece = F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy("conv_id", "depth", F.shiftright("member", BUCKET_BITS).alias("bucket")).agg(piece.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            done = []
            for conv, depth, ids in zip(*(b.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))):
                if (conv, depth) != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (conv, depth), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _rows(done)
        if node is not None:
            yield _rows([(*node, state.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        conv, depth, digest = zip(*done) if done else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(digest, pa.string())], ["conv_id", "depth", "ends_sha256"])

    dealt = pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "bucket")
    return dealt.mapInArrow(run, "conv_id long, depth long, ends_sha256 string")


def _rolled_up(nodes: DataFrame, places: DataFrame, deepest: int, scratch: Scratch) -> DataFrame:
    """(conv_id, depth, leaves, saved): sums over each node's subtree, the root left out.

    After round k a node holds the sums of what is less than 2**k steps below it; the next round
    adds those of the nodes 2**k below.  A node's ancestor at a depth is the node of any of its members there,
    so it is looked up in ``places`` (conv_id, depth, node) by the node's own conv_id, which is no hot key.
    """
    held, step, k = nodes.select("conv_id", "depth", "leaves", "saved"), 1, 0
    while step < deepest:
        below = held.where(F.col("depth") > step).withColumn("depth", F.col("depth") - step)
        sent = below.join(places, ["conv_id", "depth"]).groupBy(F.col("node").alias("conv_id"), "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        held = scratch.save(held.unionByName(sent).groupBy("conv_id", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), f"sums_{k}")
        step, k = step * 2, k + 1
    return held


def conversation_trie(conversations: DataFrame, primes: tuple[int, int] = PRIMES, mask: int = -1) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, the root included: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Reads conv_id, turn, role, text; other columns are not read.  Turns are ordered by turn, null first,
    ties by role, then by a hash of the content; null role and text are empty; repeated rows
    are turns each; rows with a null conv_id take no part; an empty table gives no node.  ``primes`` and
    ``mask`` (bits of a turn's hash that are used) are there for tests, which make them collide.
    """
    spark, scratch = conversations.sparkSession, Scratch(conversations.sparkSession, "trie")
    given = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = scratch.save(_with_places(_numbered(given, scratch, mask), scratch), "turns")
    sizes = scratch.save(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "sizes")
    rows = _with_paths(_with_prints(rebuilt(turns, sizes), scratch, primes), scratch)
    key = ["depth", "p", "q", "path"]
    grouped = rows.groupBy(*key).agg(F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"))
    grouped = scratch.save(grouped, "groups")
    places = scratch.save(rows.join(grouped.select(*key, "node"), key).select("conv_id", "depth", "node", "ends"), "members")
    nodes = grouped.select(F.col("node").alias("conv_id"), "depth", "n_convs", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    parents = places.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent_conv_id"))
    nodes = nodes.join(parents, ["conv_id", "depth"], "left")
    children = nodes.where("depth > 1").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = scratch.save(nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long")), "nodes")
    facts = nodes.agg(F.max("depth").alias("deepest"), F.count_if(F.col("depth") == 1).alias("first"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).first()
    all_convs = sizes.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).first()
    sums = _rolled_up(nodes, places.select("conv_id", "depth", "node"), facts["deepest"] or 0, scratch)
    ends = places.where("ends").select(F.col("node").alias("conv_id"), "depth", F.col("conv_id").alias("member"))
    if all_convs["n_convs"]:
        turnless = sizes.join(places.select("conv_id").distinct(), "conv_id", "left_anti")
        ends = ends.unionAll(turnless.select(F.lit(all_convs["conv_id"]).alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member")))
    schema = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    top = [(all_convs["conv_id"], 0, None, all_convs["n_convs"], facts["first"], facts["leaves"] or 1, facts["saved"] or 0)] if all_convs["n_convs"] else []
    root = spark.createDataFrame(top, schema)
    first = F.when(F.col("depth") == 1, F.lit(all_convs["conv_id"])).otherwise(F.col("parent_conv_id"))
    below = nodes.drop("leaves", "saved").join(sums, ["conv_id", "depth"]).select(
        "conv_id", "depth", first.cast("long").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")
    )
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    whole = below.unionAll(root).join(_end_hashes(ends), ["conv_id", "depth"], "left")
    return whole.withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def op11_conversation_trie(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``conversations``."""
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
