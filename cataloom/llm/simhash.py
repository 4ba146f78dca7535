"""SimHash near-duplicates: exact Hamming links found with vantage-point trees.

Fingerprints of unrelated texts sit about 32 bits apart, where a radius of 4 prunes a
vantage-point tree over all 64 bits hardly at all.  So the 64 bits are cut into ``blocks`` of about
equal width: two fingerprints that differ in at most ``radius`` bits differ in at most
``radius // blocks`` bits in one block at least.  Each block gets a vantage-point tree over its own
Hamming distance (a metric, so the triangle bounds hold) and the small block radius prunes well.

A tree is fitted to a bounded sample of fingerprints, and every fingerprint is dealt down it.  At a
node with vantage ``v`` and threshold ``t`` it goes inside when ``d <= t`` and else outside; one that
lies outside by no more than the block radius goes inside as well.  By the triangle inequality
two fingerprints within the block radius that a node separates then both are inside, so every
pair shares at least one leaf (shard).  Within a shard the tree goes on in memory and small
cells are compared on all 64 bits.  A shard returns a spanning forest of its links, at most one per
fingerprint, never all its pairs.

Where a link holds only if the texts agree, the components of these links are what may belong together.
Each is taken up with the shingle hashes of its texts, every pair within the radius that is not joined
yet is compared, and again a forest is returned.  A component too large for one task goes down the
trees once more, shingle hashes and all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import Scratch, columns, fresh

SEED = 42
SAMPLE = 4096
FITTED = 12
SHARD_ROWS = 4096
CELL_ROWS = 1536
GROUP_ROWS = 4096


def shingle_hashes(raw: bytes | None, words: int) -> np.ndarray:
    """XXH64 of each shingle of a text, repeats included; none without words."""
    parts = (raw or b"").lower().split()
    if not parts:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(parts) - words + 1)
    first = (ends - lengths)[:n].tolist()
    last = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(first, last)], dtype="<u8")


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes (0 without any)."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(raw: bytes | None, words: int = 4) -> int:
    """The unsigned 64-bit SimHash of one UTF-8 text; null, empty and blank texts give 0."""
    return majority(shingle_hashes(raw, words))


def _remixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) for every row; the fingerprint is the signed long of the same bits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = np.fromiter((fingerprint(x, words) for x in b["raw"]), dtype=np.uint64, count=len(b))
            yield pd.DataFrame({"doc_id": b["doc_id"], "fingerprint": made.view(np.int64)})

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("raw"))
    return picked.mapInPandas(run, "doc_id long, fingerprint long")


def block_masks(blocks: int) -> list[int]:
    """Masks of ``blocks`` neighbouring runs of bits that make up 64."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]


def _distance(values: np.ndarray, vantage: np.ndarray, mask: int) -> np.ndarray:
    return np.bitwise_count((values ^ vantage) & np.uint64(mask)).astype(np.int16)


def fit_tree(sample: np.ndarray, mask: int, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantages and thresholds of the first ``FITTED`` levels of a tree, node i having children 2i+1
    (inside) and 2i+2.  Below them a sample has nothing to say; see ``_node``."""
    rng = np.random.default_rng(seed)
    nodes = (1 << min(depth, FITTED)) - 1
    vantages, limits = _rule(np.arange(nodes), mask)
    members = {0: sample}
    for i in range(nodes):
        own = members.pop(i, sample[:0])
        if len(own):
            vantages[i] = own[rng.integers(len(own))]
            d = _distance(own, vantages[i], mask)
            limits[i] = np.median(d)
            members[2 * i + 1], members[2 * i + 2] = own[d <= limits[i]], own[d > limits[i]]
    return vantages, limits


def _rule(node: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantages and thresholds of nodes by rule: bits mixed from the node's number, half of the width."""
    x = (node.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29)), np.full(len(node), mask.bit_count() // 2, dtype=np.int16)


def _node(node: np.ndarray, vantages: np.ndarray, limits: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    if not len(node) or node.max() < len(vantages):
        return vantages[node], limits[node]
    return _rule(node, mask)


def deal(values: np.ndarray, vantages: np.ndarray, limits: np.ndarray, mask: int, radius: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for each leaf that a value belongs to, boundary overlaps included."""
    row, node = np.arange(len(values)), np.zeros(len(values), dtype=np.int64)
    for _ in range(depth):
        vantage, limit = _node(node, vantages, limits, mask)
        d = np.bitwise_count((values[row] ^ vantage) & np.uint64(mask)).astype(np.int16)
        inside = d <= limit
        overlap = ~inside & (d - radius <= limit)
        row, node = (
            np.concatenate([row, row[overlap]]),
            np.concatenate([2 * node + np.where(inside, 1, 2), 2 * node[overlap] + 1]),
        )
    return row, node - ((1 << depth) - 1)


class _Forest:
    """Union-find over 0..n-1 that takes links in arrays; the root is the smallest member."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def _roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            above = self.up[x]
            if np.array_equal(above, x):
                return x
            x = above

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the ends of all links."""
        x, y = a, b
        while len(x):
            x, y = self._roots(x), self._roots(y)
            apart = x != y
            x, y = x[apart], y[apart]
            np.minimum.at(self.up, np.maximum(x, y), np.minimum(x, y))

    def roots(self) -> np.ndarray:
        return self._roots(np.arange(len(self.up)))


def _compared(values: np.ndarray, mask: int, block_radius: int, cell: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(members a, members b, distances between them), which together have all pairs a < b within the block radius."""
    rng = np.random.default_rng(len(values))
    todo = [np.arange(len(values))]
    while todo:
        own = todo.pop()
        if len(own) > cell:
            v = values[own[rng.integers(len(own))]]
            d = _distance(values[own], v, mask)
            limit = np.median(d)
            inside, outside = own[d - block_radius <= limit], own[d > limit]
            if len(inside) < 0.8 * len(own) and len(outside):
                todo += [inside, outside]
                continue
        # what the block metric cannot part is compared in strips, so memory stays in bounds
        strip = max(1, 4_000_000 // max(1, len(own)))
        for at in range(0, len(own), strip):
            head = own[at : at + strip]
            yield head, own[at:], np.bitwise_count(values[head][:, None] ^ values[own[at:]][None, :])


def _of_like_size(sizes: np.ndarray, a: np.ndarray, b: np.ndarray | int, similarity: float) -> np.ndarray:
    return np.minimum(sizes[a], sizes[b]) >= similarity * np.maximum(sizes[a], sizes[b])


@dataclass(frozen=True)
class Near:
    """What a candidate pair is: fingerprints within ``radius`` bits, both fingerprints together within
    ``total``, and numbers of different shingles that allow the ``similarity``."""

    radius: int = 4
    blocks: int = 3
    total: int = 128
    similarity: float = 0.0

    @property
    def masks(self) -> list[int]:
        return block_masks(self.blocks)

    @property
    def block_radius(self) -> int:
        return self.radius // self.blocks


def shard_links(rows: pd.DataFrame, mask: int, near: Near, cell: int = CELL_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of one shard of ``rows`` (node, fingerprint, second, size): (member, root of its
    component in the shard)."""
    rows = rows.sort_values("node", kind="stable")
    nodes, values, second, sizes = (rows[x].to_numpy(np.int64) for x in ("node", "fingerprint", "second", "size"))
    values, second = values.view(np.uint64), second.view(np.uint64)
    forest = _Forest(len(nodes))
    for head, own, apart in _compared(values, mask, near.block_radius, cell):
        a, b = np.nonzero(apart <= near.radius)
        far = apart[a, b]
        a, b = head[a], own[b]
        some = (a < b) & (far + np.bitwise_count(second[a] ^ second[b]) <= near.total) & _of_like_size(sizes, a, b, near.similarity)
        forest.link(a[some], b[some])
    roots = forest.roots()
    moved = roots != np.arange(len(nodes))
    return nodes[moved], nodes[roots[moved]]


def alike(rows: pd.DataFrame, near: Near) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the similar candidate pairs among ``rows`` (node, fingerprint, second,
    size, hashes) connect; a pair that is joined already is not compared."""
    rows = rows.sort_values("node", kind="stable")
    nodes, values, second, sizes = (rows[x].to_numpy(np.int64) for x in ("node", "fingerprint", "second", "size"))
    values, second = values.view(np.uint64), second.view(np.uint64)
    names, flat = np.unique(np.frombuffer(b"".join(rows["hashes"]), dtype="<u8"), return_inverse=True)
    ends = np.cumsum(sizes)
    starts, held, label = ends - sizes, np.zeros(len(names), dtype=bool), np.arange(len(nodes))
    u, v = [], []
    for i in range(1, len(nodes)):
        bits = np.bitwise_count(values[:i] ^ values[i])
        at = np.flatnonzero((bits <= near.radius) & (label[:i] != label[i]))
        at = at[(bits[at] + np.bitwise_count(second[at] ^ second[i]) <= near.total) & _of_like_size(sizes, at, i, near.similarity)]
        if not len(at):
            continue
        own = flat[starts[i] : ends[i]]
        held[own] = True
        size = sizes[at]
        begin = np.cumsum(size) - size
        both = np.add.reduceat(held[flat[np.arange(int(size.sum())) + np.repeat(starts[at] - begin, size)]], begin, dtype=np.int64)
        held[own] = False
        for j in at[both >= near.similarity * (size + sizes[i] - both)].tolist():
            if label[j] != label[i]:
                u.append(nodes[i])
                v.append(nodes[j])
                label[label == label[j]] = label[i]
    return np.array(u, dtype=np.int64), np.array(v, dtype=np.int64)


def bands(sizes: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, band) such that rows whose sizes allow the ``similarity`` meet in a band: sizes from one
    power of two to the next, and those below that may still be similar.  With 0 there is one band."""
    rows = np.arange(len(sizes))
    if not similarity:
        return rows, np.zeros(len(sizes), dtype=np.int64)
    band = np.frexp(sizes.astype(np.float64))[1].astype(np.int64)  # 2 ** (band - 1) <= size < 2 ** band
    near = np.flatnonzero(sizes >= similarity * (1 << band))
    return np.concatenate([rows, near]), np.concatenate([band, band[near] + 1])


def _dealt(distinct: DataFrame, near: Near, shard_rows: int) -> DataFrame:
    """``distinct`` (node, fingerprint, second, size[, hashes]) with the ``shard`` of each leaf of each
    block's tree that a node belongs to.  Each band of sizes goes down the trees as far as its number
    of rows asks for."""
    masks, columns = near.masks, ["node", "fingerprint", "second", "size", *(c for c in distinct.columns if c == "hashes")]
    picked = distinct.select(*columns)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"band": bands(b["size"].to_numpy(np.int64), near.similarity)[1]})

    counted = picked.select("size").mapInPandas(count, "band long").groupBy("band").count().collect()  # 64 rows at most
    depths = {r["band"]: max(0, math.ceil(math.log2(r["count"] / shard_rows))) for r in counted}
    found = picked.select("fingerprint").orderBy(F.xxhash64("fingerprint", "node")).limit(SAMPLE).toPandas()["fingerprint"]
    sample = found.to_numpy(np.int64).view(np.uint64)
    trees = [fit_tree(sample, m, max(depths.values(), default=0), 7 + i) for i, m in enumerate(masks)]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            values = b["fingerprint"].to_numpy(np.int64).view(np.uint64)
            rows, of = bands(b["size"].to_numpy(np.int64), near.similarity)
            for band in np.unique(of).tolist():
                own = rows[of == band]
                for i, m in enumerate(masks):
                    row, leaf = deal(values[own], *trees[i], m, near.block_radius, depths[band])
                    yield b.iloc[own[row]].assign(shard=((leaf << 8 | band) << 4) | i)

    # the rows are few bytes for their work, so their partitions must not be put together
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "node long, fingerprint long, second long, size long" + ", hashes binary" * ("hashes" in columns) + ", shard long"
    return picked.mapInPandas(assign, schema).repartition(parts, "shard")


def hamming_links(distinct: DataFrame, near: Near, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(u, v): links that connect exactly the nodes of ``distinct`` (node, fingerprint, second, size) that
    candidate pairs connect."""
    masks = near.masks

    def search(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        u, v = shard_links(b, masks[int(key[0]) & 15], near)
        return pd.DataFrame({"u": u, "v": v})

    return _dealt(distinct, near, shard_rows).groupBy("shard").applyInPandas(search, "u long, v long")


def similar_links(grouped: DataFrame, near: Near, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(u, v): links that connect exactly what similar candidate pairs connect, for ``grouped`` (node,
    fingerprint, second, size, hashes, root), where all candidate pairs are in one root's group.

    Groups share shards by a hash; those of more than ``group_rows`` rows go down the trees.
    """
    sizes = grouped.groupBy("root").agg(F.count("*").alias("members"))
    large = grouped.join(sizes.where(F.col("members") > group_rows), "root", "left_semi")
    small = grouped.join(sizes.where(F.col("members") <= group_rows), "root", "left_semi")
    shards = max(1, small.select("root").count() // 1024)
    parts = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = small.withColumn("shard", F.pmod(F.xxhash64("root"), F.lit(shards))).repartition(parts, "shard")

    def in_groups(b: pd.DataFrame) -> pd.DataFrame:
        found = [alike(own, near) for _, own in b.groupby("root", sort=False) if len(own) > 1]
        u, v = (np.concatenate([x[i] for x in found] or [np.zeros(0, dtype=np.int64)]) for i in (0, 1))
        return pd.DataFrame({"u": u, "v": v})

    def in_shard(b: pd.DataFrame) -> pd.DataFrame:
        u, v = alike(b, near)
        return pd.DataFrame({"u": u, "v": v})

    links = dealt.groupBy("shard").applyInPandas(in_groups, "u long, v long")
    if large.isEmpty():
        return links
    return links.unionByName(_dealt(large, near, group_rows // 2).groupBy("shard").applyInPandas(in_shard, "u long, v long"))


def near_duplicates(
    docs: DataFrame, words: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id, n_same) for every row of ``docs``.

    Rows whose fingerprints differ in ``radius`` bits or fewer are linked; ``component_id`` is the
    smallest doc_id reachable over links, a row's own included.  Texts without words have
    fingerprint 0 and are linked like others.  Repeated rows stay, each with the same component; a
    null doc_id stays and counts for nothing (a component of null ids only has a null id); an
    empty table gives an empty result.  ``n_same``: rows with the same fingerprint.

    Exact copies meet in one aggregated row per fingerprint before anything is compared, so a group
    of copies costs as much as one text.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.save(fingerprints(docs, words, id_col, text_col), "rows")
    groups = scratch.save(
        rows.groupBy("fingerprint").agg(F.min("doc_id").alias("low"), F.count("*").alias("n_same")), "groups"
    )
    one = F.lit(1).cast("long")
    links = hamming_links(
        groups.select(F.col("fingerprint").alias("node"), "fingerprint", one.alias("second"), one.alias("size")), Near(radius=radius)
    )
    roots = connected_components(links, scratch).select(F.col("node").alias("fingerprint"), "root")
    rooted = groups.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = scratch.save(rooted.join(lowest, "root").select("fingerprint", "component_id", "n_same"), "labels")
    return rows.join(labels, "fingerprint").select("doc_id", "fingerprint", "component_id", "n_same")


def keep_one_of_near_duplicates(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = 15, blocks: int = 8, total: int = 28, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one with the smallest id.

    A similarity of 0.8 over word shingles makes SimHashes differ in 10 bits on average, in more than 15
    for about one pair in 50; a second SimHash, from the same hashes mixed anew, keeps unrelated texts
    from meeting.  Candidate pairs of different texts found by the vantage-point trees are compared on the
    hashes of their shingles, and only those of at least ``similarity`` count as links; equal texts are
    linked as they are.  The groups are those of all candidate pairs.

    A null text counts as empty; texts without words are near-duplicates of each other, so one of them
    stays.  Null ids come last; of rows with one id, and of repeated rows, one stays.  An empty table
    gives an empty result.  Very long texts are fingerprinted and compared whole.  All columns stay as
    they are, whatever their names.
    """
    scratch, near = Scratch(docs.sparkSession, "near_duplicates"), Near(radius, blocks, total, similarity)

    @F.pandas_udf("fingerprint long, second long, size long")
    def hashed(raw: pd.Series) -> pd.DataFrame:
        made = [(majority(h), majority(_remixed(h)), max(1, len(np.unique(h)))) for h in (shingle_hashes(x, words) for x in raw)]
        values = np.array([x[:2] for x in made], dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"fingerprint": values[:, 0], "second": values[:, 1], "size": np.array([x[2] for x in made], dtype=np.int64)})

    @F.pandas_udf("binary")
    def hashes(raw: pd.Series) -> pd.Series:
        return pd.Series([(np.unique(shingle_hashes(x, words)) if x.split() else np.zeros(1, dtype="<u8")).tobytes() for x in raw])

    own, text = fresh("own", docs.columns), F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = scratch.save(
        docs.withColumn(
            own, F.struct(hashed(text).alias("made"), F.md5(text).alias("digest"), F.monotonically_increasing_id().alias("row"))
        ),
        "base",
    )
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).cast("long").alias("id"), F.col(f"{own}.row").alias("row"))
    rows = base.select(f"{own}.made.*", f"{own}.digest", f"{own}.row", order.alias("first"), text.alias("raw"))
    nodes = scratch.save(
        rows.groupBy("fingerprint", "digest").agg(
            F.min("first").alias("first"), F.min("second").alias("second"), F.min("size").alias("size"), F.count("*").alias("n")
        ).withColumn("node", F.col("first.row")),
        "nodes",
    )
    links = scratch.save(hamming_links(nodes, near).distinct(), "links")
    grouped = nodes.join(connected_components(links, scratch, "candidates"), "node").select("node", "fingerprint", "second", "size", "root")
    texts = rows.select(F.col("row").alias("node"), "raw").join(grouped.select("node"), "node", "left_semi")
    grouped = scratch.save(grouped.join(texts.select("node", hashes("raw").alias("hashes")), "node"), "grouped")
    found = scratch.save(similar_links(grouped, near).distinct(), "found")
    roots = connected_components(found, scratch, "groups")
    rooted = scratch.save(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("kept"), F.sum("n").alias("n")).where("n > 1")
    several = rooted.join(firsts.select("root", "kept"), "root").select("fingerprint", "digest", F.col("kept.row").alias("kept"))
    spare = scratch.save(
        rows.select("fingerprint", "digest", "row").join(several, ["fingerprint", "digest"]).where("row <> kept").select("row"), "spare"
    )
    some = spare.count() <= 1_000_000  # 8 bytes a row, so at most some 30 MB are broadcast
    spare = spare.withColumnRenamed("row", fresh("row", base.columns))
    return base.join(F.broadcast(spare) if some else spare, base[own]["row"] == spare[spare.columns[0]], "left_anti").select(*columns(docs))


def op1_simhash_vptree(spark, sf_dir: str) -> DataFrame:
    """Contract query: 4-word shingles, links at 4 or fewer differing bits, over all ``documents``."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
