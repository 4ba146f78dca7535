"""Manifests, read-back comparison and package checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import content_hash, record_signature
from ..functions.rules import has, is_web, yes


def record_signatures(records: DataFrame) -> DataFrame:
    names = ("id", "name", "official_url", "github_repo_url", "description")
    return records.select(*names[:4], record_signature(*(F.col(c) for c in names)).alias("signature"))


def file_facts(spark, path: str) -> DataFrame:
    """(path, file_size_bytes, file_sha256) of the files at ``path``."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("file_size_bytes"), content_hash(F.col("content")).alias("file_sha256"))


def manifest_facts(records: DataFrame) -> DataFrame:
    """The record count and a hash of the sorted signatures, independent of row order and partitions.

    Signatures are added up in two 64-bit halves, so nothing is gathered."""
    signed = record_signatures(records)
    halves = [F.conv(F.substring("signature", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in (0, 1)]
    return signed.agg(F.count("*").alias("record_count"), *(F.coalesce(F.sum(h), F.lit(0)).cast("string").alias(f"signature_sum_{i}") for i, h in enumerate(halves)))


def hash_tree(records: DataFrame, depth: int = 2) -> DataFrame:
    """(level, prefix, record_count, digest): a hash tree over the records by the hash of their ids.

    A leaf holds the records whose ids' SHA-256 begins with its ``depth`` hex digits: its digest is that of
    their number and the sums of their signatures, so order and partitions don't matter and nothing
    is gathered.  A node's digest is that of its children's, sixteen at most, in order; the root
    (level 0) stands for the whole table.  An empty table has no node.
    """
    signed = record_signatures(records).withColumn("prefix", F.substring(F.sha2(F.coalesce("id", F.lit("")), 256), 1, depth))
    halves = [F.sum(F.conv(F.substring("signature", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).cast("string") for i in (0, 1)]
    level = signed.groupBy("prefix").agg(F.count("*").alias("record_count"), F.sha2(F.concat_ws(":", F.count("*").cast("string"), *halves), 256).alias("digest"))
    levels = [level.withColumn("level", F.lit(depth))]
    for k in reversed(range(depth)):
        children = F.array_sort(F.collect_list(F.struct("prefix", "digest")))
        level = level.groupBy(F.substring("prefix", 1, k).alias("prefix")).agg(
            F.sum("record_count").alias("record_count"), F.sha2(F.array_join(F.transform(children, lambda c: c["digest"]), ""), 256).alias("digest")
        )
        levels.append(level.withColumn("level", F.lit(k)))
    return reduce(DataFrame.unionByName, levels).select("level", "prefix", "record_count", "digest")


def tree_differences(expected: DataFrame, actual: DataFrame, depth: int = 2) -> tuple[list[str], int]:
    """(prefixes of the leaves that differ, nodes looked at): two trees are compared from the root down, and
    only below nodes that differ."""
    differ, looked = [""], 0
    for k in range(depth + 1):
        below = F.substring("prefix", 1, max(k - 1, 0)).isin(differ)
        e, a = (t.where((F.col("level") == k) & below).select("prefix", F.col("digest").alias(n)) for t, n in ((expected, "_e"), (actual, "_a")))
        rows = e.join(a, "prefix", "full").select("prefix", (~F.col("_e").eqNullSafe(F.col("_a"))).alias("differs")).collect()  # sixteen a node that differs
        differ, looked = [r["prefix"] for r in rows if r["differs"]], looked + len(rows)
        if not differ:
            return [], looked
    return sorted(differ), looked


def changed_records(expected: DataFrame, actual: DataFrame, depth: int = 2) -> DataFrame:
    """``signature_changes`` of two tables of records, of which only leaves that differ are compared."""
    leaves, _ = tree_differences(hash_tree(expected, depth), hash_tree(actual, depth), depth)
    own = lambda r: record_signatures(r.where(F.substring(F.sha2(F.coalesce("id", F.lit("")), 256), 1, depth).isin(leaves)))
    return signature_changes(own(expected), own(actual))


def manifest(spark, path: str, records: DataFrame) -> DataFrame:
    """(path, file_size_bytes, file_sha256, record_count, tree_digest) of the files of one table: sizes, hashes and
    the records' own digest in one; the table's root digest and count stand beside each file."""
    root = hash_tree(records).where("level = 0").select("record_count", F.col("digest").alias("tree_digest"))
    return file_facts(spark, path).crossJoin(F.broadcast(root))  # one row, whatever the input


def verify_manifest(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, status, reason): files of ``expected`` against ``actual``, both (path, file_sha256, record_count)."""
    a = actual.select("path", F.col("file_sha256").alias("_sha"), F.col("record_count").alias("_n"))
    joined = expected.join(a, "path", "left")
    reason = (
        F.when(F.col("_sha").isNull(), F.concat(F.lit("Tools file missing: "), "path"))
        .when(F.col("_sha") != F.col("file_sha256"), F.concat(F.lit("File SHA256 mismatch: "), "_sha", F.lit(" != "), "file_sha256"))
        .when(F.col("_n") != F.col("record_count"), F.concat(F.lit("Record count mismatch: "), F.col("_n").cast("string"), F.lit(" != "), F.col("record_count").cast("string")))
    )
    return joined.select("path", F.when(reason.isNull(), "PASS").otherwise("FAIL").alias("status"), reason.alias("reason"))


def signature_changes(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(id, change): records added, removed or changed between two tables of signatures."""
    e, a = expected.select("id", F.col("signature").alias("_e")), actual.select("id", F.col("signature").alias("_a"))
    change = F.when(F.col("_a").isNull(), "removed").when(F.col("_e").isNull(), "added").when(F.col("_e") != F.col("_a"), "changed")
    return e.join(a, "id", "full").select("id", change.alias("change")).where(F.col("change").isNotNull())


def read_back_differences(written: DataFrame, read: DataFrame, key: str) -> DataFrame:
    """(key, column, written, read) for each cell that differs, rows on one side only included."""
    columns = [c for c in written.columns if c != key]
    w = written.select(F.col(key).alias("key"), F.lit(True).alias("_w"), *(F.col(c).cast("string").alias(f"w_{i}") for i, c in enumerate(columns)))
    r = read.select(F.col(key).alias("key"), F.lit(True).alias("_r"), *(F.col(c).cast("string").alias(f"r_{i}") for i, c in enumerate(columns)))
    both = w.join(r, "key", "full")
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"w_{i}").alias("written"), F.col(f"r_{i}").alias("read")) for i, c in enumerate(columns)))
    one_sided = F.col("_w").isNull() | F.col("_r").isNull()
    return both.select("key", F.explode(F.filter(cells, lambda x: one_sided | ~x["written"].eqNullSafe(x["read"]))).alias("x")).select("key", "x.*")


def package_checks(records: DataFrame) -> DataFrame:
    """One row of failure counts; a sound package has zeros throughout."""
    site = F.col("official_url")
    tests: dict[str, Column] = {
        "blank_id": ~has(F.col("id")), "blank_name": ~has(F.col("name")), "blank_description": ~has(F.col("description")),
        "bad_source_url": ~is_web(F.col("source_url")), "platform_website": yes(F.lower(site).contains("github.com")),
    }
    return records.agg(
        *(F.count_if(c).alias(n) for n, c in tests.items()), (F.count("id") - F.count_distinct("id")).alias("repeated_ids"), F.count("*").alias("records")
    )
