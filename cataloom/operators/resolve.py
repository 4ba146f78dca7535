"""Entity resolution: greedy, first come first kept.

A record is a duplicate of an earlier kept one by, in this order, its id, its repository, its host
with a similar name, its name, or a fuzzy name in the same block.  Duplicates keep nothing, so
matches do not chain.

What a record is depends on which earlier ones are kept, and on nothing else.  So there is one answer
that agrees with itself, and it is found in rounds: every round judges all records at once against
those that the round before kept, by joins on keys and a running value along each host.  A record whose
own grounds are settled is settled a round later, whatever the others do; when a round
changes nothing, all are.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import first_filled
from ..functions.similarity import sorted_tokens, token_sort_ratio_arrow, token_sort_ratio_of
from ..functions.text import block_key
from ..functions.url import extract_domain, normalize_url
from .ranges import with_latest
from .scratch import Scratch
from .similar import similar_pairs

FUZZY = 88.0
SURE = 95.0
SAME_HOST = 70.0
SAME_COMPANY = 85.0
#: Before a key, so that rows without one have keys of their own and don't meet in one task.
NO_KEY = "\x00"
FOUND = "struct<at:bigint,id:string,is_baseline:boolean,method:string,confidence:double>"
LATER = 1 << 61


def _key(value: Column) -> Column:
    return F.coalesce(F.when(value != "", value), F.concat(F.lit(NO_KEY), F.col("at").cast("string")))


def _has(key: str) -> Column:
    return ~F.col(key).startswith(NO_KEY)


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.unionAll(pairs.select("block", F.col("y").alias("x"), F.col("x").alias("y"), "score"))


def fuzzy_names(names: DataFrame, threshold: float = FUZZY) -> DataFrame:
    """(name, similar): for each distinct ``canonical_name`` the other names of its block that score
    ``threshold`` (above 0) or more, with their scores."""
    own = names.select(F.col("canonical_name").alias("name")).where("name <> ''").distinct().withColumns({"block": block_key(F.col("name")), "s": sorted_tokens(F.col("name"))})
    pairs = _both_ways(similar_pairs(own, threshold))
    a, b = own.select("block", F.col("s").alias("x"), "name"), own.select("block", F.col("s").alias("y"), F.col("name").alias("other"))
    near = pairs.join(a, ["block", "x"]).join(b, ["block", "y"]).select("name", "other", "score")
    same = a.join(b.withColumnRenamed("y", "x"), ["block", "x"]).where("name <> other").select("name", "other", F.lit(100.0).alias("score"))
    return near.unionAll(same).groupBy("name").agg(F.sort_array(F.collect_list(F.struct(F.col("other").alias("name"), "score"))).alias("similar"))


def _host_score(name: Column, theirs: Column) -> Column:
    """The score of two names on one host where it makes them one record, else null."""

    def judged(a: str | None, b: str | None) -> float | None:
        a, b = a or "", b or ""
        score = token_sort_ratio_of(a, b)
        return score if score >= SAME_HOST or a in b or b in a else None

    @F.pandas_udf("double")
    def run(names: pd.Series, others: pd.Series) -> pd.Series:
        return pd.Series([judged(a, b) for a, b in zip(names, others)], dtype="float64")

    return run(name, theirs)


def _links(rows: DataFrame, threshold: float, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """What makes records fuzzy matches, both ways: (x, y, score) of names, in a block and with sorted tokens as
    one key, and (x, y, score) of such a key with the company, for pairs that need like companies."""
    named = rows.where(_has("name"))
    pairs = scratch.save(_both_ways(similar_pairs(named.select("block", "s"), threshold)), "pairs")
    unit = lambda c: F.concat_ws(NO_KEY, "block", F.col(c))
    sure = pairs.where(F.col("score") >= SURE).select(unit("x").alias("x"), unit("y").alias("y"), "score")
    weak = scratch.save(pairs.where(F.col("score") < SURE).select(unit("x").alias("x"), unit("y").alias("y"), "score"), "weak")
    if weak.isEmpty():
        return sure, weak
    held = named.where("company <> ''").select("unit", "company").distinct()
    held = scratch.save(held.join(weak.select(F.col("x").alias("unit")).distinct(), "unit", "left_semi"), "companies")
    own = held.select(F.lit("").alias("block"), F.col("company").alias("s")).distinct()
    like = _both_ways(similar_pairs(own, SAME_COMPANY)).select(F.col("x").alias("company"), F.col("y").alias("other"))
    like = like.unionAll(own.select(F.col("s").alias("company"), F.col("s").alias("other")))
    met = weak.join(held.withColumnRenamed("unit", "x"), "x").join(like, "company").join(held.select(F.col("unit").alias("y"), F.col("company").alias("other")), ["y", "other"])
    return sure, met.select(F.concat_ws(NO_KEY, "x", "company").alias("x"), F.concat_ws(NO_KEY, "y", "other").alias("y"), "score")


def _judged(rows: DataFrame, sure: DataFrame, weak: DataFrame, scratch: Scratch, step: int) -> DataFrame:
    """``rows`` with ``found``, what each record is a duplicate of among the kept ones before it."""
    who = F.struct("at", "id", "is_baseline")
    kept = rows.where("kept")
    out = rows.drop("found")

    def earliest(key: str) -> DataFrame:
        """Of the kept with a key, the last of the baseline and the first of all: no second record is kept."""
        return kept.where(_has(key)).groupBy(key).agg(F.min(who).alias("_first"), F.max(F.when(F.col("is_baseline"), who)).alias("_base"))

    def target(method: str, first: Column, confidence: Column) -> Column:
        return F.when(first["at"] < F.col("at"), F.struct(first["at"].alias("at"), first["id"].alias("id"), first["is_baseline"].alias("is_baseline"), F.lit(method).alias("method"), confidence.cast("double").alias("confidence")))

    for key, method in (("id_key", "exact_stable_id"), ("repo", "github_repo_url_match"), ("name", "canonical_name_exact_match")):
        best = F.coalesce("_base", "_first")
        out = out.join(earliest(key), key, "left").withColumn(f"_{key}", target(method, best, F.lit(1.0))).drop("_first", "_base")
    for table, key in ((sure, "unit"), (weak, "employer")):
        if table is None:
            continue
        first = kept.where(_has(key)).groupBy(F.col(key).alias("y")).agg(F.min(who).alias("_first"))
        near = table.join(first, "y").groupBy(F.col("x").alias(key))
        threat = near.agg(F.min(F.struct("_first.at", "_first.id", "_first.is_baseline", "score")).alias("_near"))
        out = out.join(threat, key, "left").withColumnRenamed("_near", f"_{key}")
        if key == "unit":  # names of the same words
            own = first.select(F.col("y").alias(key), F.struct("_first.at", "_first.id", "_first.is_baseline", F.lit(100.0).alias("score")).alias("_own"))
            out = out.join(own, key, "left").withColumn("_unit", F.least("_unit", "_own")).drop("_own")
    hosts = rows.where(_has("domain")).select("domain", "at", "id", "is_baseline", "raw_name", "kept")
    latest = with_latest(hosts, "domain", "at", ["id", "is_baseline", "raw_name"], scratch, f"hosts_{step}", "kept").where(F.col("before_at").isNotNull() & ~F.col("is_baseline"))
    scored = latest.withColumn("_score", _host_score(F.col("raw_name"), F.col("before_raw_name"))).where(F.col("_score").isNotNull())
    host = F.struct(F.col("before_at").alias("at"), F.col("before_id").alias("id"), F.col("before_is_baseline").alias("is_baseline"), F.lit("domain_identity_match").alias("method"), F.round(F.col("_score") / 100, 2).alias("confidence"))
    out = out.join(scored.select("at", host.alias("_host")), "at", "left")
    fuzzy = F.least("_unit", "_employer") if weak is not None else F.col("_unit")
    found = F.coalesce("_id_key", "_repo", "_host", "_name", target("rapidfuzz_blocked_candidate", fuzzy, F.round(fuzzy["score"] / 100, 2)))
    out = out.withColumn("found", F.when(~F.col("is_baseline"), found))
    now = F.col("is_baseline") | F.col("found").isNull()
    return out.select(*(c for c in rows.columns if c not in ("kept", "changed", "found")), now.alias("kept"), (now != F.col("kept")).alias("changed"), "found")


def resolve(records: DataFrame, baseline: DataFrame | None = None, threshold: float = FUZZY, max_rounds: int = 1000) -> DataFrame:
    """``records`` with duplicate_of, match_method, match_confidence and is_baseline_match.

    Reads ordinal (unique, the order of arrival), id, domain, github_repo_url, canonical_name, company_name.
    ``baseline`` (the same columns; name, url and official_url fill in for a missing canonical_name
    and domain) comes before all records and is never a duplicate itself.  Null ids are equal; null and
    empty repositories, hosts, names and companies match nothing.
    """
    columns = ["ordinal", "id", "domain", "canonical_name", "company_name", "repo", "is_baseline"]
    given = records.withColumns({"repo": F.when(F.col("github_repo_url") != "", normalize_url(F.col("github_repo_url"))), "is_baseline": F.lit(False)}).select(*columns)
    if baseline is not None:
        anchors = baseline.where(F.col("id") != "").withColumns({
            "is_baseline": F.lit(True),
            "repo": F.when(F.col("github_repo_url") != "", normalize_url(F.col("github_repo_url"))),
            "domain": F.coalesce(first_filled(F.col("domain")), extract_domain(first_filled(F.col("official_url"), F.col("url")))),
            "canonical_name": F.coalesce(first_filled(F.col("canonical_name")), F.lower(F.trim("name"))),
        }).select(*columns)
        given = anchors.unionByName(given)
    scratch = Scratch(records.sparkSession, "resolve")
    rows = given.withColumn("at", F.when(F.col("is_baseline"), F.col("ordinal")).otherwise(F.col("ordinal") + LATER))
    rows = rows.withColumns({
        "id_key": F.coalesce(F.concat(F.lit("="), F.col("id")), F.lit("")), "repo": _key(F.col("repo")), "domain": _key(F.col("domain")),
        "name": _key(F.col("canonical_name")), "raw_name": F.col("canonical_name"), "company": F.lower(F.coalesce("company_name", F.lit(""))),
    }).withColumns({"block": block_key(F.col("canonical_name")), "s": sorted_tokens(F.col("canonical_name"))})
    rows = rows.withColumn("unit", F.when(_has("name"), F.concat_ws(NO_KEY, "block", "s")).otherwise(F.col("name")))
    rows = rows.withColumn("employer", F.when(_has("name") & (F.col("company") != ""), F.concat_ws(NO_KEY, "unit", "company")).otherwise(_key(F.lit(""))))
    rows = rows.drop("canonical_name", "company_name").withColumns({"kept": F.lit(True), "changed": F.lit(True), "found": F.lit(None).cast(FOUND)})
    rows = scratch.save(rows, "rows_0")
    sure, weak = _links(rows, threshold, scratch)
    sure, weak = scratch.save(sure, "sure"), None if weak.isEmpty() else scratch.save(weak, "like")
    rows, step = rows.drop("company", "block", "s"), 0
    while True:
        step += 1
        if step > max_rounds:
            raise RuntimeError(f"records did not settle in {max_rounds} rounds")
        rows = scratch.save(_judged(rows, sure, weak, scratch, step), f"rows_{step}")
        if rows.where("changed").isEmpty():
            break
        scratch.drop(f"rows_{step - 1}", f"hosts_{step}")
    found = rows.where("not is_baseline").select(
        "ordinal", F.col("found.id").alias("duplicate_of"), F.col("found.method").alias("match_method"), F.col("found.confidence").alias("match_confidence"),
        F.coalesce("found.is_baseline", F.lit(False)).alias("is_baseline_match"),
    )
    return records.join(found, "ordinal")


def first_arrivals(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in arrival order."""
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_r = 1").drop("_r")


def similar_on_host(rows: DataFrame, threshold: float = SAME_HOST) -> DataFrame:
    """(ordinal, before, score, matched): each record against the latest one before it on its host, which may
    hold any share of the rows."""
    named = rows.where(F.col("domain").isNotNull()).select("domain", "ordinal", "canonical_name")
    latest = with_latest(named, "domain", "ordinal", ["canonical_name"], Scratch(rows.sparkSession, "hosts"))
    known = latest.where(F.col("before_ordinal").isNotNull()).withColumnsRenamed({"before_ordinal": "before", "before_canonical_name": "_name"})
    score = token_sort_ratio_arrow(F.col("canonical_name"), F.col("_name"))
    scored = known.withColumn("score", F.round(score, 4))
    part = F.contains("canonical_name", F.col("_name")) | F.contains("_name", F.col("canonical_name"))
    return scored.select("ordinal", "before", "score", ((F.col("score") >= threshold) | part).alias("matched"))
