"""Descriptions from evidence: the package given to providers, their answers in order, and the fallback.

Providers are outside the engine: their answers come as a table (record, provider, rank, status,
description, grounded, confidence, cited addresses and source types).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lexicon import SLOGAN, VAGUE
from ..functions.rules import first_filled, has, listed, yes
from ..functions.text import clean_readme, readme_description, unquoted
from .grounding import description_flag, evidence_text, grounding_reason

CUT = "...[TRUNCATED]"


def evidence_package(records: DataFrame, most: int = 3500, least_readme: int = 500) -> DataFrame:
    """``records`` with ``evidence``: what a provider may know of a record, README cut to the budget."""
    site = first_filled(F.col("meta_description"), F.col("page_title"))
    said = first_filled(F.col("description"), F.col("raw_description"))
    repo = F.col("github_repo_url")
    readme_url = F.coalesce(first_filled(F.col("readme_url")), F.when(has(repo), F.concat(repo, F.lit("/blob/main/README.md"))))
    topics = F.coalesce("topics", F.array().cast("array<string>"))
    urls = F.array_distinct(F.filter(
        F.array("official_url", "github_repo_url", "readme_url", "external_evidence_url", "url", "source_url"), lambda u: yes(u.startswith("http"))
    ))
    used = F.length(F.coalesce("name", F.lit(""))) + F.length(F.coalesce(site, F.lit(""))) + F.length(F.coalesce(said, F.lit(""))) + F.length(F.array_join(topics, " "))
    staged = records.withColumns({"_readme": F.when(has(F.col("readme_content")), clean_readme(F.col("readme_content"))), "_room": F.greatest(F.lit(least_readme), F.lit(most) - used)})
    long = yes(F.length("_readme") > F.col("_room"))
    excerpt = F.when(long, F.concat(F.col("_readme").substr(F.lit(1), F.col("_room")), F.lit(CUT))).otherwise(F.col("_readme"))
    return staged.withColumn("evidence", F.struct(
        F.col("name").alias("tool_name"), site.alias("official_website_content"), F.when(yes(F.col("website_verified")), F.col("official_url")).alias("official_website_url"),
        said.alias("repository_description"), repo.alias("github_repo_url"), excerpt.alias("readme_excerpt"), readme_url.alias("readme_url"),
        topics.alias("topics"), F.col("company_name").alias("company_name"), urls.alias("source_urls"), long.alias("truncated"),
    )).drop("_readme", "_room")


def source_type(cited_types: Column, evidence: Column) -> Column:
    first = F.upper(F.coalesce(F.get(cited_types, F.lit(0)), F.lit("")))
    n = F.coalesce(F.size(cited_types), F.lit(0))
    return (
        F.when(n > 1, "LLM_GROUNDED_MULTI_SOURCE").when((n > 0) & first.contains("WEBSITE"), "LLM_GROUNDED_OFFICIAL_WEBSITE")
        .when((n > 0) & first.contains("README"), "LLM_GROUNDED_GITHUB_README").when((n > 0) & first.contains("REPOSITORY"), "LLM_GROUNDED_GITHUB_REPOSITORY")
        .when(has(evidence["official_website_content"]), "LLM_GROUNDED_OFFICIAL_WEBSITE").when(has(evidence["readme_excerpt"]), "LLM_GROUNDED_GITHUB_README")
        .otherwise("LLM_GROUNDED_GITHUB_REPOSITORY")
    )


def judged_responses(responses: DataFrame, packages: DataFrame, key: str = "id") -> DataFrame:
    """Each answer with its check: ``verdict`` (the grounding reason), ``usable``, ``text`` and ``quality_flag``.

    ``packages``: ``key`` and ``evidence``.  A second answer (``regenerated``) replaces a generic or
    uninformative first one if it is valid itself; otherwise the first stays.
    """
    e = F.col("evidence")
    known = evidence_text(
        *(F.coalesce(e[c], F.lit("")) for c in ("tool_name", "repository_description", "readme_excerpt", "official_website_content")),
        F.array_join(e["topics"], " "), F.coalesce(e["company_name"], F.lit("")),
    )

    def verdict(text: str) -> Column:
        return grounding_reason(F.col(text), F.col("grounded"), F.col("cited_urls"), e["source_urls"], known)

    joined = responses.join(packages.select(key, "evidence"), key)
    own, again = unquoted(F.trim("description")), unquoted(F.trim("regenerated"))
    staged = joined.withColumns({"verdict": verdict("description"), "_flag": description_flag(own), "_again": description_flag(again), "_verdict": verdict("regenerated")})
    retry = F.col("_flag").isin("LOW_INFORMATION", "GENERIC") & F.col("regenerated").isNotNull() & (F.col("_verdict") == "VALID_GROUNDED")
    better = retry & (F.col("_again") == "VALID")
    return staged.withColumns({
        "usable": yes((F.col("status") == "SUCCESS") & has(F.col("description")) & (F.col("verdict") == "VALID_GROUNDED")),
        "text": F.when(better, again).otherwise(own),
        "quality_flag": F.when(better, "VALID").when(retry & (F.col("_flag") == "LOW_INFORMATION"), "LOW_INFORMATION_GROUNDED").otherwise(F.col("_flag")),
    }).drop("_flag", "_again", "_verdict")


def first_usable(judged: DataFrame, key: str = "id") -> DataFrame:
    """The usable answer of the first provider for each record."""
    ranked = judged.where("usable").withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy("provider_rank")))
    return ranked.where("_r = 1").drop("_r")


def asked_responses(judged: DataFrame, key: str = "id") -> DataFrame:
    """The answers that a chain asks for: up to and with the first usable one of each record."""
    first = judged.withColumn("_first", F.min(F.when(F.col("usable"), F.col("provider_rank"))).over(Window.partitionBy(key)))
    return first.where(F.col("_first").isNull() | (F.col("provider_rank") <= F.col("_first"))).drop("_first")


def provider_metrics(asked: DataFrame) -> DataFrame:
    """Attempts, successes and failures of each provider, and why."""
    return asked.groupBy("provider").agg(
        F.count("*").alias("attempts"), F.count_if("usable").alias("successes"), F.count_if(~F.col("usable")).alias("failures"),
        F.count_if(F.col("status") == "MALFORMED").alias("malformed"),
        F.count_if((F.col("status") == "UNGROUNDED") | ((F.col("status") == "SUCCESS") & has(F.col("description")) & (F.col("verdict") != "VALID_GROUNDED"))).alias("ungrounded"),
    )


def source_fallback(status: Column) -> Column:
    """The description that a record's own sources give: a struct of seven fields."""
    text, meta = F.col("description"), F.col("meta_description")
    low = F.lower(F.trim(text))
    vague = has(text) & ((F.length(low) < 25) | low.startswith(SLOGAN) | low.isin(*VAGUE))
    readme = F.when(has(F.col("readme_content")) & (~has(text) | vague), readme_description(F.col("readme_content")))
    repo, outside = F.col("github_repo_url"), F.col("external_evidence_url")
    use_meta, use_readme = has(meta), ~has(meta) & readme.isNotNull()
    use_text = ~has(meta) & readme.isNull() & has(text)

    def pick(of_meta: Column, of_readme: Column, of_text: Column) -> Column:
        return F.when(use_meta, of_meta).when(use_readme, of_readme).when(use_text, of_text)

    own_type = F.when(has(repo), F.lit("GITHUB_REPOSITORY_DESCRIPTION")).when(has(outside), F.lit("EXTERNAL_EVIDENCE")).otherwise(
        F.coalesce(first_filled(F.col("discovery_source_type")), F.col("source_type"), F.lit("CURATED_SEED"))
    )
    own_url = F.when(has(repo), repo).when(has(outside), outside).otherwise(F.coalesce(first_filled(F.col("discovery_source_url")), F.col("source_url")))
    return F.struct(
        pick(unquoted(F.trim(meta)), readme, unquoted(F.trim(text))).alias("description"),
        (use_meta | use_readme | use_text).alias("description_grounded"),
        pick(F.lit("OFFICIAL_WEBSITE"), F.lit("GITHUB_README"), own_type).alias("description_source_type"),
        pick(first_filled(F.col("official_url"), F.col("url")), first_filled(F.col("readme_url"), repo), own_url).alias("description_source_url"),
        F.coalesce(pick(F.lit("EXTRACTED_FROM_WEBSITE"), F.lit("EXTRACTED_FROM_README"), F.lit("EXTRACTED_FROM_SOURCE")), F.lit("NONE")).alias("description_generation_method"),
        F.lit("NONE").alias("llm_provider_used"), status.alias("llm_enrichment_status"),
    )


def enrich(records: DataFrame, responses: DataFrame | None = None, requested: bool = False, key: str = "id") -> DataFrame:
    """``records`` with seven description columns and quality_flag: the first usable answer, or the fallback."""
    names = ["description", "description_grounded", "description_source_type", "description_source_url", "description_generation_method", "llm_provider_used", "llm_enrichment_status"]
    if not requested or responses is None:
        made = records.withColumn("_own", source_fallback(F.lit("NOT_CONFIGURED" if requested else "DISABLED")))
        return made.withColumns({n: F.col("_own")[n] for n in names}).withColumn("quality_flag", F.lit(None).cast("string")).drop("_own")
    packages = evidence_package(records)
    best = first_usable(judged_responses(responses, packages, key), key).select(
        key,
        F.struct(
            F.col("text").alias("description"), F.lit(True).alias("description_grounded"),
            source_type(F.col("cited_types"), F.col("evidence")).alias("description_source_type"),
            F.get("cited_urls", F.lit(0)).alias("description_source_url"),
            F.concat(F.lit("LLM_"), F.upper("provider")).alias("description_generation_method"),
            F.col("provider").alias("llm_provider_used"), F.lit("SUCCESS").alias("llm_enrichment_status"), F.col("quality_flag").alias("flag"),
        ).alias("_best"),
    )
    joined = packages.join(best, key, "left").withColumn("_own", source_fallback(F.lit("FAILED_FALLBACK_TO_SOURCE")))
    chosen = F.col("_best").isNotNull()
    made = {n: F.when(chosen, F.col("_best")[n]).otherwise(F.col("_own")[n]) for n in names}
    made["description_source_url"] = F.when(
        chosen, F.coalesce(F.col("_best")["description_source_url"], first_filled(F.col("official_url"), F.col("github_repo_url")))
    ).otherwise(F.col("_own")["description_source_url"])
    return joined.withColumns(made | {"quality_flag": F.col("_best")["flag"]}).drop("_best", "_own", "evidence")
