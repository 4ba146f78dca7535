"""The validation gate and the quality score of a record with its verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import SLOGAN
from ..functions.rules import first_filled, has, is_web, yes


def _listed(c: str) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))


def quality_score() -> Column:
    """0 to 1 from qualification, website, source, description, categories and logo."""
    verified = yes(F.col("verification_status") == "ACCESSIBLE_VERIFIED")
    long = F.length("description")
    told = yes((long >= 20) & F.col("description_grounded"))
    parts = (
        F.when(F.col("qualification_status") == "QUALIFIED_TOOL", 0.2).otherwise(0.0),
        F.when(has(F.col("official_url")) & verified, 0.3).when(verified | yes(F.col("github_repository_verified")), 0.15).otherwise(0.0),
        F.when(F.col("source_trust_level").isin("OFFICIAL", "HIGH"), 0.1).when(F.col("source_trust_level") == "MEDIUM", 0.05).otherwise(0.0),
        F.when(told & (long >= 30) & ~F.lower("description").startswith(SLOGAN), 0.2).when(told, 0.1).otherwise(0.0),
        F.when(F.coalesce(F.size("categories"), F.lit(0)) > 0, 0.1).otherwise(0.0),
        F.when(yes(F.col("logo_verified")), 0.1).otherwise(0.0),
    )
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return F.round(total, 2)


def gate_reason() -> Column:
    """Why a record is turned away: the first rule that it breaks; null where it breaks none."""
    status, code = F.col("verification_status"), F.col("http_status")
    url = first_filled(F.col("official_url"), F.col("github_repo_url"), F.col("url"))
    source = first_filled(F.col("discovery_source_name"), F.col("source_name"))
    source_url = first_filled(F.col("discovery_source_url"), F.col("source_url"))
    source_type = first_filled(F.col("discovery_source_type"), F.col("source_type"))
    trust = F.coalesce(first_filled(F.col("discovery_source_trust_level"), F.col("source_trust_level")), F.lit("UNKNOWN"))
    backing = first_filled(*(F.col(c) for c in ("description_source_url", "external_evidence_url", "github_repo_url", "discovery_source_url", "source_url")))
    verified = yes(status == "ACCESSIBLE_VERIFIED")
    blocked = ~verified & (yes(status.isin("ACCESS_BLOCKED", "RATE_LIMITED")) | yes(code.isin(403, 429)))
    trusted = trust.isin("OFFICIAL", "HIGH") | yes(F.exists("evidence_sources", lambda e: yes(e["trust_level"].isin("OFFICIAL", "HIGH"))))
    vouched = trusted & yes(F.col("official_domain_match"))
    code_text = F.coalesce(code.cast("string"), F.lit("None"))
    return (
        F.when(F.col("qualification_status").isin("REJECTED_NON_TOOL", "REVIEW_REQUIRED"),
               F.concat(F.lit("Qualification: "), "qualification_status", F.lit(" — "), _listed("qualification_reasons")))
        .when(~yes(F.length(F.trim("name")) >= 2), "Invalid or missing tool name")
        .when(~is_web(url), "Invalid or missing canonical URL")
        .when(source.isNull() | source_url.isNull(), "Missing discovery provenance metadata")
        .when(yes(source_type.isin("API", "OFFICIAL_REGISTRY")) & ~is_web(source_url), F.concat(F.lit("Malformed external discovery URL: "), source_url))
        .when(~yes(F.length(F.trim("description")) >= 10), "Description missing or too short")
        .when(~yes(F.col("description_grounded")), "Description is not grounded in verifiable source or website evidence")
        .when(backing.isNull(), "No evidence source URL for factual description")
        .when(blocked & ~vouched,
              F.concat(F.lit("Identity Verification Failed: ACCESS_BLOCKED (HTTP "), code_text, F.lit(") with insufficient source trust level ('"), trust,
                       F.lit("') to confirm identity")))
        .when(~verified & ~blocked,
              F.concat(F.lit("Identity Verification Failed: "), F.coalesce(first_filled(F.col("verification_reason")), F.lit("Identity could not be established"))))
        .when(F.coalesce(F.size("categories"), F.lit(0)) <= 0, "No taxonomy categories assigned")
    )


def validate(records: DataFrame) -> DataFrame:
    """``records`` with gate_reason, accepted, and for accepted ones quality_score."""
    judged = records.withColumn("gate_reason", gate_reason())
    return judged.withColumns({
        "accepted": F.col("gate_reason").isNull(), "quality_score": F.when(F.col("gate_reason").isNull(), quality_score()),
    })
