"""The shapes a record takes on its way: extracted, cleaned, normalized, canonical."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import tool_id
from ..functions.rules import filled, first_filled, has, yes
from ..functions.text import canonical_name, clean_text, clean_text_simple, pricing_model
from ..functions.url import host_of, normalize_url

#: Columns of a raw candidate and their types.
RAW = {
    "name": "string", "url": "string", "official_url": "string", "company_name": "string", "company_url": "string",
    "description": "string", "category": "string", "pricing_model": "string", "github_stars": "bigint",
    "github_repo_url": "string", "github_owner": "string", "github_topics": "array<string>", "is_fork": "boolean",
    "is_archived": "boolean", "readme_content": "string", "readme_url": "string", "readme_available": "boolean",
    "discovery_source_name": "string", "discovery_source_url": "string", "discovery_source_type": "string",
    "discovery_source_trust_level": "string", "discovery_query": "string", "external_evidence_available": "boolean",
    "external_evidence_url": "string",
    "evidence_sources": "array<struct<url:string,source_type:string,trust_level:string,evidence_type:string>>",
    "source_name": "string", "source_url": "string", "source_type": "string", "source_trust_level": "string",
    "discovery_method": "string",
}


def with_raw_columns(raw: DataFrame) -> DataFrame:
    """``raw`` with all columns of a candidate, null where it has none; others stay."""
    missing = {c: F.lit(None).cast(t) for c, t in RAW.items() if c not in raw.columns}
    return raw.withColumns(missing) if missing else raw


def extract(raw: DataFrame, source_name: str) -> DataFrame:
    """Raw candidates in the extracted shape; empty strings count as missing."""
    r = with_raw_columns(raw)
    origin = F.coalesce(first_filled(F.col("source_url"), F.col("url")), F.lit(""))
    unknown = F.lit("UNKNOWN")
    made = {
        "name": F.trim(F.coalesce("name", F.lit(""))), "url": F.trim(F.coalesce("url", F.lit(""))), "description": F.trim(filled(F.col("description"))),
        "discovery_source_name": F.coalesce(filled(F.col("discovery_source_name")), F.lit(source_name)),
        "discovery_source_url": F.coalesce(filled(F.col("discovery_source_url")), origin),
        "discovery_source_type": F.coalesce(filled(F.col("discovery_source_type")), "source_type", unknown),
        "discovery_source_trust_level": F.coalesce(filled(F.col("discovery_source_trust_level")), "source_trust_level", unknown),
        "external_evidence_available": yes(F.col("external_evidence_available")),
        "evidence_sources": F.coalesce("evidence_sources", F.array().cast(RAW["evidence_sources"])),
        "github_topics": F.coalesce("github_topics", F.array().cast("array<string>")),
        "is_fork": yes(F.col("is_fork")), "is_archived": yes(F.col("is_archived")), "readme_available": yes(F.col("readme_available")),
        "source_name": F.lit(source_name), "source_url": origin, "source_type": F.coalesce("source_type", unknown),
        "source_trust_level": F.coalesce("source_trust_level", unknown), "discovery_method": F.coalesce("discovery_method", unknown),
    }
    return r.withColumns(made)


def clean(records: DataFrame, plain: bool = False) -> DataFrame:
    """The five text columns cleaned; ``plain`` for texts that need no NFKC and no HTML parser."""
    one = clean_text_simple if plain else clean_text
    made = {c: one(F.col(c)) for c in ("name", "description", "company_name", "category", "pricing_model")}
    made["name"] = F.coalesce(made["name"], F.lit(""))
    return records.withColumns(made)


def _url(c: str) -> Column:
    return F.when(has(F.col(c)), normalize_url(F.col(c)))


def normalize(records: DataFrame) -> DataFrame:
    """Cleaned records in the normalized shape, with id, canonical_name and domain."""
    first = records.withColumns({"_url": normalize_url(F.coalesce("url", F.lit(""))), "name": F.coalesce("name", F.lit(""))})
    second = first.withColumns({"url": F.col("_url"), "domain": host_of(F.col("_url"))})
    raw_name = first_filled(F.col("raw_name"), F.col("name")) if "raw_name" in records.columns else F.col("name")
    made = {
        "id": tool_id(F.col("domain"), F.col("name")), "raw_name": raw_name, "canonical_name": canonical_name(F.col("name")),
        "official_url": _url("official_url"), "pricing_model": pricing_model(F.col("pricing_model")),
        "categories": F.array_compact(F.array(filled(F.col("category")))), "company_url": _url("company_url"),
        "discovery_source_url": normalize_url(F.coalesce(first_filled(F.col("discovery_source_url"), F.col("source_url")), F.lit(""))),
        "external_evidence_url": _url("external_evidence_url"), "github_repo_url": _url("github_repo_url"),
        "source_url": normalize_url(first_filled(F.col("source_url"), F.col("_url"))),
    }
    return second.withColumns(made).drop("_url", "category")


def split_official_url(homepage: Column, repo_url: Column) -> tuple[Column, Column]:
    """(official_url, url): the homepage if it is a website of its own, and the address to use."""
    page = F.trim(homepage)
    official = F.when(yes(page.startswith("http") & ~F.lower(page).contains("github.com")), page)
    return official, F.coalesce(official, repo_url)


def verification_url() -> Column:
    return first_filled(F.col("official_url"), F.col("github_repo_url"), F.col("url"))


def with_site_evidence(records: DataFrame) -> DataFrame:
    """The verified site appended to evidence_sources unless its address is there."""
    fresh = F.struct(
        F.col("url").alias("url"), F.lit("WEBSITE").alias("source_type"), F.lit("OFFICIAL").alias("trust_level"), F.lit("VERIFIED_WEBSITE").alias("evidence_type")
    )
    known = F.exists("evidence_sources", lambda e: e["url"].eqNullSafe(F.col("url")))
    return records.withColumn(
        "evidence_sources",
        F.when((F.col("verification_status") == "ACCESSIBLE_VERIFIED") & ~known, F.array_append("evidence_sources", fresh)).otherwise(F.col("evidence_sources")),
    )


def canonical(records: DataFrame, as_of: str) -> DataFrame:
    """Accepted records as canonical ones: ids from the raw address, nested sources, derived flags."""

    def source(prefix: str) -> Column:
        return F.struct(
            F.col(f"{prefix}_name").alias("name"), F.col(f"{prefix}_url").alias("url"), F.col(f"{prefix}_type").alias("source_type"),
            F.col(f"{prefix}_trust_level").alias("source_trust_level"),
        )

    return records.withColumns({
        "id": tool_id(F.col("url"), F.col("name")), "entity_type": F.lit("TOOL"),
        "canonical_name": F.lower(F.trim("name")), "source": source("source"), "discovery_source": source("discovery_source"),
        "website_verified": yes((F.col("verification_status") == "ACCESSIBLE_VERIFIED") & has(F.col("official_url"))),
        "github_repository_verified": yes((F.col("verification_status") == "ACCESSIBLE_VERIFIED") & has(F.col("github_repo_url"))),
        "created_at": F.lit(as_of).cast("timestamp"),
    })


def tagged_union(baseline: DataFrame, expansion: DataFrame) -> DataFrame:
    """Both tables by column name, with is_baseline."""
    return baseline.withColumn("is_baseline", F.lit(True)).unionByName(expansion.withColumn("is_baseline", F.lit(False)), allowMissingColumns=True)
