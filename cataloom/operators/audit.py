"""Audit of canonical records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import AUDIT_TERMS, SLOGAN
from ..functions.rules import has, listed, words, yes


def audit(records: DataFrame, terms=AUDIT_TERMS) -> DataFrame:
    """One audit entry of eleven fields for each record."""
    name, text = F.lower(F.coalesce("name", F.lit(""))), F.lower(F.coalesce("description", F.lit("")))
    staged = records.select(
        F.col("id").alias("record_id"), F.col("name").alias("tool_name"),
        F.filter(words(terms), lambda t: F.contains(name, t) | F.contains(text, t)).alias("_terms"),
        (~yes(F.col("website_verified")) & ~has(F.col("github_repo_url"))).alias("_unproven"),
        F.coalesce("categories", F.array().cast("array<string>")).alias("_categories"),
        (name.contains("judge0") | text.contains("code execution")).alias("_code"),
        (name.contains("prompt-optimizer") | text.contains("prompt optimizer")).alias("_prompt"),
        ((~has(F.col("official_url")) | yes(F.lower("official_url").contains("github.com"))) & yes(F.col("website_verified"))).alias("_site"),
        yes((F.col("logo_source") == "github_social_preview") & F.col("logo_verified")).alias("_logo"),
        (has(F.col("description")) & ((F.length("description") < 20) | text.startswith(SLOGAN))).alias("_poor"),
    )
    agents, models = F.col("_code") & F.array_contains("_categories", "Agents"), F.col("_prompt") & F.array_contains("_categories", "Models")
    found, bare = F.size("_terms") > 0, F.size("_categories") == 0
    shown = F.concat(F.lit("["), F.array_join(F.transform("_terms", lambda t: F.concat(F.lit("'"), t, F.lit("'"))), ", "), F.lit("]"))
    supported = F.concat(F.lit("Categories supported: ["), F.array_join(F.transform("_categories", lambda t: F.concat(F.lit("'"), t, F.lit("'"))), ", "), F.lit("]"))

    def fixed(when):
        return F.when(when, "CORRECTED").otherwise("PASS")

    def or_default(reasons, default):
        return F.when(F.size(reasons) > 0, reasons).otherwise(F.array(default))

    decided = staged.withColumns({
        "qualification_decision": F.when(found, "REJECT").when(F.col("_unproven"), "REVIEW_REQUIRED").otherwise("PASS"),
        "category_decision": F.when(agents | models, "CORRECTED").when(bare, "REVIEW_REQUIRED").otherwise("PASS"),
        "official_url_decision": fixed(F.col("_site")), "logo_decision": fixed(F.col("_logo")), "description_decision": fixed(F.col("_poor")),
    })
    decisions = F.array("qualification_decision", "category_decision", "official_url_decision", "logo_decision", "description_decision")
    overall = (
        F.when(found, "REJECT").when(F.array_contains(decisions, "REVIEW_REQUIRED"), "REVIEW_REQUIRED")
        .when(F.array_contains(decisions, "CORRECTED"), "CORRECTED").otherwise("PASS")
    )
    qualification = listed(
        F.when(found, F.concat(F.lit("Non-tool keywords detected in record: "), shown)),
        F.when(~found & F.col("_unproven"), F.lit("Missing both verified official website and GitHub repository evidence")),
    )
    category = listed(
        F.when(bare, F.lit("Uncategorized record")),
        F.when(agents, F.lit("Removed misclassified 'Agents' category from code execution API")),
        F.when(models, F.lit("Removed misclassified 'Models' category from prompt utility")),
    )
    issues = listed(
        F.when(found, F.concat(F.lit("Qualification Failure: "), shown)), F.when(~found & F.col("_unproven"), F.lit("Unverified Identity")),
        F.when(bare, F.lit("Missing Taxonomy Category")),
        F.when(agents, F.lit("Category Correction: Code execution API is not an Agent")),
        F.when(models, F.lit("Category Correction: Prompt utility is not a Model")),
        F.when(F.col("_site"), F.lit("Website Verification Correction: website_verified must be False when official_url is null or GitHub-only")),
        F.when(F.col("_logo"), F.lit("Logo Verification Correction: logo_verified must be False for github_social_preview fallback assets")),
        F.when(F.col("_poor"), F.lit("Description Grounding Correction: slogan or low-quality description present")),
    )
    return decided.select(
        "record_id", "tool_name", "qualification_decision", or_default(qualification, F.lit("Legitimate usable software tool")).alias("qualification_reasons"),
        "category_decision", or_default(category, supported).alias("category_reasons"), "official_url_decision", "logo_decision", "description_decision",
        overall.alias("overall_audit_status"), issues.alias("issues"),
    )
