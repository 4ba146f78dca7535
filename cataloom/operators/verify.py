"""Verification of websites and logos against a table of fetched pages."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import head_of, is_platform_asset
from ..functions.lexicon import TRUSTED_SEED
from ..functions.rules import has, listed, yes
from ..functions.text import name_tokens
from ..functions.url import extract_domain, normalize_url


def with_pages(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Each record with its page, by canonical address; a record without a page has nulls.

    ``pages``: url, http_status, final_url, error_kind, title, meta_description, logo_url, logo_source.
    The parsed heads are joined, never the pages' HTML, so little is shuffled.
    """
    own = pages.withColumn("_page_key", normalize_url(F.col("url"))).drop("url").dropDuplicates(["_page_key"])
    return records.withColumn("_page_key", normalize_url(F.col("url"))).join(own, "_page_key", "left").drop("_page_key")


def parsed_pages(pages: DataFrame, references: Collection[str] | None = None) -> DataFrame:
    """Pages with title, meta_description, logo_url and logo_source instead of html; one parse each.  Where
    ``references`` are given, no other character references are decoded."""
    kept = [c for c in pages.columns if c != "html"]
    return pages.withColumn("_head", head_of(F.coalesce("html", F.lit("")), F.col("url"), references)).select(*kept, "_head.*")


def _evidence(kind: str, source: Column, value: Column, result: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), source.alias("source"), value.alias("value"), result.alias("result"))


def verify_website(records: DataFrame, timeout: float = 10.0) -> DataFrame:
    """``records`` (see ``with_pages``) with the verification of their websites.

    Reads url, name, source_url, source_name, http_status, final_url, error_kind (timeout, dns or
    other, for pages that could not be fetched), title, meta_description.
    """
    code = F.col("http_status")
    staged = records.withColumns({
        "_target": extract_domain(F.col("url")), "_final": extract_domain(F.col("final_url")),
        "_tokens": name_tokens(F.col("name")), "_title": F.coalesce("title", F.lit("")),
    })
    absent = ~has(F.col("url"))
    same = ~absent & has(F.col("source_url")) & yes(extract_domain(F.col("source_url")).eqNullSafe(F.col("_target")))
    seed = ~absent & yes(F.col("source_name") == TRUSTED_SEED)
    blocked, ok = yes(code.isin(401, 403, 429)), yes(code == 200)
    hay = F.lower(F.concat_ws(" ", "_title", F.coalesce("meta_description", F.lit("")), F.coalesce("_final", F.lit(""))))
    relevant = F.exists("_tokens", lambda t: F.contains(hay, t)) | (F.size("_tokens") == 0)
    moved = ok & ~F.col("_final").eqNullSafe(F.col("_target"))
    status = (
        F.when(absent, "NOT_FOUND").when(blocked, "ACCESS_BLOCKED").when(yes(code >= 500), "SERVER_ERROR")
        .when(code.isNotNull() & ~ok, "NOT_FOUND").when(ok & relevant, "ACCESSIBLE_VERIFIED").when(ok, "IDENTITY_MISMATCH")
        .when(F.col("error_kind") == "timeout", "TIMEOUT").when(F.col("error_kind") == "dns", "DNS_FAILURE").otherwise("UNKNOWN")
    )
    code_text = code.cast("string")
    reason = (
        F.when(absent, "Missing official URL").when(blocked, F.concat(F.lit("HTTP "), code_text, F.lit(": Anti-bot or rate limit")))
        .when(code.isNotNull() & ~ok, F.concat(F.lit("HTTP Status "), code_text))
        .when(ok & relevant, F.concat(F.lit("HTTP 200 OK | Domain: "), F.coalesce("_final", F.lit("")), F.lit(" | Title matched")))
        .when(ok, F.concat(F.lit("HTTP 200 OK, but domain/title content mismatched: '"), F.substring("_title", 1, 40), F.lit("'")))
        .when(F.col("error_kind") == "timeout", F.lit(f"Connection timeout after {timeout}s"))
        .otherwise(F.concat(F.lit("Network or SSL error: "), F.coalesce("error_kind", F.lit("no response"))))
    )
    client, source = F.lit("HTTP Client"), F.coalesce("source_name", F.lit("UNKNOWN"))
    target = F.coalesce("_target", F.lit("None"))
    evidence = listed(
        F.when(same, _evidence("DOMAIN_MATCH", source, F.concat(F.lit("Source URL domain matches target domain: "), target), F.lit(True))),
        F.when(seed, _evidence("SOURCE_CLAIM", source, F.concat(F.lit("Trusted seed asserts domain is "), target), F.lit(True))),
        F.when(~absent & blocked, _evidence("HTTP_RESPONSE", client, F.concat(F.lit("Status "), code_text), F.lit(False))),
        F.when(~absent & moved, _evidence("REDIRECT", client, F.concat(F.lit("Redirected from "), target, F.lit(" to "), F.coalesce("_final", F.lit("None"))), F.lit(True))),
        F.when(~absent & ok, _evidence("PAGE_TITLE", client, F.substring("_title", 1, 100), relevant)),
    )
    return staged.withColumns({
        "verification_status": status, "verification_reason": reason, "verification_evidence": evidence,
        "official_domain_match": same | seed, "accessible": ~absent & ok, "redirect_verified": ~absent & moved,
        "canonical_domain": F.when(~absent & ok, F.col("_final")),
    }).drop("_target", "_final", "_tokens", "_title")


def choose_logo(records: DataFrame) -> DataFrame:
    """Verified ``records`` with the five logo columns; the page's own logo_url and logo_source come in.

    A logo counts as verified only where the record has an official website and the picture is no
    asset of a code host; a code host's og:image is its social preview.
    """
    reached = has(F.col("url")) & yes(F.col("accessible")) & (F.col("verification_status") != "ACCESS_BLOCKED")
    url, source = F.when(reached, F.col("logo_url")), F.when(reached, F.col("logo_source"))
    staged = records.withColumns({"_logo": url, "_kind": source})
    foreign = is_platform_asset(F.col("_logo")) | ~has(F.col("official_url"))
    return staged.withColumns({
        "logo_url": F.col("_logo"), "logo_found": F.col("_logo").isNotNull(),
        "logo_verified": F.col("_logo").isNotNull() & ~foreign,
        "logo_access_blocked": has(F.col("url")) & (F.col("verification_status") == "ACCESS_BLOCKED"),
        "logo_source": F.when(yes(foreign & (F.col("_kind") == "og:image")), "github_social_preview").otherwise(F.col("_kind")),
    }).drop("_logo", "_kind")
