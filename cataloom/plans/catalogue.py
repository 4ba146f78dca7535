"""The runs: main ingest, expansion over a baseline, replay of rules, enrichment, publication check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.audit import audit
from ..operators.classify import classify
from ..operators.enrich import enrich
from ..operators.gate import validate
from ..operators.grounding import description_flag
from ..operators.integrity import read_back_differences
from ..operators.qualify import QualifyRules, qualify, rule_changes
from ..operators.report import collision_members, expansion_rates, first_accepted, funnel, host_collisions, relationships
from ..operators.resolve import resolve
from ..operators.shape import canonical, clean, extract, normalize, tagged_union, with_raw_columns, with_site_evidence
from ..operators.verify import choose_logo, parsed_pages, verify_website, with_pages


@dataclass
class IngestRun:
    """All tables of a run; each is lazy, and ``judged`` is worth persisting before several are used."""

    judged: DataFrame
    accepted: DataFrame
    rejected: DataFrame
    relationships: DataFrame
    audit: DataFrame
    funnel: DataFrame


def ingest(
    raw: DataFrame, pages: DataFrame, source_name: str, as_of: str, qualified: bool = True, baseline: DataFrame | None = None,
    responses: DataFrame | None = None, requested: bool = False, target: int | None = None, plain: bool = False,
    hold: Callable[[DataFrame], DataFrame] = DataFrame.persist,
) -> IngestRun:
    """Candidates (with ``ordinal``) through all stages, cheap ones first.

    Only search candidates are qualified (``qualified``); seeds have no status.  ``pages`` has url,
    html, http_status, final_url, error_kind.  Stages after resolution see what is left only.  ``hold``
    keeps a stage's result, as several tables come from it and plans stay small; on a cluster it may
    write a table and read it again.
    """
    shaped = hold(normalize(clean(extract(raw, source_name), plain)))
    judged = hold(qualify(shaped) if qualified else shaped.withColumns({
        "qualification_status": F.lit(None).cast("string"), "qualification_reasons": F.lit(None).cast("array<string>"),
    }))
    passed = judged.where(F.coalesce(F.col("qualification_status") == "QUALIFIED_TOOL", F.lit(True)))
    stopped = judged.where(F.col("qualification_status") != "QUALIFIED_TOOL").withColumn("stage", F.lit("Qualification"))
    resolved = hold(resolve(passed, baseline))
    fresh, repeated = resolved.where("duplicate_of is null"), resolved.where("duplicate_of is not null").withColumn("stage", F.lit("Deduplication"))
    seen = hold(choose_logo(verify_website(with_pages(fresh, parsed_pages(pages)))))
    named = hold(classify(with_site_evidence(seen)).withColumns({
        "github_repository_verified": F.lit(None).cast("boolean"), "page_title": F.col("title"), "topics": F.col("github_topics"),
        "raw_description": F.lit(None).cast("string"),
        "website_verified": (F.col("verification_status") == "ACCESSIBLE_VERIFIED") & F.col("official_url").isNotNull(),
    }))
    done = hold(validate(hold(enrich(named, responses, requested))))
    kept = first_accepted(done, target) if target is not None else done.where("accepted")
    out = canonical(kept, as_of)
    refused = done.where("not accepted").withColumn("stage", F.lit("ValidationGate"))
    lost = [
        stopped.select("ordinal", "name", F.array_join("qualification_reasons", ", ").alias("reason"), "stage"),
        repeated.select("ordinal", "name", F.col("match_method").alias("reason"), "stage"),
        refused.select("ordinal", "name", F.col("gate_reason").alias("reason"), "stage"),
    ]
    facts = judged.select("ordinal", "qualification_status", "readme_available").join(resolved.select("ordinal", "duplicate_of"), "ordinal", "left").join(
        done.select("ordinal", "accepted"), "ordinal", "left"
    )
    return IngestRun(done, out, lost[0].unionByName(lost[1]).unionByName(lost[2]), relationships(out), audit(out), funnel(facts))


def expansion(raw: DataFrame, baseline: DataFrame, known: DataFrame | None = None, plain: bool = False, hold: Callable[[DataFrame], DataFrame] = DataFrame.persist) -> tuple[DataFrame, DataFrame]:
    """(new records, rates): raw candidates qualified as they are, then cleaned, normalized and resolved
    against the baseline; ``known`` ids from an earlier run are left out."""
    judged = hold(qualify(with_raw_columns(raw)))
    good = hold(normalize(clean(judged.where("qualification_status = 'QUALIFIED_TOOL'"), plain)))
    resolved = hold(resolve(good, baseline))
    fresh = resolved.where("duplicate_of is null")
    if known is not None:
        fresh = fresh.join(known.select("id"), "id", "left_anti")
    facts = judged.select("ordinal", "qualification_status").join(resolved.select("ordinal", "duplicate_of"), "ordinal", "left")
    return fresh, expansion_rates(facts)


def replay(records: DataFrame, old: QualifyRules, new: QualifyRules) -> DataFrame:
    """How many stored records move under newer rules; ``rule_change_members`` names them."""
    return rule_changes(records, old, new)


def enrichment(records: DataFrame, pages: DataFrame, needs: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Rows of ``records`` (with is_baseline) verified, described and flagged; the baseline stays as it is."""
    base, rest = records.where("is_baseline"), records.where("not is_baseline")
    seen = choose_logo(verify_website(with_pages(rest, parsed_pages(pages))))
    flagged = seen.withColumn("quality_flag", description_flag(F.col("description")))
    asked = flagged.withColumn("needs_description", F.col("description").isNull() | F.col("id").isin(*needs) if needs else F.col("description").isNull())
    review = asked.where(F.col("quality_flag") != "VALID").select("id", "name", F.col("github_repo_url").alias("github_url"), "quality_flag", "description")
    return {
        "records": tagged_union(base.drop("is_baseline"), asked.drop("is_baseline")), "review": review, "collisions": host_collisions(records), "collision_members": collision_members(records),
        "website": asked.groupBy("verification_status").count(), "logo": asked.groupBy("logo_verified").count(), "quality": asked.groupBy("quality_flag").count(),
    }


def publication_check(written: DataFrame, read: DataFrame, key: str, first: int = 3) -> DataFrame:
    """The first cells in which what was published differs from what was to be."""
    return read_back_differences(written, read, key).orderBy("key", "column").limit(first)
