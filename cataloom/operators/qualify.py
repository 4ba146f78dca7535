"""Qualification: is a repository a tool?"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lex
from ..functions.rules import any_part, first_match, has, listed, words, yes
from ..functions.text import link_count, link_density
from .report import counted_with_values


@dataclass(frozen=True)
class QualifyRules:
    hard_names: tuple[str, ...] = lex.HARD_NAME_PATTERNS
    hard_descriptions: tuple[str, ...] = lex.HARD_DESCRIPTION_PATTERNS
    hard_topics: tuple[str, ...] = lex.HARD_TOPICS
    soft_names: tuple[str, ...] = lex.SOFT_NAME_PATTERNS
    soft_topics: tuple[str, ...] = lex.SOFT_TOPICS
    positive_topics: tuple[str, ...] = lex.POSITIVE_TOPICS
    boundary_words: tuple[str, ...] = lex.BOUNDARY_WORDS
    most_links: int = 30
    most_density: float = 2.0


def qualify(records: DataFrame, rules: QualifyRules = QualifyRules()) -> DataFrame:
    """``records`` with qualification_status, qualification_reasons and qualification_signals.

    Reads name, description, github_topics, is_fork, is_archived, readme_content.  Hard signs
    reject, unless a boundary word meets a positive topic; two soft signs, an archive, a boundary or a
    missing description without positive topic ask for a review; one soft sign alone passes.
    """
    name = F.trim(F.coalesce("name", F.lit("")))
    topics = F.array_distinct(F.transform(F.coalesce("github_topics", F.array().cast("array<string>")), lambda t: F.lower(t)))
    described, fork, archived = has(F.col("description")), yes(F.col("is_fork")), yes(F.col("is_archived"))

    def met(own):
        return F.array_sort(F.array_intersect(topics, words(own)))

    staged = records.withColumns({
        "_hard": met(rules.hard_topics), "_soft": met(rules.soft_topics), "_positive": met(rules.positive_topics),
        "_hard_name": first_match(name, rules.hard_names), "_soft_name": first_match(name, rules.soft_names),
        "_hard_text": F.when(described, first_match(F.trim("description"), rules.hard_descriptions)),
        "_links": link_count(F.coalesce("readme_content", F.lit(""))), "_density": link_density(F.coalesce("readme_content", F.lit(""))),
    })

    def some(c):
        return F.size(c) > 0

    def said(text, value, when=None):
        made = F.concat(F.lit(text), value)
        return made if when is None else F.when(when, made)

    hard = listed(
        said("Hard negative name pattern: ", F.col("_hard_name")),
        F.when(F.col("_hard_text").isNotNull(), F.concat(F.lit("Hard negative description pattern: '"), "_hard_text", F.lit("'"))),
        said("Hard negative topics: ", F.array_join("_hard", ", "), some("_hard")),
        F.when(
            (F.col("_links") > rules.most_links) & (F.col("_density") > rules.most_density),
            F.concat(F.lit("README appears to be a link collection (link_count="), F.col("_links").cast("string"), F.lit(")")),
        ),
    )
    soft = listed(
        F.when(~described, F.lit("Missing repository description")),
        said("Soft negative topics: ", F.array_join("_soft", ", "), some("_soft")),
        said("Soft negative name pattern: ", F.col("_soft_name")),
        F.when(fork, F.lit("Repository is a fork")),
        F.when(archived, F.lit("Repository is archived")),
    )
    positive = listed(said("Positive topics: ", F.array_join("_positive", ", "), some("_positive")))
    staged = staged.withColumns({"_hard_reasons": hard, "_soft_reasons": soft, "_positive_reasons": positive})
    boundary = any_part(F.lower(name), rules.boundary_words) & some("_positive")
    rejected = some("_hard_reasons")
    review = some("_soft_reasons") & (
        (F.size("_soft_reasons") >= 2) | archived | boundary | (~described & ~some("_positive"))
    )
    status = (
        F.when(rejected & boundary, "REVIEW_REQUIRED").when(rejected, "REJECTED_NON_TOOL").when(review, "REVIEW_REQUIRED").otherwise("QUALIFIED_TOOL")
    )
    reasons = (
        F.when(rejected & boundary, F.concat("_hard_reasons", "_positive_reasons")).when(rejected, F.col("_hard_reasons"))
        .when(review, F.concat("_soft_reasons", "_positive_reasons")).when(some("_positive"), F.col("_positive_reasons"))
        .otherwise(F.array(F.lit("No disqualifying signals found")))
    )
    signals = F.struct(
        name.alias("name"), fork.alias("is_fork"), archived.alias("is_archived"),
        F.coalesce(F.size("github_topics"), F.lit(0)).alias("topics_count"),
        F.array_union("_hard", "_soft").alias("negative_topics"), F.col("_positive").alias("positive_topics"),
        F.col("_hard").alias("hard_topics"), F.col("_soft").alias("soft_topics"),
        F.size("_hard_reasons").alias("hard_signal_count"), F.size("_soft_reasons").alias("soft_signal_count"),
        (F.size("_hard_reasons") + F.size("_soft_reasons")).alias("negative_signal_count"),
        F.size("_positive_reasons").alias("positive_signal_count"),
    )
    out = staged.withColumns({"qualification_status": status, "qualification_reasons": reasons, "qualification_signals": signals})
    return out.drop("_hard", "_soft", "_positive", "_hard_name", "_soft_name", "_hard_text", "_links", "_density", "_hard_reasons", "_soft_reasons", "_positive_reasons")


def _both_rules(records: DataFrame, old: QualifyRules, new: QualifyRules) -> DataFrame:
    """Both rules in one scan."""
    both = qualify(qualify(records, old).withColumnRenamed("qualification_status", "old_status"), new)
    return both.withColumnRenamed("qualification_status", "new_status")


def rule_changes(records: DataFrame, old: QualifyRules, new: QualifyRules, id_col: str | None = None) -> DataFrame:
    """(old_status, new_status, n): how many records move when the rules change; with ``id_col``, of whole numbers,
    also ``ids``, all of a change in order and comma-joined, put together by ranges of 4096 numbers."""
    if id_col is None:
        return _both_rules(records, old, new).groupBy("old_status", "new_status").agg(F.count("*").alias("n"))
    return counted_with_values(rule_change_members(records, old, new, id_col), ["old_status", "new_status"], "id", F.shiftright("id", 12))


def rule_change_members(records: DataFrame, old: QualifyRules, new: QualifyRules, id_col: str = "id") -> DataFrame:
    """(id, old_status, new_status): a row for each record."""
    return _both_rules(records, old, new).select(F.col(id_col).alias("id"), "old_status", "new_status")
