"""Checks of generated descriptions: grounded in the evidence, and of use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import lexicon as lex
from ..functions.rules import any_match, filled, has, matches, yes
from ..functions.text import sentence_count


def evidence_text(*parts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *parts))


def grounding_reason(description: Column, grounded: Column, cited: Column, allowed: Column, evidence: Column) -> Column:
    """VALID_GROUNDED, or the first check that a description fails.

    ``cited`` and ``allowed`` are arrays of addresses, ``evidence`` is lower-cased text.
    """
    text = F.trim(description)
    low = F.lower(text)
    strange = F.filter(F.coalesce(cited, F.array().cast("array<string>")), lambda u: (F.coalesce(u, F.lit("")) != "") & ~yes(F.array_contains(allowed, u)))
    out = (
        F.when(~has(description), "EMPTY_DESCRIPTION").when(F.length(text) < 15, "DESCRIPTION_TOO_SHORT")
        .when(F.length(text) > 350, "DESCRIPTION_EXCEEDS_LENGTH_LIMIT").when(sentence_count(text) > 3, "DESCRIPTION_EXCEEDS_SENTENCE_LIMIT")
        .when(~yes(grounded), "MODEL_UNGROUNDED_FLAG")
        .when(F.size(strange) > 0, F.concat(F.lit("UNCITED_SOURCE_URL: "), F.get(strange, F.lit(0)), F.lit(" not in evidence package")))
    )
    for kind, patterns in (("PRICING", lex.PRICING_CLAIMS), ("METRIC", lex.METRIC_CLAIMS), ("COMPANY", lex.COMPANY_CLAIMS)):
        for p in patterns:
            out = out.when(matches(low, p) & ~yes(matches(evidence, p)), f"UNSUPPORTED_{kind}_CLAIM: Matched '{p}'")
    return out.otherwise("VALID_GROUNDED")


def description_flag(description: Column, tautologies=lex.TAUTOLOGIES, marketing=lex.MARKETING, generic=lex.GENERIC, shortest: int = 30) -> Column:
    """TAUTOLOGICAL, MARKETING_LANGUAGE, GENERIC, LOW_INFORMATION or VALID, the first that fits."""
    text = filled(F.trim(F.coalesce(description, F.lit(""))))
    return (
        F.when(text.isNull(), "LOW_INFORMATION").when(any_match(text, tautologies), "TAUTOLOGICAL")
        .when(any_match(text, marketing), "MARKETING_LANGUAGE").when(any_match(text, generic), "GENERIC")
        .when((F.length(text) < shortest) | F.lower(text).startswith(lex.SLOGAN), "LOW_INFORMATION").otherwise("VALID")
    )
