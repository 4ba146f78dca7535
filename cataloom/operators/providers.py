"""Providers of descriptions, asked one after the other.

A provider is a name and a function from packages (a key and ``evidence``) to answers (the key,
``ANSWER`` columns).  Real ones are ``mapInPandas`` functions around a client and live outside the
engine; ``scripted`` answers by rule, in seven modes, so that chains run without any.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import has
from .enrich import judged_responses

ANSWER = ("status", "description", "grounded", "confidence", "cited_urls", "cited_types", "regenerated", "error_message")
#: Modes of a scripted provider, with the status and the error that they answer.
MODES = {
    "SUCCESS": ("SUCCESS", None),
    "SIMULATED_429": ("RATE_LIMITED", "HTTP 429 Too Many Requests"),
    "SIMULATED_TIMEOUT": ("TIMEOUT", "Connection timeout after 10.0s"),
    "SIMULATED_AUTH_ERROR": ("AUTH_ERROR", "HTTP 401 Unauthorized"),
    "SIMULATED_MALFORMED": ("MALFORMED", "Invalid JSON response from LLM"),
    "SIMULATED_UNGROUNDED": ("UNGROUNDED", "Model returned ungrounded/hallucinated claims"),
    "SIMULATED_UNSUPPORTED_URL": ("SUCCESS", None),
}
#: What the modes say of a tool, after its name.
SAYS = {
    "SUCCESS": " is a tool that assists developers with autonomous workflow automation.",
    "SIMULATED_UNGROUNDED": " costs $99 per month and has 1 million active users.",
    "SIMULATED_UNSUPPORTED_URL": " is an open-source tool built for developers.",
}
NO_URL = "https://github.com/example/repo"
FOREIGN_URL = "https://hallucinated-fake-url.com/docs"


@dataclass(frozen=True)
class Provider:
    """``available``: whether it has its key; a provider that answers AUTH_ERROR is asked no more."""

    name: str
    answer: Callable[[DataFrame], DataFrame]
    available: bool = True


def scripted(name: str, mode: str = "SUCCESS", description: str | None = None, url: str | None = None, key: str = "id") -> Provider:
    """A provider that answers every package by rule; ``description`` and ``url`` replace what it says and cites."""
    status, error = MODES[mode]
    none = F.lit(None).cast("string")
    empty = F.array().cast("array<string>")

    def answer(packages: DataFrame) -> DataFrame:
        says = none
        if mode in SAYS:
            own = description if description is not None and mode != "SIMULATED_UNSUPPORTED_URL" else None
            says = F.lit(own) if own is not None else F.concat(F.col("evidence.tool_name"), F.lit(SAYS[mode]))
        first = F.coalesce(F.get("evidence.source_urls", F.lit(0)), F.lit(NO_URL))
        blank = F.lit(mode == "SUCCESS") & ~has(F.trim(says))
        cites = {"SUCCESS": F.array(first), "SIMULATED_UNSUPPORTED_URL": F.array(F.lit(url or FOREIGN_URL))}.get(mode, empty)
        kind = {"SUCCESS": "GITHUB_REPOSITORY", "SIMULATED_UNSUPPORTED_URL": "WEBSITE_PAGE"}.get(mode)
        fine = F.lit(mode in ("SUCCESS", "SIMULATED_UNSUPPORTED_URL")) & ~blank
        return packages.select(
            key, F.when(blank, "MALFORMED").otherwise(status).alias("status"), F.when(~blank, says).alias("description"), fine.alias("grounded"),
            F.when(fine, "high").otherwise("low").alias("confidence"), F.when(blank, empty).otherwise(cites).alias("cited_urls"),
            F.when(blank | F.lit(kind is None), empty).otherwise(F.array(F.lit(kind))).alias("cited_types"), none.alias("regenerated"),
            F.when(blank, "Empty description returned by LLM").otherwise(F.lit(error)).alias("error_message"),
        )

    return Provider(name, answer)


def ask(packages: DataFrame, providers: list[Provider], key: str = "id") -> DataFrame:
    """The judged answers (see ``judged_responses``) of a chain: each provider is asked for the records that
    no provider before it gave a usable answer for.  Without providers there are no answers."""
    asked, pending = None, packages
    for rank, p in enumerate(p for p in providers if p.available):
        answers = p.answer(pending).withColumns({"provider": F.lit(p.name), "provider_rank": F.lit(rank)})
        judged = judged_responses(answers, pending, key)
        asked = judged if asked is None else asked.unionByName(judged)
        pending = pending.join(judged.where("usable").select(key), key, "left_anti")
    return asked if asked is not None else ask(packages.limit(0), [scripted("none", key=key)], key)
