"""Stable ids, signatures and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tool_id(domain: Column, name: Column) -> Column:
    """tool_ and 16 hex digits of the SHA-256 of domain:name, or of the name where the domain is blank."""
    d, n = (F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in (domain, name))
    key = F.when(d != "", F.concat(d, F.lit(":"), n)).otherwise(n)
    return F.concat(F.lit("tool_"), F.substring(F.sha2(key.cast("binary"), 256), 1, 16))


def record_signature(id_: Column, name: Column, official_url: Column, repo_url: Column, description: Column) -> Column:
    """SHA-256 of the five fields joined by |, nulls of the last three empty and of the first two None."""
    parts = [F.coalesce(c, F.lit("None")) for c in (id_, name)] + [F.coalesce(c, F.lit("")) for c in (official_url, repo_url, description)]
    return F.sha2(F.concat_ws("|", *parts).cast("binary"), 256)


def content_hash(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)
