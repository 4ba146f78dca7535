"""Addresses in canonical form, natively: no Python runs for them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import TRACKING_PARAMETERS
from .rules import filled, let, words


def _decoded(c: Column) -> Column:
    """Form decoding; a percent sign without two hex digits stands for itself."""
    return F.url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encoded(c: Column) -> Column:
    """Form encoding with the unreserved characters of RFC 3986 (Java keeps * and escapes ~)."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _query(raw: Column, tracking: Iterable[str]) -> Column:
    """Parameters with a value and no tracking, equal names together at the place of the first."""
    pairs = F.transform(
        F.filter(F.split(raw, "&"), lambda x: x.rlike("(?s)^[^=]*=.")),
        lambda x: F.struct(
            _decoded(F.substring_index(x, "=", 1)).alias("name"), _decoded(F.regexp_replace(x, "(?s)^[^=]*=", "")).alias("value")
        ),
    )
    kept = F.filter(pairs, lambda p: ~F.array_contains(words(tracking), F.lower(p["name"])))

    def grouped(found: Column) -> Column:
        names = F.array_distinct(F.transform(found, lambda p: p["name"]))
        return F.flatten(F.transform(names, lambda n: F.filter(found, lambda p: p["name"] == n)))

    return F.array_join(F.transform(let(kept, grouped), lambda p: F.concat(_encoded(p["name"]), F.lit("="), _encoded(p["value"]))), "&")


def _stripped(url: Column) -> Column:
    return F.regexp_replace(url, r"(?U)^\s+|\s+$", "")


def normalize_url(url: Column, tracking: Iterable[str] = TRACKING_PARAMETERS) -> Column:
    """The canonical form of an address; "" for null and blank, ``internal://`` ones as they are.

    https is assumed; scheme and host in lower case; default port, one leading www., slashes at the
    end of the path, tracking parameters, parameters without value and the fragment go.
    """

    def prefixed(mark: str, c: Column) -> Column:
        return let(c, lambda x: F.when(x != "", F.concat(F.lit(mark), x)).otherwise(F.lit("")))

    def built(full: Column) -> Column:
        scheme = F.lower(F.regexp_extract(full, "^([A-Za-z]+):", 1))
        host = F.lower(F.regexp_extract(full, "(?s)^[A-Za-z]+://([^/?#]*)", 1))
        port = F.when(full.rlike("(?i)^http:"), F.lit(":80$")).otherwise(F.lit(":443$"))
        host = F.regexp_replace(F.regexp_replace(host, port, F.lit("")), r"^www\.", "")
        whole = F.regexp_extract(full, "(?s)^[A-Za-z]+://[^/?#]*([^?#]*)", 1)
        path = F.regexp_replace(F.regexp_replace(whole, "(?s);[^/]*$", ""), "/+$", "")
        query = _query(F.regexp_extract(full, r"(?s)^[^?#]*\?([^#]*)", 1), tracking)
        return F.concat(scheme, F.lit("://"), host, path, prefixed(";", F.regexp_extract(whole, "(?s);([^/]*)$", 1)), prefixed("?", query))

    def made(bare: Column) -> Column:
        full = F.when(bare.rlike("(?i)^https?://"), bare).otherwise(F.concat(F.lit("https://"), bare))
        return (
            F.when(bare == "", F.lit("")).when(bare.rlike("(?i)^internal://"), bare)
            .otherwise(let(F.regexp_replace(full, r"[\t\r\n]", ""), built))
        )

    return let(_stripped(F.coalesce(url, F.lit(""))), made)


def host_of(normalized: Column) -> Column:
    """The host of an address in canonical form, with port and user if any; null where there is none."""
    return let(F.regexp_extract(normalized, "(?s)^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), filled)


def extract_domain(url: Column) -> Column:
    return host_of(normalize_url(url))


def audit_domain(url: Column) -> Column:
    """The audit's own idea of a host: authority or else path, up to a colon, lower-cased, without www."""
    host = F.regexp_extract(url, "(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?!//)([^?#;]*)", 1)
    whole = F.coalesce(let(host, filled), path)
    return F.coalesce(F.regexp_replace(F.lower(F.substring_index(whole, ":", 1)), r"^www\.", ""), F.lit(""))
