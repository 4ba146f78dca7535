"""Evidence in web pages."""

from __future__ import annotations

from collections.abc import Collection
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import PLATFORM_ASSETS
from .rules import any_part
from .text import finished_references

HEAD_SCHEMA = "title string, meta_description string, logo_url string, logo_source string"


def title_native(html: Column) -> Column:
    """The text of the first title element as it is written, trimmed."""
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


class _Head(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title: list[str] | None = None
        self.in_title = False
        self.metas: list[dict] = []
        self.links: list[dict] = []

    def handle_starttag(self, tag, attrs):
        if tag == "title" and self.title is None:
            self.title, self.in_title = [], True
        elif tag == "meta":
            self.metas.append(dict(attrs))
        elif tag == "link":
            self.links.append(dict(attrs))

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)


def head(html: str, url: str, references: Collection[str] | None = None) -> tuple[str, str, str | None, str | None]:
    """(title, meta description, logo address, kind of logo) of one page; ``references`` as in ``finished_references``."""
    parser = _Head()
    parser.feed(finished_references(html or "", references))
    parser.close()

    def meta(*wanted: tuple[str, str]) -> dict | None:
        return next((m for k, v in wanted for m in parser.metas if m.get(k) == v), None)

    described = meta(("name", "description"), ("property", "og:description")) or {}
    picture = meta(("property", "og:image"), ("name", "og:image")) or {}
    choices = [(picture.get("content"), "og:image")]
    for part, kind in (("apple-touch-icon", "apple-touch-icon"), ("icon", "favicon")):
        link = next((x for x in parser.links if part in (x.get("rel") or "").lower()), {})
        choices.append((link.get("href"), kind))
    choices.append(("/favicon.ico", "favicon_fallback"))
    found, kind = next((a, k) for a, k in choices if a)
    return "".join(parser.title or []).strip(), (described.get("content") or "").strip(), urljoin(url or "", found.strip()), kind


def head_of(html: Column, url: Column, references: Collection[str] | None = None) -> Column:
    """Title, meta description and logo of pages, one parse for all; on Arrow batches."""

    @F.pandas_udf(HEAD_SCHEMA)
    def run(pages: pd.Series, urls: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([head(p, u, references) for p, u in zip(pages, urls)], columns=["title", "meta_description", "logo_url", "logo_source"])

    return run(html, url)


def is_platform_asset(logo_url: Column) -> Column:
    return any_part(F.lower(logo_url), PLATFORM_ASSETS)
