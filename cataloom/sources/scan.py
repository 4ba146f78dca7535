"""Scans of a paged repository search as a Spark data source, with slices, resumption and limits.

``recorded_search`` reads pages that ``record`` wrote, in folders ``query=<label>/page=<number>``.  Each
(slice, page) is a partition of its own, so a scan is as parallel as it has pages, and pages that
earlier runs finished are no partitions at all.
"""

from __future__ import annotations

import json
import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import Row

from .search import PAGE

#: A topic and the ranges of stars that its slices of the search have, with their labels.
SLICES = (
    ("ai-tools", "100..500", "ai-tools-mid"),
    ("ai-tools", "501..2500", "ai-tools-high"),
    ("ai-tools", ">2500", "ai-tools-top"),
    ("ai-developer-tools", "100..500", "ai-dev-tools-mid"),
    ("ai-developer-tools", ">500", "ai-dev-tools-high"),
    ("llm-tools", "100..500", "llm-tools-mid"),
    ("llm-tools", ">500", "llm-tools-high"),
    ("ai-agent", "100..500", "ai-agent-mid"),
    ("ai-agent", ">500", "ai-agent-high"),
    ("ai-agents", "100..500", "ai-agents-mid"),
    ("ai-agents", ">500", "ai-agents-high"),
    ("mcp", ">100", "mcp-general"),
    ("mcp-server", ">100", "mcp-server"),
    ("rag", "100..500", "rag-mid"),
    ("rag", ">500", "rag-high"),
    ("vector-database", ">100", "vector-database"),
    ("llm-inference", ">100", "llm-inference"),
    ("generative-ai", "100..500", "generative-ai-mid"),
    ("generative-ai", ">500", "generative-ai-high"),
    ("ai-automation", ">100", "ai-automation"),
    ("ai-productivity", ">100", "ai-productivity"),
    ("code-assistant", ">100", "code-assistant"),
    ("prompt-engineering", ">100", "prompt-engineering"),
    ("autonomous-agents", ">100", "autonomous-agents"),
    ("multi-agent", ">100", "multi-agent"),
)
#: The fields of an item, in the order of ``search.ITEM``.
ITEM_COLUMNS = ("id", "name", "html_url", "homepage", "owner", "topics", "description", "stargazers_count", "fork", "archived", "language", "updated_at")
#: What a scan does without settings of its own.
DEFAULTS = {"per_page": 30, "max_pages": 5, "queries": [{"query": "topic:ai-tools stars:>100", "label": "ai-tools"}]}


def all_slices() -> list[dict]:
    return [{"query": f"topic:{topic} stars:{stars}", "label": label} for topic, stars, label in SLICES]


def scan_settings(text: str | None, source: str = "github") -> dict:
    """per_page, max_pages and queries of a source, from a JSON or YAML text; what is missing has its default,
    and so has a text that cannot be read, with a warning."""
    found: dict = {}
    if text:
        try:
            found = json.loads(text)
        except ValueError:
            try:
                import yaml

                found = yaml.safe_load(text)
            except Exception as e:  # no such module, or no such text
                warnings.warn(f"settings of {source} cannot be read, the defaults hold: {e}", stacklevel=2)
                found = {}
    sources = found.get("sources") if isinstance(found, dict) else None
    own = (sources or {}).get(source) if isinstance(sources, dict) else None
    return DEFAULTS | {k: own[k] for k in DEFAULTS if isinstance(own, dict) and own.get(k) is not None}


def in_slice(query: str, topics: Column, stars: Column) -> Column:
    """Whether an item belongs to a slice ``topic:<topic> stars:<range>``; either part may be missing."""
    fits = F.lit(True)
    topic = re.search(r"topic:(\S+)", query)
    if topic:
        fits = fits & F.coalesce(F.array_contains(topics, topic[1]), F.lit(False))
    held = re.search(r"stars:(?:(\d+)\.\.(\d+)|(>=?|<=?)(\d+)|(\d+))", query)
    if held:
        low, high, sign, bound, exact = held.groups()
        if low:
            own = stars.between(int(low), int(high))
        elif exact:
            own = stars == int(exact)
        else:
            own = {">": stars > int(bound), ">=": stars >= int(bound), "<": stars < int(bound), "<=": stars <= int(bound)}[sign]
        fits = fits & F.coalesce(own, F.lit(False))
    return fits


@dataclass
class Page(InputPartition):
    label: str
    page: int

    def __post_init__(self) -> None:
        super().__init__((self.label, self.page))


class RecordedPages(DataSourceReader):
    """Options: path, settings (see ``scan_settings``), sort (``stars``: most stars first in a page),
    done (JSON list of [label, page stored, completed]: pages that need not be read)."""

    def __init__(self, options: dict):
        self.path, self.sort = options["path"].rstrip("/"), options.get("sort", "")
        self.settings = scan_settings(options.get("settings"))
        self.done = {label: (page, completed) for label, page, completed in json.loads(options.get("done", "[]"))}

    def partitions(self) -> list[Page]:
        pages = []
        for q in self.settings["queries"]:
            label = q.get("label", q["query"])
            stored, completed = self.done.get(label, (0, False))
            # the page last stored is read again: its rows may not all have arrived, and repeats fall to dedup
            first = self.settings["max_pages"] + 1 if completed else max(1, stored)
            pages += [Page(label, p) for p in range(first, self.settings["max_pages"] + 1)]
        return pages or [Page("", 0)]

    def read(self, partition: Page) -> Iterator[Row]:
        from pyarrow import fs

        if not partition.page:
            return
        system, root = fs.FileSystem.from_uri(self.path) if ":" in self.path else (fs.LocalFileSystem(), self.path)
        folder = fs.FileSelector(f"{root}/query={partition.label}/page={partition.page}", allow_not_found=True)
        for info in system.get_file_info(folder):
            if info.type == fs.FileType.File and info.path.endswith(".json"):
                with system.open_input_stream(info.path) as f:
                    for line in f.read().splitlines():
                        yield self._row(partition, json.loads(line))

    def _row(self, partition: Page, found: dict) -> tuple:
        items = found.get("items")
        if items and self.sort == "stars":
            items = sorted(items, key=lambda i: -(i.get("stargazers_count") or 0))

        def value(item: dict, column: str):
            held = item.get(column)
            return (held.get("login"), held.get("html_url")) if column == "owner" and held else held

        rows = None if items is None else [tuple(value(i, c) for c in ITEM_COLUMNS) for i in items]
        return partition.label, partition.page, found.get("status", 200), rows


class RecordedSearch(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recorded_search"

    def schema(self) -> str:
        return PAGE

    def reader(self, schema) -> RecordedPages:
        return RecordedPages(self.options)


def record(pages: DataFrame, path: str) -> None:
    """Writes pages (query, page, status, items) for later scans."""
    pages.write.mode("overwrite").partitionBy("query", "page").json(path)


def scan(spark: SparkSession, path: str, settings: str | None = None, done: DataFrame | None = None, source: str = "", sort: str = "stars") -> DataFrame:
    """(query, page, status, items) of the pages that are still to be read; ``done`` is a table of ``progress``."""
    spark.dataSource.register(RecordedSearch)
    options = {"path": path, "sort": sort} | ({"settings": settings} if settings else {})
    if done is not None:  # one row a slice
        held = latest(done).where(F.col("source") == source).select("query", "page", "completed").collect()
        options["done"] = json.dumps([list(r) for r in held])
    return spark.read.format("recorded_search").options(**options).load()


def progress(pages: DataFrame, source: str, per_page: int, max_pages: int) -> DataFrame:
    """(source, query, page, items, completed) of each answered page; its query is completed with the
    last page, or a short one."""
    n = F.coalesce(F.size("items"), F.lit(0))
    return pages.where("status = 200").select(
        F.lit(source).alias("source"), "query", "page", n.alias("items"), ((F.col("page") >= max_pages) | (n < per_page)).alias("completed")
    )


def latest(progress: DataFrame) -> DataFrame:
    """(source, query, page, completed): how far each query has come, over all runs."""
    return progress.groupBy("source", "query").agg(F.max("page").alias("page"), F.bool_or("completed").alias("completed"))


def append_progress(rows: DataFrame, path: str) -> None:
    """Adds to the progress table at ``path`` (Parquet); ``sinks.clear`` starts anew."""
    rows.write.mode("append").parquet(path)


def to_read(wanted: DataFrame, done: DataFrame, source: str) -> DataFrame:
    """The (query, page) rows of ``wanted`` that need reading: of queries that are not completed, from the
    page last stored on."""
    held = latest(done).where(F.col("source") == source).select("query", F.col("page").alias("stored"), "completed")
    return wanted.join(held, "query", "left").where(~F.coalesce("completed", F.lit(False)) & (F.col("page") >= F.coalesce("stored", F.lit(0)))).select("query", "page")
