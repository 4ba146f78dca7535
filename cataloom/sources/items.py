"""Items of a recorded search as a data source: filters reach the pages, rows come as Arrow batches, and
new pages are a stream.

``record_items`` writes pages in folders ``query=<label>/page=<number>`` and, beside them, a table with the
range of stars of each page.  A filter on stars or on the query closes pages that can't match; all
filters that the source takes are applied to the batches, so Spark filters nothing above the scan.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan,
    LessThanOrEqual, StringContains,
)

from .scan import record

STARS, TOPICS = "stargazers_count", "topic_list"
#: ``topic_list`` has a blank before and after each topic, so that a test for one is a test for a substring.
ITEMS = f"query string, page int, place int, id long, name string, html_url string, {STARS} long, {TOPICS} string"
_SCHEMA = pa.schema([("query", pa.string()), ("page", pa.int32()), ("place", pa.int32()), ("id", pa.int64()), ("name", pa.string()), ("html_url", pa.string()), (STARS, pa.int64()), (TOPICS, pa.string())])
_ITEM = pa.struct([("id", pa.int64()), ("name", pa.string()), ("html_url", pa.string()), (STARS, pa.int64()), ("topics", pa.list_(pa.string()))])
_COMPARE = {GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal, EqualTo: pc.equal}


def _test(f: Filter) -> Callable[[pa.Table], pa.Array] | None:
    """A filter over a table of items, or None for one that Spark has to apply."""
    name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if name not in _SCHEMA.names:
        return None
    kind = _SCHEMA.field(name).type
    if isinstance(f, IsNotNull):
        return lambda t: pc.is_valid(t.column(name))
    if isinstance(f, In):
        return lambda t: pc.is_in(t.column(name), pa.array([v for v in f.value if v is not None], kind))
    if isinstance(f, StringContains):
        return lambda t: pc.match_substring(t.column(name), f.value)
    compare = _COMPARE.get(type(f))
    return None if compare is None else lambda t: compare(t.column(name), pa.scalar(f.value, kind))


def _may_hold(f: Filter, query: str, low: int | None, high: int | None) -> bool:
    """Whether a page can have a row that passes."""
    if f.attribute == ("query",):
        return query == f.value if isinstance(f, EqualTo) else query in f.value if isinstance(f, In) else True
    if f.attribute != (STARS,):
        return True
    if low is None or high is None:
        return False  # no stars on the page, and no filter lets a null through
    if isinstance(f, In):
        return any(v is not None and low <= v <= high for v in f.value)
    tests = {GreaterThan: lambda v: high > v, GreaterThanOrEqual: lambda v: high >= v, LessThan: lambda v: low < v, LessThanOrEqual: lambda v: low <= v, EqualTo: lambda v: low <= v <= high}
    return tests[type(f)](f.value) if type(f) in tests else True


@dataclass
class Pages(InputPartition):
    query: str
    pages: tuple[int, ...]

    def __post_init__(self) -> None:
        super().__init__((self.query, self.pages))


class _Reading:
    """What reads pages, for tables and for streams.  Options: path, stars (``most first``: a slice in one order)."""

    def __init__(self, options: dict):
        self.path, self.in_order, self.tests = options["path"].rstrip("/"), options.get("order", "") == "stars", []

    def _system(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if ":" in self.path else (fs.LocalFileSystem(), self.path)

    def _page(self, query: str, page: int) -> pa.Table:
        from pyarrow import fs
        from pyarrow import json as lines

        system, root = self._system()
        found = [f.path for f in system.get_file_info(fs.FileSelector(f"{root}/pages/query={query}/page={page}", allow_not_found=True)) if f.path.endswith(".json") and f.size]
        tables = []
        for path in found:
            with system.open_input_stream(path) as f:
                raw = lines.read_json(f, parse_options=lines.ParseOptions(explicit_schema=pa.schema([("items", pa.list_(_ITEM))]), unexpected_field_behavior="ignore"))
            items = pa.concat_arrays(raw.column("items").chunks).flatten() if raw.num_rows else pa.array([], _ITEM)
            topics = pc.if_else(pc.is_valid(items.field("topics")), pc.binary_join(pc.fill_null(items.field("topics"), []), " "), None)
            n = len(items)
            columns = [pa.array([query] * n, pa.string()), pa.array([page] * n, pa.int32()), pa.array(range(n), pa.int32()), *(items.field(c) for c in ("id", "name", "html_url", STARS)), pc.binary_join_element_wise("", topics, "", " ")]
            tables.append(pa.Table.from_arrays(columns, schema=_SCHEMA))
        return pa.concat_tables(tables) if tables else _SCHEMA.empty_table()

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        tables = (self._page(partition.query, p) for p in partition.pages)
        if self.in_order:
            # a slice of a search has a thousand results at most, so its pages are merged in memory
            whole = pa.concat_tables([_SCHEMA.empty_table(), *tables])
            at = pc.sort_indices(whole, sort_keys=[(STARS, "descending"), ("page", "ascending"), ("place", "ascending")])
            whole = whole.take(at)
            tables = iter([whole.set_column(2, "place", pa.array(range(whole.num_rows), pa.int32()))])
        for t in tables:
            for test in self.tests:
                t = t.filter(pc.fill_null(test(t), False))
            yield from t.to_batches()


class ItemReader(_Reading, DataSourceReader):
    """A partition for each page that may have rows; with ``order`` for each query."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.known, self.filters = [tuple(k) for k in json.loads(options.get("pages", "[]"))], []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            # the place in a slice's order counts all of its rows, so filters may follow it but close no page
            if _test(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list[Pages]:
        cut = [f for f in self.filters if not self.in_order or f.attribute == ("query",)]
        kept = sorted((q, p) for q, p, low, high in self.known if all(_may_hold(f, q, low, high) for f in cut))
        if self.in_order:
            return [Pages(q, tuple(p for k, p in kept if k == q)) for q in sorted({q for q, _ in kept})] or [Pages("", ())]
        return [Pages(q, (p,)) for q, p in kept] or [Pages("", ())]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        self.tests = [_test(f) for f in self.filters]
        return super().read(partition)


class ItemStream(_Reading, DataSourceStreamReader):
    """Offsets are {query: last page}: of each query the pages that follow one another from the first on."""

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        from pyarrow import fs

        system, root = self._system()
        there: dict[str, set[int]] = {}
        for info in system.get_file_info(fs.FileSelector(f"{root}/pages", recursive=True, allow_not_found=True)):
            found = re.search(r"/query=([^/]*)/page=(\d+)/[^/_.][^/]*\.json$", info.path)
            if found:
                there.setdefault(found[1], set()).add(int(found[2]))
        out = {}
        for query, pages in there.items():
            last = 0
            while last + 1 in pages:
                last += 1
            if last:
                out[query] = last
        return out

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        return [Pages(q, (p,)) for q in sorted(end) for p in range(start.get(q, 0) + 1, end[q] + 1)] or [Pages("", ())]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return super().read(partition)

    def commit(self, end: dict) -> None:
        """Nothing to free: pages stay where they were recorded, and the checkpoint holds the offset."""


class RecordedItems(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recorded_items"

    def schema(self) -> str:
        return ITEMS

    def reader(self, schema) -> ItemReader:
        return ItemReader(self.options)

    def streamReader(self, schema) -> ItemStream:
        return ItemStream(self.options)


def record_items(pages: DataFrame, path: str) -> None:
    """Writes pages (query, page, status, items), and what each page's stars range over; labels are plain words."""
    record(pages, f"{path}/pages")
    stars = F.transform("items", lambda i: i[STARS])
    ranges = pages.groupBy("query", "page").agg(F.min(F.array_min(stars)).alias("low"), F.max(F.array_max(stars)).alias("high"))
    ranges.write.mode("overwrite").parquet(f"{path}/ranges")


def items(spark: SparkSession, path: str, in_order: bool = False) -> DataFrame:
    """The items of all recorded pages.  ``in_order``: ``place`` is that in its query, most stars first, ties by
    page and place on it; null stars come last.

    A row a page is told to the source (slices are few, and have some tens of pages each).  The session's
    ``spark.sql.python.filterPushdown.enabled`` is set, without which Spark refuses such a source.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RecordedItems)
    known = [list(r) for r in spark.read.parquet(f"{path}/ranges").select("query", "page", "low", "high").collect()]
    return spark.read.format("recorded_items").options(path=path, pages=json.dumps(known), order="stars" if in_order else "").load()


def stream_items(spark: SparkSession, path: str) -> DataFrame:
    """New pages as a stream; a restart goes on after the last page of each query that was finished."""
    spark.dataSource.register(RecordedItems)
    return spark.readStream.format("recorded_items").options(path=path).load()


def slice_filter(query: str) -> Column:
    """A slice ``topic:<topic> stars:<range>`` as filters that the source takes."""
    fits = F.lit(True)
    topic = re.search(r"topic:(\S+)", query)
    if topic:
        fits = fits & F.contains(F.col(TOPICS), F.lit(f" {topic[1]} "))
    held = re.search(r"stars:(?:(\d+)\.\.(\d+)|(>=?|<=?)(\d+)|(\d+))", query)
    if held:
        low, high, sign, bound, exact = held.groups()
        own = [("GE", low), ("LE", high)] if low else [({">": "GT", ">=": "GE", "<": "LT", "<=": "LE"}[sign], bound)] if sign else [("EQ", exact)]
        stars = F.col(STARS)
        for kind, value in own:
            v = F.lit(int(value))
            fits = fits & {"GE": stars >= v, "LE": stars <= v, "GT": stars > v, "LT": stars < v, "EQ": stars == v}[kind]
    return fits
