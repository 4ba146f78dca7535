"""Registered queries of sources, sinks, streams, providers and reports: what is written is read back."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators.providers import ask, scripted
from .operators.report import numbered, quality_rows
from .queries import query, table
from .sources.keyed import KeyedTable
from .sources import files, items, scan, search, sinks
from .streaming.ingest import ingest, running_counts, stored

AS_OF = "2026-01-02 00:00:00"


def scratch(spark: SparkSession, name: str) -> str:
    """A folder for one query, under the folder that the cluster shares, removed when the driver ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    path = f"{(shared or 'file://' + tempfile.gettempdir()).rstrip('/')}/cataloom-{name}-{uuid.uuid4().hex}"

    def clean() -> None:
        try:
            sinks.clear(spark, path)
        except Exception:  # the JVM may be gone already
            pass

    atexit.register(clean)
    return path


@query("jsonl_round_trip", "SELECT doc_id, lang, source, text FROM documents")
def _(spark, d):
    path, docs = scratch(spark, "jsonl"), table(spark, d, "documents").select("doc_id", "lang", "source", "text")
    sinks.write_jsonl(docs, path)
    return files.read_jsonl(spark, path, docs.schema)


@query("json_array_round_trip", "SELECT c_custkey AS key, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment FROM customer")
def _(spark, d):
    path = scratch(spark, "array")
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("segment"))
    n = sinks.write_json_array(rows, f"{path}/all.json")
    return files.read_json_array(spark, f"{path}/all.json", rows.schema, n)


@query("keyed_upsert", """
SELECT c_custkey AS key, CASE WHEN c_custkey % 5 = 0 THEN 'second' WHEN c_custkey % 2 = 0 THEN 'first' ELSE 'second' END AS load, c_name AS name FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 5 = 0 OR c_custkey % 3 = 0""")
def _(spark, d):
    """Two upserts; keys of both hold the second's row."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    kept = KeyedTable(spark, scratch(spark, "keyed"), "key", "key long, load string, name string", 16)
    kept.upsert(rows.where("key % 2 = 0").select("key", F.lit("first").alias("load"), "name"))
    kept.upsert(rows.where("key % 5 = 0 or (key % 2 <> 0 and key % 3 = 0)").select("key", F.lit("second").alias("load"), "name"))
    return kept.rows()


@query("csv_round_trip", "SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, c_mktsegment || '|\"x\", y' AS segment FROM customer")
def _(spark, d):
    path = scratch(spark, "csv")
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("name"), F.concat("c_mktsegment", F.lit('|"x", y')).alias("segment")
    )
    sinks.write_csv(rows, path)
    return files.read_csv(spark, path)


@query("raw_envelopes", "SELECT 'web' AS source_name, 20260102 AS ingest_date, TIMESTAMP '2026-01-02 00:00:00' AS discovered_at, s_suppkey AS key, s_name AS name FROM supplier".replace("TIMESTAMP '2026-01-02 00:00:00'", "'2026-01-02 00:00:00'"))
def _(spark, d):
    path = scratch(spark, "raw")
    sinks.append_raw(table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), path, "web", AS_OF)
    found = spark.read.schema("raw struct<key:long,name:string>, discovered_at string, source_name string, ingest_date int").json(path)
    return found.select("source_name", "ingest_date", "discovered_at", "raw.key", "raw.name")


@query("rejected_log", """
SELECT 'Gate' AS pipeline_stage, CASE WHEN o_totalprice > 200000 THEN 'DEAR' ELSE 'CHEAP' END AS reason, o_orderkey AS key FROM orders""")
def _(spark, d):
    path = scratch(spark, "rejected")
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("key"), F.when(F.col("o_totalprice") > 200000, "DEAR").otherwise("CHEAP").alias("why")
    )
    sinks.append_rejected(rows, path, "why", "Gate", AS_OF)
    found = spark.read.schema("record struct<key:long>, reason string, timestamp string, pipeline_stage string").json(path)
    return found.select("pipeline_stage", "reason", "record.key")


@query("stream_ingest", """
SELECT user_id, coalesce(min(event_id) FILTER (event_id % 2 = 0), min(event_id)) AS event_id FROM events GROUP BY 1""")
def _(spark, d):
    base, schema = scratch(spark, "ingest"), "event_id long, user_id long"
    events = table(spark, d, "events").select(F.col("event_id").cast("long"), F.col("user_id").cast("long"))
    for rest in (0, 1):  # the second load arrives after a restart
        events.where(F.col("event_id") % 2 == rest).write.mode("append").json(f"{base}/in")
        ingest(spark, f"{base}/in", schema, f"{base}/table", f"{base}/checkpoint", key="user_id", order="event_id")
    return stored(spark, f"{base}/table", schema).select("user_id", "event_id")


@query("stream_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    base, events = scratch(spark, "counts"), table(spark, d, "events").select("event_type")
    events.repartition(3).write.parquet(f"{base}/in")
    return running_counts(spark, f"{base}/in", "event_type string", "event_type", f"{base}/checkpoint", f"{base}/counts")


TOPIC = "CASE o_orderstatus WHEN 'F' THEN 'mcp' WHEN 'O' THEN 'rag' ELSE 'ai-tools' END"


def _slice_sql(topic: str, stars: str, label: str) -> str:
    low, _, high = stars.partition("..")
    held = f"stars BETWEEN {low} AND {high}" if high else f"stars {stars[0]} {stars[1:]}"
    return f"SELECT o_orderkey, '{label}' AS label FROM o WHERE topic = '{topic}' AND {held}"


@query("search_slices", f"WITH o AS (SELECT o_orderkey, {TOPIC} AS topic, o_orderkey % 3000 AS stars FROM orders) " + " UNION ALL ".join(_slice_sql(*s) for s in scan.SLICES))
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.array(F.expr(TOPIC)).alias("topics"), (F.col("o_orderkey") % 3000).alias("stars"))
    labels = [F.when(scan.in_slice(s["query"], F.col("topics"), F.col("stars")), s["label"]) for s in scan.all_slices()]
    return o.select("o_orderkey", F.explode(F.filter(F.array(*labels), lambda x: x.isNotNull())).alias("label"))


@query("recorded_scan", "SELECT 'n' || s_nationkey AS query, s_suppkey AS repo_id, s_name AS name FROM supplier WHERE s_nationkey <> 3")
def _(spark, d):
    path, size = scratch(spark, "search"), 20
    place = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")) - 1
    item = F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), (F.col("s_suppkey") % 7).alias("stargazers_count"))
    pages = table(spark, d, "supplier").withColumn("page", (F.floor(place / size) + 1).cast("int")).groupBy(
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("query"), "page"
    ).agg(F.collect_list(item).alias("items")).withColumn("status", F.lit(200))
    scan.record(pages, f"{path}/pages")
    most = pages.agg(F.max("page")).first()[0] or 1
    settings = scan.json.dumps({"sources": {"github": {"per_page": size, "max_pages": most, "queries": [{"query": f"nation {i}", "label": f"n{i}"} for i in range(25)]}}})
    done = pages.where("query in ('n3', 'n5')").select(F.lit("web").alias("source"), "query", F.lit(1).alias("page"), F.lit(size).alias("items"), (F.col("query") == "n3").alias("completed"))
    scan.append_progress(done, f"{path}/progress")
    read = scan.scan(spark, f"{path}/pages", settings, spark.read.parquet(f"{path}/progress"), "web")
    return search.candidates(read, size).select("query", "repo_id", "name")


RECORDED = """
WITH i AS (SELECT 'n' || s_nationkey AS query, s_suppkey AS id, s_suppkey * 37 % 5000 AS stars, s_suppkey % 3 = 0 AS mcp, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS idx FROM supplier)"""


def _recorded_items(spark: SparkSession, d: str, size: int = 20) -> DataFrame:
    """Pages of suppliers by nation, as a search would give them."""
    place = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")) - 1
    key = F.col("s_suppkey")
    item = F.struct(
        F.col("place").alias("_at"), key.alias("id"), F.col("s_name").alias("name"), F.lit("https://a.example").alias("html_url"), (key * 37 % 5000).cast("long").alias("stargazers_count"),
        F.when(key % 3 == 0, F.array(F.lit("mcp"), F.lit("rag"))).otherwise(F.array(F.lit("mcp-server"))).alias("topics"),
    )
    own = table(spark, d, "supplier").withColumn("place", place).withColumn("page", (F.floor(F.col("place") / size) + 1).cast("int"))
    pages = own.groupBy(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("query"), "page").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return pages.select("query", "page", F.lit(200).alias("status"), F.transform("items", lambda i: i.dropFields("_at")).alias("items"))


@query("items_pushed", RECORDED + " SELECT query, id, stars FROM i WHERE mcp AND stars BETWEEN 100 AND 2500")
def _(spark, d):
    path = scratch(spark, "items")
    items.record_items(_recorded_items(spark, d), path)
    found = items.items(spark, path).where(items.slice_filter("topic:mcp stars:100..2500"))
    return found.select("query", "id", F.col(items.STARS).alias("stars"))


@query("items_in_order", RECORDED + " SELECT query, id, CAST(row_number() OVER (PARTITION BY query ORDER BY stars DESC, idx) - 1 AS INTEGER) AS place FROM i")
def _(spark, d):
    path = scratch(spark, "items")
    items.record_items(_recorded_items(spark, d), path)
    return items.items(spark, path, in_order=True).select("query", "id", "place")


@query("items_stream", RECORDED + " SELECT query, count(*) AS n, max(idx // 20 + 1) AS pages FROM i GROUP BY 1")
def _(spark, d):
    """A stream that is started twice; the second load has the later pages."""
    base, pages = scratch(spark, "items"), _recorded_items(spark, d)

    def put(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/n{n}")

    for now in (F.col("page") == 1, F.col("page") > 1):
        pages.where(now).write.mode("append").partitionBy("query", "page").json(f"{base}/in/pages")
        stream = items.stream_items(spark, f"{base}/in").writeStream.foreachBatch(put).option("checkpointLocation", f"{base}/checkpoint")
        stream.trigger(availableNow=True).start().awaitTermination()
    return stored(spark, f"{base}/out", items.ITEMS).groupBy("query").agg(F.count("*").alias("n"), F.max("page").cast("long").alias("pages"))


@query("scan_progress", "SELECT 'web' AS source, o_orderpriority AS query, CAST(max(o_orderkey % 9) AS INTEGER) AS page, max(o_orderkey % 9) >= 8 AS completed FROM orders GROUP BY 2")
def _(spark, d):
    path = scratch(spark, "progress")
    pages = table(spark, d, "orders").select(F.col("o_orderpriority").alias("query"), (F.col("o_orderkey") % 9).cast("int").alias("page"), F.lit(200).alias("status"), F.array(F.lit(1)).alias("items"))
    for rest in (0, 1):
        scan.append_progress(scan.progress(pages.where(F.col("page") % 2 == rest), "web", 1, 8), path)
    return scan.latest(spark.read.parquet(path))


@query("pages_to_read", """
WITH w AS (SELECT DISTINCT o_orderpriority AS query, CAST(o_orderkey % 9 AS INTEGER) AS page FROM orders)
SELECT query, page FROM w WHERE query NOT LIKE '1%' AND (query NOT LIKE '2%' OR page >= 4)""")
def _(spark, d):
    wanted = table(spark, d, "orders").select(F.col("o_orderpriority").alias("query"), (F.col("o_orderkey") % 9).cast("int").alias("page")).distinct()
    own = wanted.select("query").distinct().where("query LIKE '1%' OR query LIKE '2%'")
    done = own.select(F.lit("web").alias("source"), "query", F.lit(4).alias("page"), F.lit(9).alias("items"), F.col("query").startswith("1").alias("completed"))
    return scan.to_read(wanted, done, "web")


@query("provider_chain", """
WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_suppkey % 2 = 0 AS has_url FROM supplier)
SELECT id, 'first' AS provider, 'RATE_LIMITED' AS status, false AS usable, 'EMPTY_DESCRIPTION' AS verdict FROM s
UNION ALL SELECT id, 'second', 'SUCCESS', false, 'UNCITED_SOURCE_URL: https://hallucinated-fake-url.com/docs not in evidence package' FROM s
UNION ALL SELECT id, 'third', 'SUCCESS', has_url, CASE WHEN has_url THEN 'VALID_GROUNDED' ELSE 'UNCITED_SOURCE_URL: https://github.com/example/repo not in evidence package' END FROM s
UNION ALL SELECT id, 'fourth', 'UNGROUNDED', false, 'MODEL_UNGROUNDED_FLAG' FROM s WHERE NOT has_url""")
def _(spark, d):
    none = F.lit(None).cast("string")
    urls = F.when(F.col("s_suppkey") % 2 == 0, F.array(F.lit("https://a.example/"))).otherwise(F.array().cast("array<string>"))
    package = F.struct(
        F.col("s_name").alias("tool_name"), none.alias("official_website_content"), none.alias("repository_description"), none.alias("readme_excerpt"),
        F.array().cast("array<string>").alias("topics"), none.alias("company_name"), urls.alias("source_urls"),
    )
    packages = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), package.alias("evidence"))
    modes = {"first": "SIMULATED_429", "second": "SIMULATED_UNSUPPORTED_URL", "third": "SUCCESS", "fourth": "SIMULATED_UNGROUNDED"}
    return ask(packages, [scripted(n, m) for n, m in modes.items()]).select("id", "provider", "status", "usable", "verdict")


@query("report_positions", "SELECT s_suppkey AS ordinal, CAST(row_number() OVER (ORDER BY s_suppkey) AS INTEGER) AS position FROM supplier ORDER BY 1 LIMIT 50")
def _(spark, d):
    return numbered(table(spark, d, "supplier").select(F.col("s_suppkey").alias("ordinal")), 50)


@query("quality_report", """
WITH r AS (SELECT *, CASE s_suppkey % 3 WHEN 0 THEN 'GITHUB_README' WHEN 1 THEN 'OFFICIAL_WEBSITE' END AS kind, CASE WHEN s_suppkey % 2 = 0 THEN ['Coding', 'Agents'] ELSE ['Agents'] END AS categories FROM supplier),
k AS (SELECT kind, count(*) AS n FROM r WHERE kind IS NOT NULL GROUP BY 1), c AS (SELECT category, count(*) AS n FROM (SELECT unnest(categories) AS category FROM r) GROUP BY 1)
SELECT 1 AS section, 0 AS place, 'target' AS item, '50' AS value UNION ALL SELECT 1, 1, 'accepted', CAST(count(*) AS VARCHAR) FROM r UNION ALL SELECT 1, 2, 'target_reached', CASE WHEN count(*) >= 50 THEN 'YES' ELSE 'NO' END FROM r
UNION ALL SELECT 2, 0, 'audited', CAST(count(*) AS VARCHAR) FROM r UNION ALL SELECT 2, 1, 'PASS', CAST(count(*) FILTER (s_suppkey % 4 <> 0) AS VARCHAR) FROM r
UNION ALL SELECT 2, 2, 'CORRECTED', CAST(count(*) FILTER (s_suppkey % 4 = 0) AS VARCHAR) FROM r UNION ALL SELECT 2, 3, 'REVIEW_REQUIRED', '0' UNION ALL SELECT 2, 4, 'REJECT', '0'
UNION ALL SELECT 3, 0, 'official_urls', CAST(count(*) FILTER (s_suppkey % 5 <> 0) AS VARCHAR) FROM r UNION ALL SELECT 3, 1, 'websites_verified', CAST(count(*) FILTER (s_suppkey % 5 = 1) AS VARCHAR) FROM r
UNION ALL SELECT 3, 2, 'repositories_verified', CAST(count(*) AS VARCHAR) FROM r UNION ALL SELECT 3, 3, 'logos_verified', CAST(count(*) FILTER (s_suppkey % 2 = 0) AS VARCHAR) FROM r
UNION ALL SELECT 3, 4, 'social_previews', CAST(count(*) FILTER (s_suppkey % 2 = 1) AS VARCHAR) FROM r UNION ALL SELECT 3, 5, 'grounded', CAST(count(*) FILTER (s_suppkey % 3 <> 2) AS VARCHAR) FROM r
UNION ALL SELECT 4, 0, 'discovered', CAST(count(*) AS VARCHAR) FROM r
UNION ALL SELECT 5, CAST(row_number() OVER (ORDER BY n DESC, kind) - 1 AS INTEGER), kind, CAST(n AS VARCHAR) FROM k
UNION ALL SELECT 6, CAST(row_number() OVER (ORDER BY n DESC, category) - 1 AS INTEGER), category, CAST(n AS VARCHAR) FROM c
UNION ALL SELECT 7, 0, 'n', CAST(count(*) AS VARCHAR) FROM r UNION ALL SELECT 7, 1, 'low', CAST(min(s_suppkey) AS VARCHAR) FROM r UNION ALL SELECT 7, 2, 'high', CAST(max(s_suppkey) AS VARCHAR) FROM r
UNION ALL SELECT 7, 3, 'median', CAST(CAST(floor(median(s_suppkey)) AS BIGINT) AS VARCHAR) FROM r
UNION ALL SELECT 8, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(s_nationkey AS VARCHAR)) - 1 AS INTEGER), CAST(s_nationkey AS VARCHAR), CAST(count(*) AS VARCHAR) FROM r GROUP BY s_nationkey""")
def _(spark, d):
    o = F.col("s_suppkey")
    records = table(spark, d, "supplier").select(
        o.alias("ordinal"), o.alias("github_stars"), F.when(o % 5 != 0, "https://a.example").alias("official_url"), (o % 5 == 1).alias("website_verified"),
        F.lit(True).alias("github_repository_verified"), (o % 2 == 0).alias("logo_verified"), F.when(o % 2 == 1, "github_social_preview").alias("logo_source"),
        (o % 3 != 2).alias("description_grounded"), F.when(o % 3 == 0, "GITHUB_README").when(o % 3 == 1, "OFFICIAL_WEBSITE").alias("description_source_type"),
        F.when(o % 2 == 0, F.array(F.lit("Coding"), F.lit("Agents"))).otherwise(F.array(F.lit("Agents"))).alias("categories"), "s_nationkey",
    )
    audits = records.select(F.when(F.col("ordinal") % 4 == 0, "CORRECTED").otherwise("PASS").alias("overall_audit_status"))
    reasons = records.groupBy(F.col("s_nationkey").cast("string").alias("reason")).agg(F.count("*").alias("n"))
    return quality_rows(records, audits, records.agg(F.count("*").alias("discovered")), reasons, 50)
