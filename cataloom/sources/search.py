"""Recorded pages of a repository search, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rules import filled, yes
from ..functions.text import truncated_readme
from ..operators.shape import split_official_url

ITEM = (
    "struct<id:bigint,name:string,html_url:string,homepage:string,owner:struct<login:string,html_url:string>,"
    "topics:array<string>,description:string,stargazers_count:bigint,fork:boolean,archived:boolean,language:string,updated_at:string>"
)
PAGE = f"query string, page int, status int, items array<{ITEM}>"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(query, page, status, items) of JSON lines, one page a line."""
    return spark.read.schema(PAGE).json(path)


def reached_pages(pages: DataFrame, page_size: int) -> DataFrame:
    """The pages that a scan reads: up to the first short, empty or refused page of each query.  Pages
    answered 429 or 5xx are passed over, not read again; other failures end their query."""
    skipped = (F.col("status") == 429) | (F.col("status") >= 500)
    ends = ~skipped & ((F.col("status") != 200) | (F.coalesce(F.size("items"), F.lit(0)) < page_size))
    before = Window.partitionBy("query").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    reached = pages.withColumn("_over", F.coalesce(F.max(ends).over(before), F.lit(False))).where("not _over").drop("_over")
    return reached.where("status = 200")


def candidates(pages: DataFrame, page_size: int = 100, limit: int | None = None, readmes: DataFrame | None = None) -> DataFrame:
    """Raw candidates in order of query, page and place; the first item of each repository.

    Repeated repositories go before READMEs (full_name, content) are looked up.
    """
    items = reached_pages(pages, page_size).select("query", "page", F.posexplode("items").alias("place", "item"))
    once = items.withColumn("_r", F.row_number().over(Window.partitionBy("item.id").orderBy("query", "page", "place"))).where("_r = 1")
    if limit is not None:
        once = once.orderBy("query", "page", "place").limit(limit)
    official, url = split_official_url(F.col("item.homepage"), F.col("item.html_url"))
    rows = once.select(
        "query", "page", "place", F.col("item.id").alias("repo_id"), F.col("item.name").alias("name"), official.alias("official_url"), url.alias("url"),
        F.col("item.owner.login").alias("github_owner"), F.col("item.owner.login").alias("company_name"), F.col("item.owner.html_url").alias("company_url"),
        F.col("item.html_url").alias("github_repo_url"), filled(F.col("item.description")).alias("description"),
        F.col("item.stargazers_count").alias("github_stars"), F.coalesce("item.topics", F.array().cast("array<string>")).alias("github_topics"),
        yes(F.col("item.fork")).alias("is_fork"), yes(F.col("item.archived")).alias("is_archived"), F.col("item.language").alias("language"),
        F.col("item.updated_at").alias("updated_at"), F.col("query").alias("discovery_query"), F.lit("API").alias("discovery_source_type"),
        F.lit("HIGH").alias("discovery_source_trust_level"), F.lit(True).alias("external_evidence_available"), F.col("item.html_url").alias("external_evidence_url"),
    )
    if readmes is None:
        return rows
    found = readmes.select(F.col("full_name").alias("_full"), truncated_readme(F.col("content")).alias("readme_content"))
    joined = rows.join(found, F.concat_ws("/", "github_owner", "name") == F.col("_full"), "left").drop("_full")
    return joined.withColumn("readme_available", F.col("readme_content").isNotNull())


def page_counts(pages: DataFrame, page_size: int = 100) -> DataFrame:
    """(query, pages_fetched, items)."""
    return reached_pages(pages, page_size).groupBy("query").agg(F.count("*").alias("pages_fetched"), F.sum(F.size("items")).alias("items"))
