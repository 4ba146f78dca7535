"""Writers of records, logs and exports."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import has, yes

ZONES = ("raw", "working", "cleaned", "normalized", "validated", "rejected", "exports")


def zone(base: str, name: str) -> str:
    """The path of one of the seven zones under ``base``."""
    if name not in ZONES:
        raise ValueError(f"no such zone: {name}")
    return f"{base.rstrip('/')}/{name}"


def append_raw(raw: DataFrame, path: str, source_name: str, as_of: str) -> None:
    """Raw records in envelopes, partitioned by source and date."""
    envelope = raw.select(F.struct(*raw.columns).alias("raw"), F.lit(as_of).alias("discovered_at"), F.lit(source_name).alias("source_name"))
    dated = envelope.withColumn("ingest_date", F.date_format(F.lit(as_of).cast("timestamp"), "yyyyMMdd"))
    dated.write.mode("append").partitionBy("source_name", "ingest_date").option("ignoreNullFields", False).json(path)


def write_jsonl(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with nulls kept."""
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def append_rejected(rows: DataFrame, path: str, reason: str, stage: str, as_of: str) -> None:
    """Rejected rows with the reason in column ``reason``, partitioned by stage."""
    kept = [c for c in rows.columns if c != reason]
    made = rows.select(F.struct(*kept).alias("record"), F.col(reason).alias("reason"), F.lit(as_of).alias("timestamp"), F.lit(stage).alias("pipeline_stage"))
    made.write.mode("append").partitionBy("pipeline_stage").option("ignoreNullFields", False).json(path)


def clear(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def replace_file(spark: SparkSession, new: Any, target: Any) -> None:
    """Renames a Hadoop path over another in one step."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    own = target.getFileSystem(conf)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(own.getUri(), conf).rename(own.makeQualified(new), own.makeQualified(target), how)


def write_json_array(rows: DataFrame, path: str) -> int:
    """One JSON array in one file, for exports that a person opens; returns the number of rows.

    Tasks write their rows beside ``path``, by Spark's commit protocol; only when all are done are the
    parts put together, streamed by the Hadoop file system, and the whole is renamed to ``path``.  A
    run that fails leaves ``path`` as it was and no other file.
    """
    spark, between = rows.sparkSession, ",\n"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    parts, whole, target = (hadoop.Path(f"{path}{end}") for end in (f"-parts-{uuid.uuid4().hex}", f"-whole-{uuid.uuid4().hex}", ""))
    system = target.getFileSystem(conf)
    try:
        made = rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false", "pretty": "true"}).alias("value"))
        made.write.option("lineSep", between).text(parts.toString())
        n = made.count()
        files = sorted((f for f in system.listStatus(parts) if f.getPath().getName().startswith("part-") and f.getLen()), key=lambda f: f.getPath().getName())
        out = system.create(whole, True)
        try:
            out.write(bytearray(b"[\n" if files else b"["))
            for k, f in enumerate(files):
                source = system.open(f.getPath())
                try:  # the last row has nothing after it
                    jvm.org.apache.commons.io.IOUtils.copyLarge(source, out, 0, f.getLen() - len(between) * (k == len(files) - 1))
                finally:
                    source.close()
            out.write(bytearray(b"\n]\n"))
        finally:
            out.close()
        replace_file(spark, whole, target)
        return n
    finally:
        for left in (parts, whole):
            system.delete(left, True)


def csv_rows(records: DataFrame) -> DataFrame:
    """The 34 columns of the CSV export."""

    def nested(prefix: str) -> list:
        names = (("name", "name"), ("url", "url"), ("source_type", "type"), ("source_trust_level", "trust_level"))
        return [F.col(f"{prefix}.{inner}").alias(f"{prefix}_{outer}") for inner, outer in names]

    return records.select(
        "id", "entity_type", "name", "description", "url", "official_url", "github_repo_url", "github_stars", "logo_url",
        F.array_join("categories", "|").alias("categories"), "company_name", "company_url", *nested("discovery_source"),
        "external_evidence_available", "external_evidence_url", F.size("evidence_sources").alias("evidence_sources_count"),
        *nested("source"), "verification_status", "website_verified", "github_repository_verified", "logo_verified",
        "description_grounded", "description_source_type", "description_generation_method", "llm_provider_used",
        "llm_enrichment_status", "quality_score", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss").alias("collected_at"),
    )


def sheet_rows(records: DataFrame) -> DataFrame:
    """The twelve strings of a sheet row."""

    def text(c: str):
        return F.coalesce(F.col(c), F.lit(""))

    def flag(c: str):
        return F.when(yes(F.col(c)), "True").otherwise("False")

    site = F.when(F.col("official_url").startswith("http"), F.col("official_url")).otherwise(F.lit(""))
    return records.select(
        text("name").alias("Name"), text("description").alias("Description"), F.coalesce(site, F.lit("")).alias("Official Website"),
        text("logo_url").alias("Official Logo"), text("github_repo_url").alias("GitHub Repository"),
        F.coalesce(F.array_join("categories", " | "), F.lit("")).alias("Categories"),
        F.coalesce("discovery_source.name", F.lit("GitHub API Search")).alias("Source"),
        F.coalesce("discovery_source.url", text("github_repo_url")).alias("Source URL"), text("id").alias("Record ID"),
        flag("website_verified").alias("Website Verified"), flag("logo_verified").alias("Logo Verified"), flag("description_grounded").alias("Description Grounded"),
    )


def mapping_rows(resolved: DataFrame) -> DataFrame:
    """The entity mapping log, with the true method, confidence and source of each record."""
    return resolved.select(
        F.coalesce("raw_name", "name").alias("raw_name"), "canonical_name", F.lit("TOOL").alias("entity_type"),
        F.coalesce("match_method", F.lit("direct")).alias("match_method"), F.coalesce("match_confidence", F.lit(1.0)).alias("confidence"),
        F.col("discovery_source_name").alias("source"),
    )


def write_csv(rows: DataFrame, path: str, skip_empty: bool = False) -> bool:
    if skip_empty and rows.isEmpty():
        return False
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return True


def export_all(records: DataFrame, resolved: DataFrame, base: str) -> int:
    """All four exports: JSON lines, the JSON array, CSV and the mapping log; records and log are computed once each."""
    held, log = records.persist(), mapping_rows(resolved).persist()
    try:
        write_jsonl(held, f"{base}/tools_jsonl")
        n = write_json_array(held, f"{base}/tools.json")
        write_csv(csv_rows(held), f"{base}/tools_csv")
        write_csv(log, f"{base}/entity_mapping_log", skip_empty=True)
        return n
    finally:
        held.unpersist()
        log.unpersist()


def platform_website(records: DataFrame) -> DataFrame:
    """Records whose official website is an address on a code host; exports must have none."""
    return records.where(has(F.col("official_url")) & F.lower("official_url").contains("github.com"))
