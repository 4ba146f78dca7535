"""Aggregates of reports: funnels, counts, summaries, collisions, top reasons."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as lex
from ..functions.url import audit_domain
from .scratch import Scratch


def funnel(records: DataFrame) -> DataFrame:
    """One row of counts over records with qualification_status, duplicate_of, accepted, readme_available."""
    status, new = F.col("qualification_status"), F.col("duplicate_of").isNull()
    qualified = F.coalesce(status == "QUALIFIED_TOOL", F.lit(True))
    return records.agg(
        F.count("*").alias("discovered"), F.count_if(status == "QUALIFIED_TOOL").alias("qualified"),
        F.count_if(status == "REVIEW_REQUIRED").alias("review_required"), F.count_if(status == "REJECTED_NON_TOOL").alias("rejected"),
        F.count_if(qualified & ~new).alias("duplicates"), F.count_if(qualified & new & F.col("accepted")).alias("accepted"),
        F.count_if(qualified & new & ~F.col("accepted")).alias("rejected_validation"),
        F.count_if(F.col("readme_available")).alias("readme_found"), F.count_if(~F.coalesce("readme_available", F.lit(False))).alias("readme_missing"),
    )


def counted_with_values(rows: DataFrame, keys: list[str], value: str, piece: Column, count: str = "n", name: str = "ids") -> DataFrame:
    """(``keys``, ``count``, ``name``): the number of rows of each key and all their values that are not null, in order,
    comma-joined.  ``piece`` cuts the values of a key into ranges in their order; a range is sorted and joined by itself,
    so what meets in one row is one string a range."""
    parts = rows.groupBy(*keys, piece.alias("_piece")).agg(
        F.count("*").alias("_n"), F.count(value).alias("_held"), F.array_join(F.transform(F.array_sort(F.collect_list(value)), lambda v: v.cast("string")), ",").alias("_part")
    )
    held = F.when(F.col("_held") > 0, F.struct("_piece", "_part"))
    whole = parts.groupBy(*keys).agg(F.sum("_n").alias(count), F.array_sort(F.collect_list(held)).alias("_parts"))
    return whole.select(*keys, count, F.when(F.size("_parts") > 0, F.array_join(F.transform("_parts", lambda p: p["_part"]), ",")).alias(name))


def reason_of(reasons: str, first: int = 2) -> Column:
    return F.array_join(F.slice(reasons, 1, first), ", ")


def counts_by(records: DataFrame, column: str, name: str | None = None) -> DataFrame:
    return records.groupBy(F.col(column).alias(name or column)).agg(F.count("*").alias("n"))


def category_counts(records: DataFrame) -> DataFrame:
    # the outer form keeps the optimizer from repeating what makes the array as a filter below
    return records.select(F.explode_outer("categories").alias("category")).where("category is not null").groupBy("category").agg(F.count("*").alias("n"))


#: A range of values is cut into so many parts a round, and the last so many values are sorted.
PARTS, FEW = 1024, 4096


def ranked_value(rows: DataFrame, column: str, rank: int) -> float | int | None:
    """The value at ``rank`` (from 0) of the values of a numeric column that are neither null nor NaN.

    The range of values is narrowed to the part that holds the rank, by counts of at most 1024 parts a
    round, until one value or at most 4096 rows are left; so no task gets more than that, however
    often values repeat.  None where there are not so many values.
    """
    own = rows.select(F.col(column).alias("v")).where(F.col("v").isNotNull() & ~F.isnan(F.col("v").cast("double")))
    facts = own.agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    n, low, high = facts["n"], facts["low"], facts["high"]
    if not 0 <= rank < n:
        return None
    while low < high and n > FEW:
        width = (high - low) / PARTS
        part = F.least(F.floor((F.col("v").cast("double") - float(low)) / float(width)), F.lit(PARTS - 1)).cast("int")
        own = own.where((F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high)))
        counts = own.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("part").collect()
        for c in counts:
            if rank < c["n"]:
                n, low, high = c["n"], c["low"], c["high"]
                break
            rank -= c["n"]
        if len(counts) == 1:  # finer than numbers can tell apart
            break
    if low == high:
        return low
    left = own.where((F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high)))
    return left.groupBy("v").agg(F.count("*").alias("n")).orderBy("v").withColumn("upto", F.sum("n").over(Window.orderBy("v"))).where(F.col("upto") > rank).first()["v"]


def exact_median(rows: DataFrame, column: str) -> float | None:
    n = rows.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).count()
    if not n:
        return None
    low = ranked_value(rows, column, (n - 1) // 2)
    return float(low) if n % 2 else (float(low) + float(ranked_value(rows, column, n // 2))) / 2


def numeric_summary(rows: DataFrame, column: str) -> DataFrame:
    """Count, smallest, largest and whole median of the values that are not null; zeros for none."""
    median = exact_median(rows, column)
    return rows.agg(
        F.count(column).alias("n"), F.coalesce(F.min(column), F.lit(0)).alias("low"), F.coalesce(F.max(column), F.lit(0)).alias("high"),
        F.lit(0 if median is None else math.floor(median)).cast("long").alias("median"),
    )


def flag_counts(records: DataFrame, **flags: Column) -> DataFrame:
    return records.agg(*(F.count_if(c).alias(n) for n, c in flags.items()))


def top_reasons(records: DataFrame, reason: Column, ordinal: str = "ordinal", k: int = 10) -> DataFrame:
    """The most frequent reasons; of equal counts the one seen first."""
    counted = records.where(reason.isNotNull()).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"), F.min(ordinal).alias("first_seen"))
    return counted.orderBy(F.desc("n"), "first_seen", "reason").limit(k)


def first_accepted(records: DataFrame, target: int) -> DataFrame:
    """Accepted records in order of arrival, up to the target."""
    return records.where("accepted").orderBy("ordinal").limit(target)


def accept_in_slices(records: DataFrame, judge: Callable[[DataFrame], DataFrame], target: int, scratch: Scratch, first: int = 1000) -> tuple[DataFrame, int]:
    """(the first ``target`` records that ``judge`` accepts, number of records judged).

    Records are judged in slices of their ordinals, each twice as wide as the one before; the run ends
    with the slice that fills the target, and what comes after it is not even read where the source
    prunes by ordinal.  ``judge`` gives a DataFrame with ``ordinal`` and ``accepted`` and judges each
    record by itself.
    """
    ends = records.agg(F.min("ordinal").alias("low"), F.max("ordinal").alias("high")).first()
    kept, found, judged, low, width, step = None, 0, 0, ends["low"], first, 0
    while low is not None and low <= ends["high"] and found < target:
        own = records.where((F.col("ordinal") >= low) & (F.col("ordinal") < low + width))
        part = scratch.save(judge(own), f"slice_{step}")
        facts = part.agg(F.count("*").alias("n"), F.count_if(F.col("accepted")).alias("good")).first()
        judged, found = judged + facts["n"], found + facts["good"]
        kept = part if kept is None else kept.unionAll(part)
        low, width, step = low + width, width * 2, step + 1
    return first_accepted(judge(records.limit(0)) if kept is None else kept, target), judged


def host_kind(host: Column, kinds: dict[str, tuple[str, ...]] = lex.HOST_KINDS, other: str = lex.OTHER_HOST_KIND) -> Column:
    out = F.lit(other)
    for kind, hosts in reversed(kinds.items()):
        out = F.when(host.isin(*hosts), kind).otherwise(out)
    return out


def _hosted(records: DataFrame, url: str, hosts: Column | None) -> DataFrame:
    named = records.withColumn("domain", hosts if hosts is not None else audit_domain(F.col(url)))
    return named.where((F.col("domain") != "") & ~F.col("domain").isin(*lex.CODE_HOSTS))


def host_collisions(records: DataFrame, url: str = "official_url", hosts: Column | None = None, id_col: str | None = None) -> DataFrame:
    """(domain, collision_count, category, recommendation) for hosts of more than one record; with ``id_col``, of
    strings, also ``ids``, all of a host in order and comma-joined, put together by ranges of their first characters."""
    named = _hosted(records, url, hosts)
    if id_col is None:
        counted = named.groupBy("domain").agg(F.count("*").alias("collision_count"))
    else:
        counted = counted_with_values(named, ["domain"], id_col, F.substring(id_col, 1, 7), "collision_count")  # "tool_" and two digits
    many = counted.where("collision_count > 1")
    return many.withColumns({"category": host_kind(F.col("domain")), "recommendation": F.lit(lex.COLLISION_ADVICE)})


def collision_members(records: DataFrame, url: str = "official_url", id_col: str = "id", hosts: Column | None = None) -> DataFrame:
    """(domain, id, name, official_url): a row for each record of a host of more than one."""
    named = _hosted(records, url, hosts)
    many = named.groupBy("domain").agg(F.count("*").alias("n")).where("n > 1")
    return named.join(many, "domain", "left_semi").select("domain", F.col(id_col).alias("id"), "name", F.col(url).alias("official_url"))


def relationships(records: DataFrame) -> DataFrame:
    """Company develops tool, for records with a company."""
    return records.where(F.coalesce("company_name", F.lit("")) != "").select(
        F.col("company_name").alias("source_entity"), F.lit("COMPANY").alias("source_type"), F.lit("develops").alias("relationship"),
        F.col("id").alias("target_id"), F.col("name").alias("target_name"), F.lit("TOOL").alias("target_type"),
        F.struct(F.col("url").alias("official_website"), F.col("company_url").alias("company_url")).alias("evidence"),
    )


def expansion_rates(records: DataFrame) -> DataFrame:
    """Qualification and duplicate rates in percent; duplicates count twice in the second's base, as reports have it."""
    n = F.count("*")
    good, dup = F.count_if(F.col("qualification_status") == "QUALIFIED_TOOL"), F.count_if(F.col("duplicate_of").isNotNull())
    kept = F.count_if((F.col("qualification_status") == "QUALIFIED_TOOL") & F.col("duplicate_of").isNull())
    return records.agg(
        n.alias("candidates"), good.alias("qualified"), dup.alias("duplicates"),
        F.round(F.when(n > 0, good * 100.0 / n).otherwise(0.0), 2).alias("qualification_rate"),
        F.round(F.when(good + dup > 0, dup * 100.0 / (kept + 2 * dup)).otherwise(0.0), 2).alias("duplicate_rate"),
    )


def markdown_report(title: str, sections: dict[str, DataFrame], most: int = 100) -> str:
    """Small aggregates as Markdown tables; at most ``most`` rows of each are fetched."""
    out = [f"# {title}", ""]
    for name, table in sections.items():
        rows = table.limit(most).collect()
        out += [f"## {name}", "", "| " + " | ".join(table.columns) + " |", "|" + " --- |" * len(table.columns)]
        out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in rows] + [""]
    return "\n".join(out)


def quality_rows(records: DataFrame, audits: DataFrame, facts: DataFrame, reasons: DataFrame, target: int) -> DataFrame:
    """(section, place, item, value) of the quality report, values as strings.

    ``records``: the accepted ones; ``audits``: their overall_audit_status; ``facts``: the row of
    ``funnel``; ``reasons``: (reason, n), the most frequent ones.  Each section is one small aggregate.
    """
    def lines(section: int, one_row: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(i).alias("place"), F.lit(c).alias("item"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(one_row.columns)]
        return one_row.select(F.lit(section).alias("section"), F.explode(F.array(*pairs)).alias("line")).select("section", "line.*")

    def ranked(section: int, counted: DataFrame, item: str) -> DataFrame:
        made = counted.select(F.col(item).cast("string").alias("item"), "n").groupBy().agg(
            F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "item"))).alias("all")  # kinds, never records
        )
        return made.select(F.lit(section).alias("section"), F.posexplode("all").alias("place", "line")).select(
            "section", "place", F.col("line.item").alias("item"), (-F.col("line.less")).cast("string").alias("value")
        )

    n = F.count("*")
    status = F.col("overall_audit_status")
    parts = [
        lines(1, records.agg(F.lit(target).alias("target"), n.alias("accepted"), F.when(n >= target, "YES").otherwise("NO").alias("target_reached"))),
        lines(2, audits.agg(n.alias("audited"), *(F.count_if(status == s).alias(s) for s in ("PASS", "CORRECTED", "REVIEW_REQUIRED", "REJECT")))),
        lines(3, records.agg(
            F.count_if(F.coalesce("official_url", F.lit("")) != "").alias("official_urls"), F.count_if("website_verified").alias("websites_verified"),
            F.count_if("github_repository_verified").alias("repositories_verified"), F.count_if("logo_verified").alias("logos_verified"),
            F.count_if(F.col("logo_source") == "github_social_preview").alias("social_previews"), F.count_if("description_grounded").alias("grounded"),
        )),
        lines(4, facts),
        ranked(5, counts_by(records.where("description_source_type IS NOT NULL"), "description_source_type"), "description_source_type"),
        ranked(6, category_counts(records), "category"),
        lines(7, numeric_summary(records, "github_stars")),
        ranked(8, reasons, "reason"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: The headings of the report's sections, in their order.
SECTIONS = (
    "Status & Summary", "Deterministic Audit Breakdown", "Verification & Semantic Precision Metrics", "Discovery & Qualification Metrics",
    "Description Source Types", "Category Distribution (Accepted Dataset)", "GitHub Star Metrics", "Top Qualification & Validation Rejection Reasons",
)


def quality_report(rows: DataFrame) -> str:
    """The report as Markdown; ``rows`` of ``quality_rows`` are some dozens."""
    held = rows.orderBy("section", "place").collect()
    out = ["# Quality Report"]
    for i, name in enumerate(SECTIONS, 1):
        out += ["", f"## {name}", *(f"- **{r['item']}**: {r['value']}" for r in held if r["section"] == i)]
    return "\n".join(out) + "\n"


def numbered(records: DataFrame, target: int, order: str = "ordinal") -> DataFrame:
    """The first ``target`` records in their order with their ``position`` in the report, from 1."""
    few = records.orderBy(order).limit(target)
    return few.withColumn("position", F.row_number().over(Window.orderBy(order)))
