"""Classification into the taxonomy, from topics and from words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lex
from ..functions.rules import any_part, appended, listed, removed, words


def _topic_map(topics: dict[str, tuple[str, ...]]) -> Column:
    return F.create_map(*(F.lit(x) for category, own in topics.items() for t in own for x in (t, category)))


def topic_categories(topics: Column, taxonomy=lex.TAXONOMY, category_topics=None) -> Column:
    """Categories of the topics, in topic order, each once, as far as the taxonomy has them."""
    table = _topic_map(category_topics or lex.CATEGORY_TOPICS)
    found = F.transform(F.coalesce(topics, F.array().cast("array<string>")), lambda t: F.try_element_at(table, F.lower(F.trim(t))))
    return F.array_distinct(F.filter(found, lambda c: c.isNotNull() & F.array_contains(words(taxonomy), c)))


def word_categories(text: Column, taxonomy=lex.TAXONOMY, category_words=lex.CATEGORY_WORDS) -> Column:
    """Categories with a word in the text (a part of it is enough), in the order of the word lists."""
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    return F.array_distinct(listed(*(F.when(any_part(padded, own), F.lit(c)) for c, own in category_words if c in taxonomy)))


def classify(records: DataFrame, taxonomy=lex.TAXONOMY, category_topics=None, category_words=lex.CATEGORY_WORDS) -> DataFrame:
    """``records`` with categories replaced and category_inference_reasons added.

    Reads categories, github_topics, description, name, discovery_source_type.
    """
    none = F.array().cast("array<string>")
    valid = F.filter(F.coalesce("categories", none), lambda c: F.array_contains(words(taxonomy), c))
    seeded = (F.size(valid) > 0) & F.coalesce(F.col("discovery_source_type") == "CURATED_SEED", F.lit(False))
    text = F.trim(F.concat(F.trim(F.coalesce("description", F.lit(""))), F.lit(" "), F.trim(F.coalesce("name", F.lit("")))))
    low = F.lower(text)
    staged = records.withColumns({
        "_valid": valid, "_seeded": seeded, "_low": low,
        "_topics": topic_categories(F.col("github_topics"), taxonomy, category_topics),
        "_words": F.when(text != "", word_categories(text, taxonomy, category_words)).otherwise(none),
    })
    staged = staged.withColumn("_before", F.concat("_valid", "_topics"))
    staged = staged.withColumn("_added", F.array_except("_words", "_before"))
    staged = staged.withColumn("_found", F.concat("_before", "_added"))

    code, prompt, browser = (any_part(F.col("_low"), w) for w in (lex.CODE_EXECUTION_WORDS, lex.PROMPT_WORDS, lex.BROWSER_WORDS))

    staged = staged.withColumn("_c2", appended(removed(F.col("_found"), "Agents", code), "Developer Tools", code, ("Developer Tools", "Coding")))
    staged = staged.withColumn("_c4", appended(removed(F.col("_c2"), "Models", prompt), "Productivity", prompt, ("Productivity", "Developer Tools")))
    staged = staged.withColumn("_c5", F.array_distinct(removed(F.col("_c4"), "Models", browser)))

    def gone(value: str, before: str, when: Column, why: str) -> Column:
        return F.when(when & F.array_contains(before, value), F.lit(f"Removed '{value}': {why}"))

    def quoted(array: str) -> Column:
        return F.concat(F.lit("["), F.array_join(F.transform(array, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))

    reasons = F.concat(
        listed(F.when(F.size("_topics") > 0, F.concat(F.lit("Inferred from GitHub topics "), quoted("github_topics"), F.lit(": "), quoted("_topics")))),
        F.transform("_added", lambda c: F.concat(F.lit("Inferred from description/name: "), c)),
        listed(
            gone("Agents", "_found", code, "code execution service is primary Developer Tools / Coding"),
            gone("Models", "_c2", prompt, "prompt utility is primary Productivity / Developer Tools"),
            gone("Models", "_c4", browser, "browser automation is primary Automation / Agents"),
            F.when(F.size("_c5") == 0, F.lit("Fallback: no evidence-based category found")),
        ),
    )
    kept = F.array(F.concat(F.lit("Pre-existing seed categories: "), quoted("_valid")))
    return staged.withColumns({
        "categories": F.when(F.col("_seeded"), F.col("_valid")).when(F.size("_c5") > 0, F.col("_c5")).otherwise(F.array(F.lit("Developer Tools"))),
        "category_inference_reasons": F.when(F.col("_seeded"), kept).otherwise(reasons),
    }).drop("_valid", "_seeded", "_low", "_topics", "_words", "_before", "_added", "_found", "_c2", "_c4", "_c5")


def categories_by_join(records: DataFrame, id_col: str, topics_col: str = "github_topics") -> DataFrame:
    """(id, topic, category): the topic map as a table joined to exploded topics.  The map has about a
    hundred rows whatever the input, so it is broadcast."""
    spark = records.sparkSession
    table = spark.createDataFrame([(t, c) for c, own in lex.CATEGORY_TOPICS.items() for t in own], "topic string, category string")
    topics = records.select(F.col(id_col).alias("id"), F.explode(F.transform(topics_col, lambda t: F.lower(F.trim(t)))).alias("topic"))
    return topics.join(F.broadcast(table), "topic").select("id", "topic", "category")
