import random

import pytest
from pyspark.sql import functions as F

from cataloom.operators.integrity import changed_records, hash_tree, manifest, tree_differences
from cataloom.operators.report import accept_in_slices, exact_median, ranked_value
from cataloom.operators.scratch import Scratch
from cataloom.sources import files, sinks
from cataloom.sources.keyed import KeyedTable


def test_upserts_rewrite_only_what_changes(spark, tmp_path):
    kept = KeyedTable(spark, str(tmp_path / "t"), "key", "key long, v string, at long", 8)
    assert kept.rows().count() == 0
    kept.upsert(spark.range(100).select(F.col("id").alias("key"), F.lit("a").alias("v"), F.lit(0).cast("long").alias("at")))
    before = kept._places()
    touched = kept.upsert(spark.createDataFrame([(3, "b", 1), (3, "c", 2), (3, "x", 0), (None, "n", 0)], "key long, v string, at long"), "at")
    after = kept._places()
    assert 1 <= len(touched) <= 2 and [b for b in after if before.get(b) != after[b]] == touched
    kept.upsert(spark.createDataFrame([(None, "m", 0)], "key long, v string, at long"))
    want = {k: "c" if k == 3 else "a" for k in range(100)} | {None: "m"}
    rows = kept.rows().collect()
    assert len(rows) == 101 and {r["key"]: r["v"] for r in rows} == want
    assert kept.vacuum() >= 2 and kept.vacuum() == 0 and kept.rows().count() == 101
    assert kept.upsert(kept.rows().limit(0)) == [] and kept.rows().count() == 101
    with pytest.raises(ValueError, match="8 buckets"):
        KeyedTable(spark, str(tmp_path / "t"), "key", "key long, v string, at long", 9).rows()


def test_an_upsert_that_fails_changes_nothing(spark, tmp_path):
    kept = KeyedTable(spark, str(tmp_path / "t"), "key", "key long, v string", 4)
    kept.upsert(spark.createDataFrame([(1, "a")], "key long, v string"))
    with pytest.raises(Exception, match="broken"):
        kept.upsert(spark.range(5).select(F.col("id").alias("key"), F.raise_error(F.lit("broken")).cast("string").alias("v")))
    assert [tuple(r) for r in kept.rows().collect()] == [(1, "a")]


def test_a_json_array_is_whole_or_not_there(spark, tmp_path):
    path = tmp_path / "a.json"
    rows = spark.range(50).select("id", F.when(F.col("id") % 2 == 0, 'x, "y"\n,\n').alias("v")).repartition(7)
    assert sinks.write_json_array(rows, str(path)) == 50
    assert sorted(map(tuple, files.read_json_array(spark, str(path), rows.schema, 50).collect())) == sorted(map(tuple, rows.collect()))
    whole = path.read_text()
    broken = rows.withColumn("v", F.when(F.col("id") == 49, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        sinks.write_json_array(broken, str(path))
    assert path.read_text() == whole and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["a.json"]
    assert sinks.write_json_array(rows.limit(0), str(path)) == 0 and files.read_json_array(spark, str(path), rows.schema).count() == 0


def records(spark, n=600, spoil=()):
    rows = [(f"id{i}", f"n{i}", None, None, "other" if i in spoil else "x") for i in range(n)]
    return spark.createDataFrame(rows, "id string, name string, official_url string, github_repo_url string, description string")


def test_trees_are_compared_from_the_root(spark, tmp_path):
    one, same, other = records(spark), records(spark).repartition(5), records(spark, 599, (17,))
    a, b, c = (hash_tree(t).cache() for t in (one, same, other))
    assert tree_differences(a, b) == ([], 1)
    leaves, looked = tree_differences(a, c)
    assert 1 <= len(leaves) <= 2 and looked <= 1 + 16 + 32  # of 1 + 16 + 256
    assert sorted(map(tuple, changed_records(one, other).collect())) == [("id17", "changed"), ("id599", "removed")]
    assert hash_tree(one.limit(0)).count() == 0
    sinks.write_jsonl(one.coalesce(1), str(tmp_path / "r"))
    facts = manifest(spark, str(tmp_path / "r" / "*.json"), one).first()
    assert facts["record_count"] == 600 and facts["file_size_bytes"] > 0 and facts["tree_digest"] == a.where("level = 0").first()["digest"]


@pytest.mark.parametrize("kind", ["spread", "one value", "two values", "tiny gaps", "whole"])
def test_median_is_exact(spark, monkeypatch, kind):
    from cataloom.operators import report

    monkeypatch.setattr(report, "FEW", 50)
    rng = random.Random(kind)
    n = rng.choice([1000, 1001])
    values = {
        "spread": [rng.uniform(-1e9, 1e9) ** 3 for _ in range(n)], "one value": [7.0] * n, "two values": [rng.choice([1.0, 2.0]) for _ in range(n)],
        "tiny gaps": [1 + rng.randint(0, 9) * 2**-52 for _ in range(n)], "whole": [rng.choice([5, rng.randint(-(10**15), 10**15)]) for _ in range(n)],
    }[kind]
    rows = spark.createDataFrame([(v,) for v in [*values, None]], "v long" if kind == "whole" else "v double").repartition(4)
    ordered = sorted(values)
    for rank in (0, n // 3, n - 1):
        assert ranked_value(rows, "v", rank) == ordered[rank]
    assert exact_median(rows, "v") == (ordered[(n - 1) // 2] + ordered[n // 2]) / 2 and ranked_value(rows, "v", n) is None


def test_median_of_nothing(spark):
    assert exact_median(spark.createDataFrame([(None,), (float("nan"),)], "v double"), "v") is None


def test_a_target_ends_the_run(spark):
    rows = spark.range(100_000).select(F.col("id").alias("ordinal"))
    judge = lambda r: r.withColumn("accepted", F.col("ordinal") % 7 == 3)
    found, judged = accept_in_slices(rows, judge, 50, Scratch(spark, "test"), first=100)
    assert [r["ordinal"] for r in found.collect()] == [7 * k + 3 for k in range(50)] and judged == 700
    none, judged = accept_in_slices(rows.where("ordinal < 250"), lambda r: r.withColumn("accepted", F.lit(False)), 5, Scratch(spark, "test"), first=100)
    assert none.count() == 0 and judged == 250
    assert accept_in_slices(rows.limit(0), judge, 5, Scratch(spark, "test"))[0].count() == 0


def test_every_gathering_is_gone(spark):
    """Members of hosts and of rule changes are rows, and counts agree with them."""
    from cataloom.operators.report import collision_members, host_collisions

    rows = spark.createDataFrame([("1", "a", "https://x.ai/1"), ("2", "b", "https://x.ai/2"), ("3", "c", "https://y.ai"), ("4", "d", None), ("5", "e", "https://github.com/a"), ("6", "f", "https://github.com/b")], "id string, name string, official_url string")
    assert [(r["domain"], r["collision_count"]) for r in host_collisions(rows).collect()] == [("x.ai", 2)]
    assert sorted(r["id"] for r in collision_members(rows).collect()) == ["1", "2"]




def test_changes_of_rules_have_all_ids(spark):
    from cataloom.operators.qualify import QualifyRules, rule_changes

    texts = spark.range(-5000, 20_000).select(
        F.when(F.col("id") != 7, F.col("id")).alias("id"), F.lit("x").alias("name"), F.when(F.col("id") % 5 == 0, "license").otherwise("###").alias("description"),
        F.lit(None).cast("array<string>").alias("github_topics"), F.lit(False).alias("is_fork"), F.lit(False).alias("is_archived"), F.lit(None).cast("string").alias("readme_content"),
    )
    rules = QualifyRules(hard_descriptions=("license",)), QualifyRules(hard_descriptions=("license", "###"))
    got = {r["old_status"]: (r["n"], r["ids"]) for r in rule_changes(texts.repartition(7), *rules, "id").collect()}
    moved = [i for i in range(-5000, 20_000) if i % 5 and i != 7]
    assert got["QUALIFIED_TOOL"] == (20_000, ",".join(map(str, moved))) and got["REJECTED_NON_TOOL"][0] == 5000
    nameless = rule_changes(texts.withColumn("id", F.lit(None).cast("long")), *rules, "id").collect()
    assert sorted((r["n"], r["ids"]) for r in nameless) == [(5000, None), (20_000, None)]


def test_collisions_have_all_ids(spark):
    from cataloom.operators.report import host_collisions

    rows = spark.range(3000).select(F.concat(F.lit("tool_"), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 16)).alias("id"), F.lit("a").alias("name"), F.format_string("https://%s.ai/%d", F.when(F.col("id") % 3 == 0, "x").when(F.col("id") < 2999, "y").otherwise("z"), "id").alias("official_url"))
    held = {h: sorted(r["id"] for r in rows.collect() if f"//{h}." in r["official_url"]) for h in "xy"}
    got = {r["domain"]: (r["collision_count"], r["ids"]) for r in host_collisions(rows.repartition(5), id_col="id").collect()}
    assert got == {f"{h}.ai": (len(v), ",".join(v)) for h, v in held.items()}
