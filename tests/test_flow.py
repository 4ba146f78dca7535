import random
import time

import pytest
from pyspark.sql import functions as F

from cataloom.functions.similarity import ratio_of, token_sort_ratio_of
from cataloom.operators.integrity import file_facts, read_back_differences, verify_manifest
from cataloom.operators.resolve import fuzzy_names, resolve
from cataloom.operators.scratch import Scratch
from cataloom.plans.catalogue import expansion, ingest
from cataloom.queries import candidates
from cataloom.sources import files, search, sinks
from cataloom.streaming.ingest import ingest as stream_ingest
from cataloom.streaming.ingest import stored

SMALL = "/root/testdata/sf0.001"
SCHEMA = "ordinal long, id string, domain string, canonical_name string, company_name string, github_repo_url string"


def sequential(rows):
    """Resolution as it is defined, one record after the other."""
    kept, out = [], {}
    for o, i, dom, name, company, repo in rows:
        def last(test):
            return next((k for k in reversed(kept) if test(k)), None)

        hit = last(lambda k: k[1] == i)
        method = "exact_stable_id" if hit else None
        if not hit and repo and (hit := last(lambda k: k[5] == repo)):
            method = "github_repo_url_match"
        if not hit and dom and (k := last(lambda k: k[2] == dom)):
            if token_sort_ratio_of(name, k[3]) >= 70 or name in k[3] or k[3] in name:
                hit, method = k, "domain_identity_match"
        if not hit and name and (hit := last(lambda k: k[3] == name)):
            method = "canonical_name_exact_match"
        if not hit:
            for k in kept:
                if name and k[3] and k[3][:3] == name[:3] and (s := token_sort_ratio_of(name, k[3])) >= 88:
                    if s >= 95 or (company and k[4] and ratio_of(company.lower(), k[4].lower()) >= 85):
                        hit, method = k, "rapidfuzz_blocked_candidate"
                        break
        out[o] = (hit[1] if hit else None, method)
        if not hit:
            kept.append((o, i, dom, name, company, repo))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_resolution_is_the_sequential_one(spark, seed):
    rng = random.Random(seed)
    names = ["alpha studio", "alpha studios", "studio alpha", "alpha", "beta tool kit", "beta toolkit", "gamma", "", "alphabet studio", "beta tool kits"]
    rows = []
    for o in range(120):
        rows.append((o, f"t{rng.randint(0, 90)}", rng.choice([None, "a.ai", "b.ai", "github.com"]), rng.choice(names) + rng.choice(["", "", " x", " y"]),
                     rng.choice([None, "Acme", "acme", "Other"]), rng.choice([None, None, f"https://github.com/r{rng.randint(0, 60)}"])))
    shuffled = rows[:]
    rng.shuffle(shuffled)
    got = {r["ordinal"]: (r["duplicate_of"], r["match_method"]) for r in resolve(spark.createDataFrame(shuffled, SCHEMA).repartition(3)).collect()}
    assert got == sequential(rows)


def test_a_thousand_resolutions(spark):
    """A thousand random inputs that share no key, in one table, each against its definition."""
    rng, rows = random.Random(9), []
    words = ["alpha", "alphas", "studio", "tool", "kit", "kits", "ab", "b"]
    for case in range(1000):
        for _ in range(rng.randint(1, 14)):
            name = rng.choice(["", f"{case:03d}"]) and f"{case:03d}" + " ".join(rng.choice(words) for _ in range(rng.randint(1, 3)))
            rows.append((len(rows), f"{case}-{rng.randint(0, 30)}", rng.choice([None, f"a{case}.ai", f"b{case}.ai"]), name, rng.choice([None, "Acme", "Acmee", "Other"]), rng.choice([None, None, None, f"https://github.com/c{case}/r{rng.randint(0, 9)}"])))
    want = {}
    for case in range(1000):
        want |= sequential([r for r in rows if r[1].startswith(f"{case}-")])
    rng.shuffle(rows)
    got = {r["ordinal"]: (r["duplicate_of"], r["match_method"]) for r in resolve(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert got == want and len({m for _, m in got.values()}) == 6


def test_one_host_for_all(spark):
    """No range holds more than a fiftieth of a host that all rows share, and the values are the window's."""
    from cataloom.operators.ranges import with_latest

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        rows = spark.range(20_000).select(F.lit("h").alias("host"), (F.col("id") * 7919 % 20_000).alias("at"), F.col("id").cast("string").alias("v"), (F.col("id") % 3 == 0).alias("good"))
        rows = rows.unionAll(spark.range(5000).select((F.col("id") % 700).cast("string"), F.col("id"), F.lit(None).cast("string"), F.col("id") % 4 > 2))
        for flag in (None, "good"):
            scratch = Scratch(spark, "test")
            got = {(r["host"], r["at"]): (r["before_at"], r["before_v"]) for r in with_latest(rows, "host", "at", ["v"], scratch, "l", flag).collect()}
            seen, want = {}, {}
            for r in sorted(rows.collect(), key=lambda r: (r["host"], r["at"])):
                want[r["host"], r["at"]] = seen.get(r["host"], (None, None))
                if flag is None or r["good"]:
                    seen[r["host"]] = (r["at"], r["v"])
            assert got == want
            sizes = [r["count"] for r in spark.read.parquet(f"{scratch.root}/l").groupBy("_part").count().collect()]
            assert len(sizes) == 100 and max(sizes) <= 500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("seed", range(3))
def test_few_pairs_are_compared(spark, seed):
    """All names in one block: the index loses no pair and compares few of all."""
    from cataloom.operators.similar import candidate_pairs, similar_pairs

    rng = random.Random(seed)
    names = {"the " + "".join(rng.choice("abcdefghij ") for _ in range(rng.randint(0, 24))) for _ in range(400)}
    names |= {n[:i] + rng.choice("xyz") + n[i:] for n in list(names)[:150] for i in (5, len(n))}
    rows = spark.createDataFrame([("the", n) for n in names] + [("the", None), (None, "x"), ("the", ""), ("one", "alone")], "block string, s string")
    for threshold in (88.0, 95.0):
        want = {(a, b) for a in names for b in names if a < b and ratio_of(a, b) >= threshold}
        found = similar_pairs(rows, threshold).collect()
        assert {(r["x"], r["y"]) for r in found} == want and len(found) == len(want)
        assert candidate_pairs(rows.where("block is not null and s is not null").distinct(), threshold).count() < len(names) ** 2 / 40


def test_many_names_meet_under_a_low_threshold(spark):
    """6,000 names in one block, of several parts: all pairs of some of them are there, within a minute."""
    from cataloom.operators.similar import similar_pairs

    rng = random.Random(4)
    names = sorted({" ".join("".join(rng.choice("aeinorstlé") for _ in range(rng.randint(2, 8))) for _ in range(3)) for _ in range(6000)} | {"long " * 30, "long " * 31})
    rows = spark.createDataFrame([("", n) for n in names], "block string, s string")
    start = time.monotonic()
    found = similar_pairs(rows, 65.0).collect()
    assert time.monotonic() - start < 60
    some = set(names[::40]) | {"long " * 30}
    want = {(*sorted((a, b)), ratio_of(a, b)) for a in some for b in names if a != b and ratio_of(a, b) >= 65}
    got = [(r["x"], r["y"], r["score"]) for r in found]
    assert len(set(got)) == len(got) and {g for g in got if g[0] in some or g[1] in some} == want and len(want) > 30


@pytest.mark.parametrize("threshold", [60.0, 88.0, 100.0])
def test_fuzzy_names_lose_no_pair(spark, threshold):
    """Lengths at and around the borders of the classes, blanks alone, and two blocks."""
    rng = random.Random(5)
    names = {"abc" + "x" * n for n in range(40)} | {"   ", "    ", "abc b a", "abc a b", "zzz"}
    names |= {"abc" + "".join(rng.choice("xy ") for _ in range(rng.randint(0, 20))) for _ in range(60)}
    want = {(a, b) for a in names for b in names if a != b and a[:3] == b[:3] and token_sort_ratio_of(a, b) >= threshold}
    rows = spark.createDataFrame([(n,) for n in names], "canonical_name string")
    got = [(r["name"], s["name"]) for r in fuzzy_names(rows, threshold).collect() for s in r["similar"]]
    assert len(got) == len(set(got)) and set(got) == want


def test_baseline_comes_first(spark):
    base = spark.createDataFrame([(7, "b1", None, None, None, "https://github.com/x", "Beta Tool", "https://beta.ai", None)], SCHEMA + ", name string, official_url string, url string")
    new = spark.createDataFrame([(0, "n1", "beta.ai", "beta tools", None, None), (1, "n2", None, "other", None, "https://www.github.com/x/")], SCHEMA)
    got = {r["ordinal"]: r for r in resolve(new, base).collect()}
    assert (got[0]["match_method"], got[0]["is_baseline_match"]) == ("domain_identity_match", True)
    assert got[1]["duplicate_of"] == "b1" and got[1]["match_method"] == "github_repo_url_match"


def test_ingest_run(spark):
    raw = candidates(spark, SMALL)
    pages = raw.select("url", "html", "http_status", "final_url", "error_kind")
    raw = raw.drop("title", "html", "http_status", "final_url", "error_kind")
    run = ingest(raw, pages, "fixture", "2026-01-01 00:00:00", plain=True)
    facts = run.funnel.first()
    assert facts["discovered"] == 50 and facts["qualified"] + facts["review_required"] + facts["rejected"] == 50
    assert facts["accepted"] == run.accepted.count() == run.audit.count()
    assert run.rejected.count() + facts["accepted"] == 50
    fresh, rates = expansion(raw, spark.createDataFrame([], SCHEMA + ", name string, official_url string, url string"), plain=True)
    assert rates.first()["candidates"] == 50 and fresh.count() <= facts["qualified"]


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), ("é", "x|y")], "id string, v string")
    sinks.write_jsonl(rows, str(tmp_path / "r"))
    assert sorted(map(tuple, files.read_jsonl(spark, str(tmp_path / "r"), "id string, v string").collect()), key=str) == sorted([("a", None), ("é", "x|y")], key=str)
    assert files.read_jsonl(spark, str(tmp_path / "none"), "id string").count() == 0
    assert sinks.write_json_array(rows, str(tmp_path / "a.json")) == 2
    assert files.read_json_array(spark, str(tmp_path / "a.json"), "id string, v string", 2).count() == 2
    with pytest.raises(Exception, match="Expected exactly 3"):
        files.read_json_array(spark, str(tmp_path / "a.json"), "id string, v string", 3).count()
    assert sinks.write_csv(rows, str(tmp_path / "c")) and not sinks.write_csv(rows.limit(0), str(tmp_path / "d"), skip_empty=True)
    assert read_back_differences(rows, files.read_csv(spark, str(tmp_path / "c")), "id").count() == 0
    sinks.append_raw(rows, str(tmp_path / "raw"), "src", "2026-01-02 00:00:00")
    assert spark.read.json(str(tmp_path / "raw")).where("source_name = 'src' and ingest_date = 20260102").count() == 2
    sinks.append_rejected(rows.withColumn("why", F.lit("w")), str(tmp_path / "rej"), "why", "Gate", "2026-01-02")
    assert spark.read.json(str(tmp_path / "rej")).count() == 2
    sinks.clear(spark, str(tmp_path / "rej"))
    facts = file_facts(spark, str(tmp_path / "a.json")).withColumn("record_count", F.lit(2))
    assert verify_manifest(facts, facts).first()["status"] == "PASS"
    assert verify_manifest(facts, facts.withColumn("file_sha256", F.lit("0"))).first()["reason"].startswith("File SHA256 mismatch")


def test_scan_goes_on_where_it_stopped(spark, tmp_path):
    from cataloom.sources import scan

    def item(i):
        return (i, f"n{i}", f"https://github.com/o/n{i}", None, ("o", None), ["mcp"], "", i, None, None, None, None)

    pages = spark.createDataFrame([("a", 1, 200, [item(1), item(2)]), ("a", 2, 200, [item(3), item(4)]), ("a", 3, 200, [item(5)]), ("b", 1, 200, [item(6)]), ("b", 2, 500, None)], search.PAGE)
    scan.record(pages, str(tmp_path / "p"))
    settings = scan.json.dumps({"sources": {"github": {"per_page": 2, "max_pages": 3, "queries": [{"query": "topic:mcp stars:>1", "label": "a"}, {"query": "b"}]}}})
    read = scan.scan(spark, str(tmp_path / "p"), settings)
    got = {(r["query"], r["page"]): [i["id"] for i in r["items"] or ()] for r in read.collect()}
    assert got == {("a", 1): [2, 1], ("a", 2): [4, 3], ("a", 3): [5], ("b", 1): [6], ("b", 2): []}
    scan.append_progress(scan.progress(read.where("page < 3 and not (query = 'b' and page = 2)"), "web", 2, 3), str(tmp_path / "d"))
    done = spark.read.parquet(str(tmp_path / "d"))
    assert sorted(map(tuple, scan.latest(done).collect())) == [("web", "a", 2, False), ("web", "b", 1, True)]
    again = scan.scan(spark, str(tmp_path / "p"), settings, done, "web")
    assert sorted((r["query"], r["page"]) for r in again.collect()) == [("a", 2), ("a", 3)]
    assert sorted(map(tuple, scan.to_read(pages.select("query", "page"), done, "web").collect())) == [("a", 2), ("a", 3)]


def test_scan_settings():
    from cataloom.sources import scan

    assert scan.scan_settings(None) == scan.scan_settings("{broken") == scan.scan_settings("[1]") == scan.DEFAULTS
    assert scan.scan_settings('{"sources": {"github": {"per_page": 7}}}') == scan.DEFAULTS | {"per_page": 7}
    assert len(scan.all_slices()) == 25 and len({s["label"] for s in scan.all_slices()}) == 25


@pytest.mark.parametrize("mode, status", [("SUCCESS", "SUCCESS"), ("SIMULATED_429", "RATE_LIMITED"), ("SIMULATED_TIMEOUT", "TIMEOUT"), ("SIMULATED_AUTH_ERROR", "AUTH_ERROR"), ("SIMULATED_MALFORMED", "MALFORMED"), ("SIMULATED_UNGROUNDED", "UNGROUNDED"), ("SIMULATED_UNSUPPORTED_URL", "SUCCESS")])
def test_scripted_providers(spark, mode, status):
    from cataloom.operators.providers import ask, scripted

    none = F.lit(None).cast("string")
    package = F.struct(F.lit("Tool").alias("tool_name"), none.alias("official_website_content"), none.alias("repository_description"), none.alias("readme_excerpt"),
                       F.array().cast("array<string>").alias("topics"), none.alias("company_name"), F.array(F.lit("https://a.example/")).alias("source_urls"))
    packages = spark.range(2).select(F.col("id").cast("string").alias("id"), package.alias("evidence"))
    got = ask(packages, [scripted("one", mode), scripted("two")]).orderBy("id", "provider_rank").collect()
    usable = mode == "SUCCESS"
    assert [r["status"] for r in got] == ([status] * 2 if usable else [status, "SUCCESS"] * 2)
    assert [r["usable"] for r in got] == ([True] * 2 if usable else [False, True] * 2)
    blank = ask(packages, [scripted("one", description=" ")]).first()
    assert blank["status"] == "MALFORMED" and not blank["usable"] and ask(packages, []).count() == 0


def test_quality_report_text(spark):
    from cataloom.operators.report import quality_report
    from cataloom.queries import QUERIES

    text = quality_report(QUERIES["quality_report"](spark, SMALL))
    assert "## Status & Summary\n- **target**: 50" in text and text.count("## ") == 8


def test_recorded_search(spark):
    def item(i):
        return (i, f"n{i}", f"https://github.com/o/n{i}", "https://n.ai" if i % 2 else None, ("o", "https://github.com/o"), None, "", None, None, None, None, None)

    pages = [("q1", 1, 200, [item(1), item(2)]), ("q1", 2, 500, None), ("q1", 3, 200, [item(3)]), ("q1", 4, 200, [item(9)]), ("q2", 1, 200, [item(2), item(4)]), ("q2", 2, 403, None), ("q2", 3, 200, [item(8)])]
    found = search.candidates(spark.createDataFrame(pages, search.PAGE), page_size=2).orderBy("query", "page", "place").collect()
    assert [r["repo_id"] for r in found] == [1, 2, 3, 4]
    assert found[0]["official_url"] == "https://n.ai" and found[1]["url"] == "https://github.com/o/n2" and found[1]["description"] is None and found[1]["github_stars"] is None


def test_stream_resumes(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "ordinal long, id string"
    first = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], schema)
    second = spark.createDataFrame([(3, "b"), (4, "c")], schema)
    first.coalesce(1).write.json(source)
    args = (spark, source, schema, str(tmp_path / "t"), str(tmp_path / "cp"))
    stream_ingest(*args)
    second.coalesce(1).write.mode("append").json(source)
    stream_ingest(*args)
    stream_ingest(*args)
    assert sorted(map(tuple, stored(spark, str(tmp_path / "t"), schema).collect())) == [(0, "a"), (1, "b"), (4, "c")]


def test_known_keys_are_state(spark, tmp_path):
    """A table that is there already, three micro-batches, a restart, and no read of the table after the first."""
    source, table, schema = str(tmp_path / "in"), tmp_path / "t", "ordinal long, id string, v string"
    spark.createDataFrame([(-1, "old", "x")], schema).write.parquet(str(table))
    args = (spark, source, schema, str(table), str(tmp_path / "cp"))
    for k, rows in enumerate(([(0, "a", None), (2, "b", "2"), (1, "b", "1")], [(3, "old", "y"), (4, None, "n")], [(5, "a", "z"), (6, None, "m"), (7, "c", "7")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
        if k == 1:  # what is stored is out of reach, so only the state can know
            table.rename(tmp_path / "away")
        stream_ingest(*args, files_a_batch=1)
    found = stored(spark, str(table), schema).unionAll(stored(spark, str(tmp_path / "away"), schema)).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(-1, "old", "x"), (0, "a", None), (1, "b", "1"), (4, None, "n"), (7, "c", "7")], key=str)
