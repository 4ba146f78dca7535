import pytest
from pyspark.sql import functions as F

from cataloom.operators.audit import audit
from cataloom.operators.classify import classify
from cataloom.operators.enrich import enrich
from cataloom.operators.gate import validate
from cataloom.operators.grounding import description_flag, grounding_reason
from cataloom.operators.qualify import qualify
from cataloom.operators.verify import choose_logo, verify_website

Q, V, R = "QUALIFIED_TOOL", "REVIEW_REQUIRED", "REJECTED_NON_TOOL"
REPOSITORIES = [
    ("awesome-ai-tools", "Finding the AI tools you need!", ["ai-tools"], False, False, R),
    ("awesome-claude-code-subagents", "Collection of subagents", ["awesome"], False, False, R),
    ("pentest-reports", "Collection of penetration test reports", ["security"], False, False, R),
    ("agent-course-materials", "Course materials for AI agents", ["course"], False, False, R),
    ("llm-interview-questions", "Interview questions for LLMs", ["interview"], False, False, R),
    ("MakeMoneyWithAI", "A list of open-source AI projects", ["mcp", "ai-agent"], False, False, R),
    ("curated-mcp-list", "A list of MCP servers", ["mcp"], False, False, V),
    ("awesome-templates-repo", "Templates for tools", ["mcp", "templates"], False, False, V),
    ("agent-research-papers", "Papers about AI agents", ["ai-agents", "papers"], False, False, V),
    ("langchain-experiments", "Experiments with LangChain", ["ai-agents"], False, False, V),
    ("aihub", "All-in-one Kotlin app for AI", ["ai-tools", "mobile"], False, False, Q),
    ("funzzy", "Lightweight watcher CLI tool", ["cli", "rust"], False, False, Q),
    ("vLLM", "High-throughput and memory-efficient LLM serving engine", ["inference", "developer-tools"], False, False, Q),
    ("my-ai-tool", "A useful AI tool for developers", ["ai-tool", "developer-tools"], False, True, V),
    ("ai-resources", "SDK for managing AI resources in production", ["sdk", "developer-tools", "api"], False, False, Q),
    ("awesome-llm-papers", "Research papers on large language models", [], True, False, R),
    ("neat-cli", None, [], False, False, V), ("some-resources", "A utility library", None, None, None, Q),
    ("x-template", "A plain starter", [], False, False, Q), ("x-template", "A plain starter", [], True, False, V),
]


def test_qualification(spark):
    rows = [(i, *r[:5], None) for i, r in enumerate(REPOSITORIES)]
    data = spark.createDataFrame(rows, "i int, name string, description string, github_topics array<string>, is_fork boolean, is_archived boolean, readme_content string")
    got = [r[0] for r in qualify(data).orderBy("i").select("qualification_status").collect()]
    assert got == [r[5] for r in REPOSITORIES]


@pytest.mark.parametrize("links, solid, expected", [(31, 1000, R), (30, 1000, Q), (31, 2900, Q)])
def test_link_collection(spark, links, solid, expected):
    readme = "](http" * links + "x" * (solid - 6 * links)
    data = spark.createDataFrame([("a", "some tool", [], False, False, readme)], "name string, description string, github_topics array<string>, is_fork boolean, is_archived boolean, readme_content string")
    assert qualify(data).first()["qualification_status"] == expected


def test_classification(spark):
    rows = [
        (0, [], ["mcp", "mcp-server", "llm"], "MCP server for AI assistant integration", "t", None),
        (1, [], [], "A text-to-image generation model using stable diffusion", "t", None),
        (2, [], [], "A useful utility", "myutil", None),
        (3, ["InvalidCategoryName"], ["mcp"], "MCP tool", "t", None),
        (4, [], ["agents"], "Code execution for AI agents", "Judge0", None),
        (5, [], ["llm"], "An AI prompt optimizer for models", "po", None),
        (6, ["Audio", "Audio"], ["mcp"], "x", "y", "CURATED_SEED"),
        (7, ["Agents", "Agents"], None, "code execution", "y", None),
    ]
    data = spark.createDataFrame(rows, "i int, categories array<string>, github_topics array<string>, description string, name string, discovery_source_type string")
    got = {r["i"]: r["categories"] for r in classify(data).collect()}
    assert got[0] == ["MCP", "Models"] and got[1] == ["Image Generation"] and got[2] == ["Developer Tools"] and got[3] == ["MCP"]
    assert got[4] == ["Coding"] and got[5] == ["Productivity"] and got[6] == ["Audio", "Audio"] and got[7] == ["Agents", "Coding"]


VALID = dict(
    qualification_status=None, name="Tool", official_url="https://t.ai", url="https://t.ai", github_repo_url=None, source_name="s", source_url="https://s", source_type="API",
    source_trust_level="HIGH", description="A tool that does useful things for people", description_grounded=True, categories=["Agents"], verification_status="ACCESSIBLE_VERIFIED",
    http_status=200, official_domain_match=True, logo_verified=True, discovery_source_url=None,
)
GATE_SCHEMA = (
    "qualification_status string, name string, official_url string, url string, github_repo_url string, source_name string, source_url string, source_type string, source_trust_level string, "
    "description string, description_grounded boolean, categories array<string>, verification_status string, http_status int, official_domain_match boolean, logo_verified boolean, discovery_source_url string"
)


@pytest.mark.parametrize("change, reason, score", [
    ({}, None, 0.8), ({"logo_verified": False}, None, 0.7), ({"qualification_status": "QUALIFIED_TOOL"}, None, 1.0), ({"official_url": None}, None, 0.65),
    ({"qualification_status": "REVIEW_REQUIRED"}, "Qualification: REVIEW_REQUIRED", None), ({"name": "x"}, "Invalid or missing tool name", None),
    ({"official_url": "ftp://x"}, "Invalid or missing canonical URL", None), ({"source_name": None}, "Missing discovery provenance", None),
    ({"discovery_source_url": "ftp://x"}, "Malformed external discovery URL: ftp://x", None), ({"description": "short"}, "Description missing or too short", None),
    ({"description_grounded": False}, "Description is not grounded", None), ({"verification_status": "ACCESS_BLOCKED", "http_status": 403}, None, 0.5),
    ({"verification_status": "ACCESS_BLOCKED", "http_status": 403, "source_trust_level": "MEDIUM"}, "insufficient source trust", None),
    ({"verification_status": "IDENTITY_MISMATCH"}, "Identity Verification Failed", None), ({"categories": []}, "No taxonomy categories", None),
])
def test_gate(spark, change, reason, score):
    row = VALID | change
    names = [c.strip().split(" ")[0] for c in GATE_SCHEMA.split(", ")]
    data = spark.createDataFrame([tuple(row[n] for n in names)], GATE_SCHEMA)
    none = F.lit(None).cast("string")
    data = data.withColumns({c: none for c in ("discovery_source_name", "discovery_source_type", "discovery_source_trust_level", "description_source_url", "external_evidence_url", "verification_reason")})
    data = data.withColumns({"qualification_reasons": F.array().cast("array<string>"), "evidence_sources": F.array().cast("array<struct<trust_level:string>>"), "github_repository_verified": F.lit(False)})
    got = validate(data).first()
    assert (got["gate_reason"] is None) == (reason is None) and (reason or "") in (got["gate_reason"] or "")
    assert got["quality_score"] == score


def test_descriptions(spark):
    rows = [
        ("AutoBot is an innovative AI tool for better productivity.", "GENERIC"), ("AutoBot is a tool that helps users use AI.", "TAUTOLOGICAL"), ("runs anywhere on the web", "LOW_INFORMATION"),
        ("A revolutionary and game-changing thing for all", "MARKETING_LANGUAGE"), ("Parses log files and plots their error rates", "VALID"), (None, "LOW_INFORMATION"), ("  ", "LOW_INFORMATION"),
    ]
    data = spark.createDataFrame(rows, "d string, e string")
    assert all(r["f"] == r["e"] for r in data.withColumn("f", description_flag(F.col("d"))).collect())


def test_grounding(spark):
    rows = [
        ("", True, [], "", "EMPTY_DESCRIPTION"), ("too short", True, [], "", "DESCRIPTION_TOO_SHORT"), ("x" * 351, True, [], "", "DESCRIPTION_EXCEEDS_LENGTH_LIMIT"),
        ("One one. Two two. Three. Four.", True, [], "", "DESCRIPTION_EXCEEDS_SENTENCE_LIMIT"), ("A fine description", False, [], "", "MODEL_UNGROUNDED_FLAG"),
        ("A fine description", True, ["https://b"], "", "UNCITED_SOURCE_URL: https://b not in evidence package"), ("Costs $20 per seat and year", True, ["https://a"], "", "UNSUPPORTED_PRICING_CLAIM"),
        ("Costs $20 per seat and year", True, [""], "from $5", "VALID_GROUNDED"), ("Used by 5,000 users today", True, [], "", "UNSUPPORTED_METRIC_CLAIM"),
        ("A firm founded in 1999 by two", True, None, "", "UNSUPPORTED_COMPANY_CLAIM"),
    ]
    data = spark.createDataFrame(rows, "d string, g boolean, c array<string>, t string, e string")
    got = data.withColumn("r", grounding_reason(F.col("d"), F.col("g"), F.col("c"), F.array(F.lit("https://a")), F.col("t"))).collect()
    assert [r["r"][: len(r["e"])] for r in got] == [r["e"] for r in got]


def test_website_and_logo(spark):
    rows = [
        (0, "https://a.ai", "Fancy", 200, "https://a.ai/", None, "Fancy home", "ACCESSIBLE_VERIFIED"), (1, "https://a.ai", "Fancy", 200, "https://a.ai/", None, "Other", "IDENTITY_MISMATCH"),
        (2, "https://a.ai", "ab", 200, "https://b.ai/", None, "Other", "ACCESSIBLE_VERIFIED"), (3, "https://a.ai", "Fancy", 429, None, None, None, "ACCESS_BLOCKED"),
        (4, "https://a.ai", "Fancy", 503, None, None, None, "SERVER_ERROR"), (5, "https://a.ai", "Fancy", 410, None, None, None, "NOT_FOUND"),
        (6, "https://a.ai", "Fancy", None, None, "timeout", None, "TIMEOUT"), (7, "https://a.ai", "Fancy", None, None, "dns", None, "DNS_FAILURE"),
        (8, "https://a.ai", "Fancy", None, None, None, None, "UNKNOWN"), (9, "", "Fancy", None, None, None, None, "NOT_FOUND"),
    ]
    data = spark.createDataFrame(rows, "i int, url string, name string, http_status int, final_url string, error_kind string, title string, e string").withColumns({
        "source_url": F.lit("https://www.a.ai/x"), "source_name": F.lit("s"), "meta_description": F.lit(None).cast("string"), "official_url": F.when(F.col("i") != 2, F.col("url")),
        "logo_url": F.lit("https://a.ai/l.png"), "logo_source": F.lit("og:image"),
    })
    got = {r["i"]: r for r in choose_logo(verify_website(data)).collect()}
    assert [got[i]["verification_status"] for i in range(10)] == [r[7] for r in rows]
    assert got[0]["official_domain_match"] and not got[9]["official_domain_match"] and got[2]["redirect_verified"]
    assert got[0]["logo_verified"] and got[2]["logo_source"] == "github_social_preview" and not got[2]["logo_verified"]
    assert got[3]["logo_access_blocked"] and got[3]["logo_url"] is None
    assert [e["type"] for e in got[2]["verification_evidence"]] == ["DOMAIN_MATCH", "REDIRECT", "PAGE_TITLE"]


def test_audit(spark):
    rows = [
        ("a", "Fine", "A long enough description", ["Agents"], "https://a.ai", None, True, "favicon", True, "PASS"),
        ("b", "Fine", "About this course and more", ["Agents"], "https://a.ai", None, True, "favicon", True, "REJECT"),
        ("c", "Fine", "A long enough description", ["Agents"], None, None, False, None, False, "REVIEW_REQUIRED"),
        ("d", "Judge0", "A long enough description", ["Agents"], "https://a.ai", None, True, None, False, "CORRECTED"),
        ("e", "Fine", "A long enough description", ["Agents"], None, "https://github.com/x", True, "github_social_preview", True, "CORRECTED"),
        ("f", "Fine", None, [], "https://a.ai", None, True, None, False, "REVIEW_REQUIRED"),
    ]
    data = spark.createDataFrame(rows, "id string, name string, description string, categories array<string>, official_url string, github_repo_url string, website_verified boolean, logo_source string, logo_verified boolean, e string")
    got = {r["record_id"]: r for r in audit(data).collect()}
    assert {k: r["overall_audit_status"] for k, r in got.items()} == {r[0]: r[9] for r in rows}
    assert len(got["e"]["issues"]) == 2


def test_fallback_descriptions(spark):
    readme = "# T\nThis project parses logs and draws plots."
    rows = [
        (0, "A description that is long enough", None, None, "GITHUB_REPOSITORY_DESCRIPTION"), (1, None, readme, None, "GITHUB_README"), (2, "runs anywhere. uses anything at all", readme, None, "GITHUB_README"),
        (3, None, "# only a title", None, None), (4, "x", None, "'Meta text'", "OFFICIAL_WEBSITE"),
    ]
    data = spark.createDataFrame(rows, "i int, description string, readme_content string, meta_description string, e string").withColumns({
        c: F.lit(None).cast("string") for c in ("external_evidence_url", "readme_url", "discovery_source_type", "discovery_source_url", "source_type", "source_url", "official_url", "url")
    } | {"github_repo_url": F.lit("https://github.com/a/b")})
    got = {r["i"]: r for r in enrich(data).collect()}
    assert [got[i]["description_source_type"] for i in range(5)] == [r[4] for r in rows]
    assert got[3]["description"] is None and not got[3]["description_grounded"] and got[4]["description"] == "Meta text"
