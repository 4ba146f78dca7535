import hashlib
from urllib.parse import parse_qs, urlencode, urlparse, urlunparse

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cataloom.functions import identity, similarity, text, url
from cataloom.functions.html import head
from cataloom.functions.lexicon import TRACKING_PARAMETERS


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.select("i", f(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def expected_url(u):
    """The rule once more, on the standard library."""
    u = (u or "").strip()
    if not u or u.lower().startswith("internal://"):
        return u
    p = urlparse(u if u.lower().startswith(("http://", "https://")) else "https://" + u)
    host = p.netloc.lower()
    default = {"http": ":80", "https": ":443"}[p.scheme]
    host = host.removesuffix(default).removeprefix("www.")
    kept = {k: v for k, v in parse_qs(p.query).items() if k.lower() not in TRACKING_PARAMETERS}
    return urlunparse((p.scheme, host, p.path.rstrip("/"), p.params, urlencode(kept, doseq=True), ""))


URLS = [
    None, "", "internal://x", "HTTPS://WWW.Example.com/product/page/?utm_source=twitter&utm_medium=social&ref=123#pricing", "example.com",
    "http://a.b:80/x//", "https://a.b:443", "http://a.b:443/", "https://a.b/p;q=1", "https://a.b/p;q/", "https://a.b/?b=2&a=1&b=3", "https://a.b/?x=&y=1&z",
    "https://User:Pw@a.b/", "https://a.b/?q=%zz+%41&r=~*", "https://a.b/?q=caf%C3%A9&n=a%20b", "ftp://x", "https://a.b?UTM_Source=1&k=v#f", " https://a.b/c ",
    "https://a.b/%7Ex/?s=a/b", "https://www.www.x.y/", "https://a.b/?a=1&&b=2&=3",
]


def test_normalize_url(spark):
    assert column(spark, URLS, url.normalize_url) == [expected_url(u) for u in URLS]


def test_normalize_url_is_idempotent(spark):
    once = column(spark, [u for u in URLS if "www.www" not in (u or "")], url.normalize_url)  # only one www. goes
    assert column(spark, once, url.normalize_url) == once


def test_domains(spark):
    values = [None, "", "https://sub.domain.openai.com/v1/models", "HTTP://WWW.A.B:80/x", "a.b/c"]
    assert column(spark, values, url.extract_domain) == [None, None, "sub.domain.openai.com", "a.b", "a.b"]
    assert column(spark, ["https://www.A.b:8080/x", "a.b:1/c", None, "x.y/z"], url.audit_domain) == ["a.b", "1/c", "", "x.y/z"]


def test_canonical_name(spark):
    values = ["Acme Inc.", " ACME LTD ", "x llc. corp", "Plain", None, "a inc. inc"]
    assert column(spark, values, text.canonical_name) == ["acme", "acme", "x llc.", "plain", "", "a inc."]


def test_pricing(spark):
    assert column(spark, ["FREE", " open-source ", "Custom ", "", None], text.pricing_model) == ["Free", "Open Source", "Custom", None, None]


def test_clean_text(spark):
    values = ["a\r\nb\tc  d", "ﬁne x", "<p>Hi <b>you</b></p><script>no</script>", "", None, "\x00\x01", "a < b"]
    assert column(spark, values, text.clean_text) == ["a b c d", "fine x", "Hi you", None, None, None, "a < b"]


def test_readme(spark):
    readme = "# Title\n[![b](x)](y)\nSome [link](http://x) with *stars*\n---\nand more text here"
    assert column(spark, [readme], text.clean_readme) == ["Some link with stars and more text here"]
    assert column(spark, ["x" * 300, "short", "y" * 20], text.readme_description) == ["x" * 247 + "...", None, "y" * 20]
    assert column(spark, ["x" * 6000, "  ", "ok"], text.truncated_readme) == ["x" * 5000 + "\n...[truncated]", None, "ok"]


def test_small_texts(spark):
    assert column(spark, ["'a'", '"b', "c"], text.unquoted) == ["a", "b", "c"]
    assert column(spark, ["A. B! C?", "", "..."], text.sentence_count) == [3, 0, 0]
    assert column(spark, ["x ```json\n{\"a\": 1}\n``` y", "z {b} {c} w", "none"], text.json_object) == ['{"a": 1}', "{b} {c}", None]
    assert column(spark, ["http://https://a.b", "x"], text.single_scheme) == ["https://a.b", "x"]


def test_ids(spark):
    rows = spark.createDataFrame([("openai.com", "ChatGPT"), (None, " chatgpt "), ("", "ChatGPT")], "d string, n string")
    got = [r[0] for r in rows.select(identity.tool_id(F.col("d"), F.col("n"))).collect()]
    want = ["tool_" + hashlib.sha256(k).hexdigest()[:16] for k in (b"openai.com:chatgpt", b"chatgpt", b"chatgpt")]
    assert got == want


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for c in a:
        last = row[:]
        for j, e in enumerate(b, 1):
            row[j] = last[j - 1] + 1 if c == e else max(last[j], row[j - 1])
    return row[-1]


@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_subsequence_length(a, b):
    assert similarity.subsequence_length(a, b) == lcs(a, b)


def test_native_ratio_agrees(spark):
    pairs = [("kitten", "sitting"), ("", ""), ("a", ""), ("b a", "a b"), ("data studio", "studio data pro")]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").orderBy("i")
    got = [r[0] for r in rows.select(similarity.token_sort_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([similarity.token_sort_ratio_of(*p) for p in pairs])


def test_head():
    page = "<title> T </title><meta property='og:description' content=' d '><link rel='Shortcut Icon' href='i.ico'>"
    assert head(page, "https://a.b/c/") == ("T", "d", "https://a.b/c/i.ico", "favicon")
    assert head("<meta name='og:image' content='/p.png'>", "https://a.b/c") == ("", "", "https://a.b/p.png", "og:image")
    assert head("", "https://a.b/c") == ("", "", "https://a.b/favicon.ico", "favicon_fallback")


def test_a_reference_that_is_cut_stays_as_it_is(spark):
    values = ["<p>a &amp b&am</p>", "<p>a &amp;amp; &amp;lt;b &quot</p>", "<b>&notit; &copy; &#38; &#x26; &</b>", "<p>&amp"]
    assert column(spark, values, text.clean_text) == ["a &amp b&am", "a &amp; &lt;b &quot", "&notit; © & & &", "&amp"]


def test_references_in_heads():
    assert head("<title>a &amp b &quot;c&quot; &amp;lt;</title>", "https://a.b/")[0] == 'a &amp b "c" &lt;'
    page = "<title>a &amp b &quot;c&quot; &amp;lt;</title><meta name='description' content='d &amp; e'>"
    assert head(page, "https://a.b/", ("amp",))[:2] == ("a &amp b &quot;c&quot; &lt;", "d & e")
