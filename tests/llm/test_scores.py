import hashlib
import random
import re

import numpy as np
import pytest

from cataloom.llm import ann, pseudo_likelihood, quality, secrets, topk, toxicity

SMALL = "/root/testdata/sf0.01"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
SECRETS = [
    "", None, "password=token:abcdefghijklmnop", "é🙂 secret = 'AKIA" + "A1B2" * 6 + "' x", "deadbeef" * 3 + " Token: q9Zx7Lm2Vb4Nc8Rt1Ky6Wp3", "Zx81kQ0vLm3P9sT7uWy2Bn5c and " * 300,
    "api_key: short, passwd==" + "x" * 12, "AKIA" * 5 + "!", "123e4567-e89b-12d3-a456-426614174000", "example_key_A1b2C3d4E5f6G7h8I9j0", "a_plain_long_name_with_marks_only", "f" * 15 + " " + "0" * 16,
]


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16])


def test_secrets(spark):
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(SECRETS)], "doc_id long, text string, _hex int")
    got = {r["doc_id"]: r for r in secrets.scan_secrets(rows).collect()}
    for i, t in enumerate(SECRETS):
        spans = base_spans(t)
        assert [got[i][k] for k in ("n_assign", "n_access", "n_hex")] == [sum(s[1] == k for s in spans) for k in range(3)]
        written = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
    assert got[5]["n_entropy"] == 300 and got[8]["n_entropy"] == got[9]["n_entropy"] == got[10]["n_entropy"] == 0
    clean = {r["doc_id"]: r["text"] for r in secrets.redact_secrets(rows).collect()}
    assert clean[5] == "[SECRET] and " * 300 and clean[1] is None and clean[10] == SECRETS[10] and "AKIA" not in clean[3]


def entropy_spans(text):
    """The spans that the method adds, by their definition."""
    base, out = base_spans(text), []
    for m in re.finditer("[A-Za-z0-9+/=_-]{20,}", text or ""):
        c = m[0]
        if not (re.search("[0-9]", c) and re.search("[A-Za-z]", c)):
            continue
        if re.search("example|sample|placeholder|dummy|changeme|0123456789|123456789|abcdefghij|qwertyuiop", c, re.I):
            continue
        if re.fullmatch("[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", c):
            continue
        if re.fullmatch("[A-Z]?[a-z]*(?:[-_/=+][A-Z]?[a-z]*|[-_/=+][0-9]{1,4})*", c):
            continue
        w, bits = (16, 3.0) if re.fullmatch("[0-9A-Fa-f]+", c) else (20, 3.75) if re.fullmatch("[A-Za-z0-9]+", c) else (20, 3.85)
        best = max(-sum(k / w * np.log2(k / w) for k in map(c[i : i + w].count, set(c[i : i + w]))) for i in range(len(c) - w + 1))
        if best >= bits - 1e-12 and not any(a <= m.start() and e >= m.end() for a, _, e in base):
            out.append((m.start(), 3, m.end()))
    return out


def test_spans_and_redaction_against_brute_force(spark):
    rng = random.Random(12)
    parts = ["password", "Token", "api_key", "=", ":", '"', " ", "\n", "é🙂", "AKIA", "ABCD1234EFGH56", "deadbeef01", "0f9e8d7c6b5a4", "Zx81kQ0vLm3P9sT7uWy2", "-", "_", "/a-b", "2024-01", "Word", "example", "aaaaaaaaaa1", "q9Z+x7"]
    texts = SECRETS + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, clean = ({r["doc_id"]: r for r in f(rows).collect()} for f in (secrets.scan_secrets, secrets.redact_secrets))
    added = 0
    for i, t in enumerate(texts):
        spans = sorted(base_spans(t) + (more := entropy_spans(t)))
        added += len(more)
        assert got[i]["spans"] == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans), t
        merged = []
        for a, _, b in spans:
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        want = t
        for a, b in reversed(merged):
            want = want[:a] + "[SECRET]" + want[b:]
        assert clean[i]["text"] == want
    assert added > 100


def test_long_runs_of_every_character(spark):
    """Runs of a million characters: no pattern may recurse, and the JVM lives on."""
    n, marks = 1_000_000, "+/=_-.:'\" "
    texts = [c * n for c in marks + "aZ0f"] + [f"x {c * n}v2 y" for c in marks] + ["-1" * (n // 2), "=a" * (n // 2), "_A" * (n // 2) + "7", "token" + " " * n + "=", "token=" + "a" * n, "AKIA" + "B" * n, "0f" * (n // 2)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in secrets.scan_secrets(rows).collect()}
    for i, t in enumerate(texts):
        spans = base_spans(t)
        assert [got[i][k] for k in ("n_assign", "n_access", "n_hex")] == [sum(s[1] == k for s in spans) for k in range(3)]
    assert secrets.redact_secrets(rows).where("length(text) > 0").count() == len(texts)


def test_incremental_entropy(spark):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdef0123") for _ in range(n)) for n in (20, 21, 60, 19)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(secrets.most_entropy(F.split("t", ""), 20)).collect()]

    def entropy(w):
        c = np.array([w.count(x) for x in set(w)]) / len(w)
        return float(-(c * np.log2(c)).sum())

    want = [max((entropy(t[i : i + 20]) for i in range(len(t) - 19)), default=None) for t in texts]
    assert got[3] is None and got[:3] == pytest.approx(want[:3])


def labelled(spark, column):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return docs, spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", column)


def test_toxicity(spark):
    docs, labels = labelled(spark, "toxic")
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["toxic"]).mean() >= 0.93 and got.loc[got["toxic"] == 0, "predicted"].mean() <= 0.03
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "x " * 20000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.toxicity(odd, none).collect()] == [0.5] * 4
    assert toxicity.drop_toxic(odd.limit(0), none).count() == 0


def test_quality(spark):
    docs, labels = labelled(spark, "quality")
    got = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() >= 0.9
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "x " * 9000, "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality.quality(odd, none).collect()] == pytest.approx([0.5] * 3)
    assert quality.quality(odd.limit(0), none).count() == 0


def test_quality_views():
    words = [f"w{i}" for i in range(3000)] + [f"w{i}" for i in range(1095)]
    a, b = quality.text_view(" ".join(words)), quality.text_view(" ".join([*words, "w0", "w1"]))
    assert a[quality.BUCKETS] == pytest.approx(3000 / 4095) and b[quality.BUCKETS] == pytest.approx(3000 / 4097)
    half = quality.BUCKETS // 2
    assert (quality.text_view("a" * 100 + "9")[half:-3] != quality.text_view("a" * 100)[half:-3]).any()


def test_logistic_against_plain_steps():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((200, 3))
    y = (x[:, 0] > 0.2).astype(float)
    w, m, v = np.zeros(4), np.zeros(4), np.zeros(4)
    for t in range(1, 251):
        g = np.zeros(4)
        for row, label in zip(np.c_[x, np.ones(200)], y):
            g += (1 / (1 + np.exp(-row @ w)) - label) * row / 200
        g[:3] += 1e-3 * w[:3]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    assert quality.logistic(x, y) == pytest.approx(w, rel=1e-2, abs=1e-2)


def test_co_training_learns_from_rows_without_labels(spark):
    rng = random.Random(8)
    good, bad = [[f"{k}{i}" for i in range(300)] for k in "gb"]
    rows = []
    for i in range(600):
        words = [rng.choice(good if i % 2 else bad) for _ in range(12)]
        rows.append((i, " ".join(words) + ("\n" * (i % 2)), None, "a" if i % 2 else "b", None, "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    got = quality.quality(docs.repartition(7), labels).orderBy("doc_id").collect()
    assert np.mean([r["predicted"] == r["doc_id"] % 2 for r in got]) > 0.95
    again = quality.quality(docs.union(docs).repartition(3), labels).where("doc_id < 20").orderBy("doc_id").collect()
    assert len(again) == 40 and all(a == b for a, b in zip(again[::2], again[1::2]))


def test_ftrl_against_plain_steps():
    rng = np.random.default_rng(3)
    model, z, n = toxicity.Ftrl(40, alpha=0.5, l1=0.3), [0.0] * 41, [0.0] * 41
    for _ in range(200):
        at, label = np.unique(rng.integers(0, 41, 6)), float(rng.integers(0, 2))
        model.learn(at, label)
        w = {}
        for i in at.tolist():
            w[i] = 0.0 if abs(z[i]) <= 0.3 else -(z[i] - np.sign(z[i]) * 0.3) / ((1.0 + n[i] ** 0.5) / 0.5 + 1.0)
        g = 1 / (1 + np.exp(-sum(w.values()))) - label
        for i in at.tolist():
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5
            z[i] += g - sigma * w[i]
            n[i] += g * g
    assert model.z == pytest.approx(np.array(z)) and model.n == pytest.approx(np.array(n))
    assert (model.weights(slice(None)) == 0).any()


def small_network():
    rng = np.random.default_rng(4)
    counts = np.zeros(pseudo_likelihood.BUCKETS, dtype=np.int64)
    counts[:90] = rng.integers(1, 50, 90)
    voc = pseudo_likelihood.Vocabulary.of_counts(counts)
    net = pseudo_likelihood.Network(voc.rows)
    net.out *= 8
    net.table *= 8
    return rng, counts, voc, net


def test_probabilities_against_the_formula():
    rng, counts, voc, net = small_network()
    texts = [rng.integers(0, 90, n).astype("<i4") for n in (7, 0, 1, 30)]
    drawn = voc.draw((np.arange(16) + 0.5) / 16)
    flat, padded, places, lengths = pseudo_likelihood.laid_out(texts, voc)
    got = np.split(net.log_probabilities(padded, places, voc.share[flat], drawn), np.cumsum(lengths)[:-1])
    for text, each in zip(texts, got):
        for i, w in enumerate(text):
            h = np.zeros(pseudo_likelihood.HIDDEN)
            for k, o in enumerate(pseudo_likelihood.OFFSETS):
                row = voc.of[text[i + o]] if 0 <= i + o < len(text) else voc.rows
                h += net.table[k * (voc.rows + 1) + row]
            h, p = np.tanh(h), counts[w] / counts.sum()
            own = p * np.exp(h @ net.out[voc.of[w]])
            z = (1 - p) * np.mean([np.exp(h @ net.out[x]) for x in drawn]) + own
            assert each[i] == pytest.approx(np.log(own / z), rel=1e-4)


def test_gradients_against_differences():
    rng, _, voc, net = small_network()
    text = rng.integers(0, 90, 12).astype("<i4")
    drawn = voc.draw(rng.random(8))
    flat, padded, places, _ = pseudo_likelihood.laid_out([text], voc)
    share = voc.share[flat]
    net.table, net.out = net.table.astype(np.float64), net.out.astype(np.float64)
    around = net.around(padded, places)
    into, up, down = net.steps(around, padded[places + pseudo_likelihood.SIDE], share, drawn)
    table, out = np.zeros_like(net.table), np.zeros_like(net.out)
    np.add.at(table, around.ravel(), np.repeat(into, len(pseudo_likelihood.OFFSETS), axis=0))
    np.add.at(out, np.concatenate([padded[places + pseudo_likelihood.SIDE], drawn]), np.concatenate([up, down]))
    for weights, gradient in ((net.table, table), (net.out, out)):
        for i in rng.choice(np.flatnonzero(np.abs(gradient).sum(axis=1) > 0), 6):
            def total(step):
                weights[i, 3] += step
                made = net.log_probabilities(padded, places, share, drawn).sum()
                weights[i, 3] -= step
                return made

            assert (total(1e-5) - total(-1e-5)) / 2e-5 == pytest.approx(gradient[i, 3], rel=1e-3, abs=1e-5)


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "SHARD_DOCS", 20)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 40))), "x") for i in range(60)] + [(None, "a b", "x"), (7, "a b", "x"), (7, "a b", "x"), (99, "long " * 120000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string")
    found = [sorted(tuple(r) for r in pseudo_likelihood.pseudo_log_likelihood(docs.repartition(n)).collect() if r["doc_id"] is not None) for n in (2, 16)]
    assert len(found[0]) == 63
    for a, b in zip(*found):
        assert a == pytest.approx(b, abs=1e-4)


def test_pseudo_likelihood(spark):
    rng = random.Random(5)
    orderly = [" ".join(["one", "two", "three", "four"] * 60) for _ in range(30)]
    mixed = [" ".join(rng.choice(["one", "two", "three", "four"]) for _ in range(240)) for _ in range(30)]
    rows = spark.createDataFrame(list(enumerate([*orderly, *mixed, None, ""])), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pseudo_likelihood.pseudo_log_likelihood(rows).collect()}
    assert len(got) == 62 and got[60]["n_words"] == 0 and got[60]["per_word"] is None and got[60]["log_likelihood"] == 0
    assert np.mean([got[i]["per_word"] for i in range(30)]) > np.mean([got[i]["per_word"] for i in range(30, 60)])
    assert pseudo_likelihood.pseudo_log_likelihood(rows.limit(0)).count() == 0


def vectors(spark, n=400, dims=8, seed=6):
    rng = np.random.default_rng(seed)
    v = np.round(rng.standard_normal((n, dims)), 1)
    v[50:120] = v[0]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(n, None), (n + 1, [None] * dims), (n + 2, [float("nan")] * dims), (n + 3, [0.0] * dims), (None, [1.0] * dims), (n + 4, [])]
    return v, spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")


def ordered(scores, ids, own, k):
    return [int(i) for i in ids[np.lexsort((ids, -scores))] if i != own][:k]


def test_exact_topk(spark):
    v, rows = vectors(spark)
    x = np.floor(256 * np.append(v.astype(np.float32), np.zeros((1, 8), dtype=np.float32), axis=0).astype(np.float64)).astype(np.int64)
    ids = np.append(np.arange(400), 403)
    found = {}
    for r in sorted(topk.top_inner_products(rows).collect(), key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert found == {q: ordered(x @ x[q], ids, q, 5) for q in range(0, 400, 50)}
    assert topk.top_inner_products(rows.limit(0)).count() == 0


@pytest.mark.parametrize("search", [topk.top_inner_products, ann.nearest])
def test_repeated_ids_and_other_lengths(spark, search):
    rows = [(0, [1.0, 1.0])] * 3 + [(0, [2.0, 0.5]), (1, [1.0, 1.0]), (1, [5.0, 5.0]), (1, [5.0, 5.0]), (2, [1.0]), (3, [1.0, 2.0, 3.0]), (100, [3.0])]
    made = spark.createDataFrame([(i, v, -1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = sorted(tuple(r) for r in search(made, 100, 3).collect())
    scale = 256 * 256 if search is topk.top_inner_products else 1
    assert got == [(0, 1, 1, 12.5 * scale), (0, 2, 1, 12.5 * scale), (0, 3, 1, 10.0 * scale), (100, 1, 2, 3.0 * scale)]


def test_sorted_lists_are_exact():
    rng = np.random.default_rng(7)
    for scale in (1, 1 << 20, 1 << 27):
        for _ in range(100):
            x, k = scale * rng.integers(-3, 4, (rng.integers(1, 60), rng.integers(1, 5))), int(rng.integers(1, 6))
            queries, lists = rng.integers(-2, 3, (5, x.shape[1])) * scale, topk.SortedLists(x)
            out = np.array([0, 2]), np.array([0, len(x) - 1])
            found = {q: (p, s) for q, p, s in lists.top(queries, np.full(5, -topk.NONE), k, out)}
            for q, (places, scores) in found.items():
                mine = np.setdiff1d(np.arange(len(x)), out[1][out[0] == q])
                want = sorted((x @ queries[q])[mine])[::-1][:k]
                assert sorted(scores)[::-1][:k] == want
                assert not want or set(mine[(x @ queries[q])[mine] >= want[-1]]) <= set(places.tolist())
            assert len(found) == 5 and lists.read <= lists.asked


def test_lists_are_left_early():
    rng = np.random.default_rng(8)
    x = (256 * rng.standard_normal((4096, 4)) * [200, 5, 2, 1]).astype(np.int64)
    lists = topk.SortedLists(x)
    assert len(list(lists.top(x[::64], np.full(64, -topk.NONE), 5))) == 64 and lists.read < 0.5 * lists.asked


def test_learned_partitions(spark):
    v, rows = vectors(spark, 1200, 8)
    v = v.astype(np.float32).astype(np.float64)
    ids = np.flatnonzero((v != 0).any(axis=1))
    hits = total = 0
    found = {}
    for r in sorted(ann.nearest(rows).collect(), key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["score"] == pytest.approx(v[r["query_id"]] @ v[r["vec_id"]])
    for q in range(0, 1200, 20):
        want = ordered(v[ids] @ v[q], ids, q, 20)
        hits, total = hits + len(set(want) & set(found[q])), total + len(want)
    assert hits / total >= 0.9
    assert ann.nearest(rows.limit(0)).count() == 0


def test_partitions_visited():
    rng = np.random.default_rng(9)
    x = rng.standard_normal((4000, 6)) + 3 * rng.standard_normal((40, 6)).repeat(100, axis=0)
    x = x[rng.permutation(len(x))]
    router, visits = ann.fit_index(x, len(x), 20)
    home = np.bincount(router.logits(x).argmax(axis=1), minlength=ann.partitions_for(len(x)))
    visited = np.argsort(-router.logits(x[::20]), axis=1)[:, :visits]
    assert ann.partitions_for(4000) == 64 and home[visited].sum(axis=1).mean() < 0.5 * len(x)


def test_balanced_cut():
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.standard_normal((100, 6)) + 4 * c for c in np.eye(6)[:4]])
    parts = ann.balanced_partitions(ann.neighbour_graph(x), 4)
    assert np.bincount(parts, minlength=4).max() <= 110


def test_rows_are_added_in_their_stable_order():
    rng = np.random.default_rng(3)
    for most in (5, 70_000, 1 << 31):
        at = rng.integers(0, most, 3000)
        assert (pseudo_likelihood._order(at) == np.argsort(at, kind="stable")).all()
    at, steps = rng.integers(0, 40, 400), rng.standard_normal((100, pseudo_likelihood.HIDDEN)).astype(np.float32)
    made = []
    for s in (steps, np.repeat(steps, 4, axis=0)):
        table, squares = np.zeros((40, pseudo_likelihood.HIDDEN), np.float32), np.zeros(40, np.float32)
        pseudo_likelihood._add_by_row(table, squares, at, s, 0.1)
        made.append((table, squares))
    assert all((a == b).all() for a, b in zip(*made)) and made[0][0].any()
