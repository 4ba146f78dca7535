import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cataloom.llm import recompression as rc
from cataloom.llm import simhash as sh

SCHEMA = "doc_id long, text string, lang string, _row string"


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, "x") for i, t in zip(ids, texts)], SCHEMA)


def components(fps, ids, radius=4):
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= radius and label[i] != label[j]:
                    label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
                    changed = True
    low = {}
    for i, x in enumerate(label):
        if ids[i] is not None:
            low[x] = min(low.get(x, ids[i]), ids[i])
    return [low.get(x) for x in label]


def united(nodes, links):
    label = {x: x for x in nodes}
    for a, b in links:
        p, q = label[a], label[b]
        label = {k: min(p, q) if x in (p, q) else x for k, x in label.items()}
    return label


def corpus(rng, n=40):
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(60, 160))) for _ in range(n)]
    near = []
    for t in base[:10]:
        parts = t.split()
        parts[rng.randrange(len(parts))] = "changed"
        near.append(" ".join(parts))
    return base + near + base[:5] + ["", None, "  ", "one two", "One Two"]


def test_simhash_against_brute_force(spark):
    texts = corpus(random.Random(1))
    ids = [i if i != 3 else None for i in range(len(texts))]
    ids[7] = ids[6]
    got = sh.near_duplicates(table(spark, texts, ids)).collect()
    assert len(got) == len(texts)
    fps = [sh.fingerprint(t.encode() if t is not None else None) for t in texts]
    want = Counter(zip(ids, fps, components(fps, ids)))
    assert Counter((r["doc_id"], r["fingerprint"] & (1 << 64) - 1, r["component_id"]) for r in got) == want
    assert sh.near_duplicates(table(spark, [])).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([(4, 3), (9, 5), (0, 1)]))
def test_shards_lose_no_link(seed, kind):
    radius, blocks = kind
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = [values[i] ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, radius).astype(np.uint64)) if radius else values[i] for i in range(30)]
    values = np.unique(np.concatenate([values, np.array(flips, dtype=np.uint64)]))
    met, links = set(), set()
    for mask in sh.block_masks(blocks):
        tree = sh.fit_tree(values[:40], mask, 3, 5)
        row, leaf = sh.deal(values, *tree, mask, radius // blocks, 3)
        for x in np.unique(leaf):
            own = values[np.sort(row[leaf == x])]
            met |= {(int(a), int(b)) for a in own for b in own}
            rows = pd.DataFrame({"node": own.view(np.int64), "fingerprint": own.view(np.int64), "second": 0, "size": 1})
            a, b = sh.shard_links(rows, mask, sh.Near(radius, blocks), cell=8)
            links |= {(int(p), int(q)) for p, q in zip(a, b)}
    assert all((int(a), int(b)) in met for a in values for b in values if int(a ^ b).bit_count() <= radius)
    fps, signed = [int(x) for x in values], values.view(np.int64).tolist()
    assert united(signed, links) == united(signed, [(signed[i], signed[j]) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= radius])


def test_keep_one(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefghij") * 3 + str(rng.randint(0, 50)) for _ in range(200)) for _ in range(12)]
    near = texts[0] + " and a little more"
    rows = table(spark, [*texts, near, texts[1], texts[1], None, ""], [*range(12), 50, 60, 60, 70, 71])
    kept = sorted(r["doc_id"] for r in sh.keep_one_of_near_duplicates(rows).collect())
    assert kept == [*range(12), 70]
    assert sh.keep_one_of_near_duplicates(rows).columns == rows.columns


def test_keep_one_against_all_pairs(spark):
    rng = random.Random(4)
    texts = []
    for g in range(12):  # groups of texts that share most of their words, so many pairs within the radius fail
        base = [f"g{g}w{rng.randint(0, 999)}" for _ in range(150)]
        for _ in range(25):
            parts = list(base)
            for _ in range(rng.randint(1, 9)):
                parts[rng.randrange(len(parts))] = f"x{rng.randint(0, 99999)}"
            texts.append(" ".join(parts))
    made = [sh.shingle_hashes(t.encode(), 5) for t in texts]
    fps, second = [sh.majority(h) for h in made], [sh.majority(sh._remixed(h)) for h in made]
    label = list(range(len(texts)))
    near = failed = 0
    for i in range(len(texts)):
        for j in range(i):
            bits = (fps[i] ^ fps[j]).bit_count()
            if bits <= 15 and bits + (second[i] ^ second[j]).bit_count() <= 28:
                near += 1
                p, q = shingles(texts[i]), shingles(texts[j])
                if len(p & q) >= 0.8 * len(p | q):
                    p, q = sorted((label[i], label[j]))
                    label = [p if x == q else x for x in label]
                else:
                    failed += 1
    assert failed > 100 and near - failed > 100
    kept = sorted(r["doc_id"] for r in sh.keep_one_of_near_duplicates(table(spark, texts)).collect())
    assert kept == sorted(set(label))


@pytest.mark.parametrize("group_rows", [4096, 20])
def test_similar_links_join_what_all_pairs_join(spark, group_rows):
    rng = np.random.default_rng(3)
    near, rows, sets = sh.Near(15, 8, 28, 0.8), [], []
    for i in range(160):
        base = np.arange(1000 * (i % 4), 1000 * (i % 4) + 60)
        own = np.unique(np.concatenate([rng.permutation(base)[: rng.integers(48, 61)], rng.integers(10**6, 10**7, rng.integers(0, 6))])).astype("<u8")
        hashes = sh._remixed(own * np.uint64(0x9E3779B97F4A7C15))
        values = np.array([sh.majority(hashes), sh.majority(sh._remixed(hashes))], dtype=np.uint64)
        sets.append((set(own.tolist()), values))
        rows.append((i, *values.view(np.int64).tolist(), len(own), bytearray(np.unique(hashes).tobytes()), i % 4))
    table_ = spark.createDataFrame(rows, "node long, fingerprint long, second long, size long, hashes binary, root long")
    got = [(r["u"], r["v"]) for r in sh.similar_links(table_, near, group_rows).collect()]
    links = []
    for i in range(160):
        for j in range(i):
            (p, x), (q, y) = sets[i], sets[j]
            bits = [int(a ^ b).bit_count() for a, b in zip(x, y)]
            if i % 4 == j % 4 and bits[0] <= 15 and sum(bits) <= 28 and len(p & q) >= 0.8 * len(p | q):
                links.append((i, j))
    assert set(map(tuple, map(sorted, got))) <= {(j, i) for i, j in links}
    assert group_rows == 20 or len(got) < len(links) / 2
    assert united(range(160), got) == united(range(160), links)


@pytest.mark.parametrize("similarity", [0.0, 0.8, 0.5])
def test_similar_sizes_meet_in_a_band(similarity):
    sizes = np.arange(1, 300)
    row, band = sh.bands(sizes, similarity)
    of = {}
    for i, x in zip(row.tolist(), band.tolist()):
        of.setdefault(i, set()).add(x)
    assert all(of[i] & of[j] for i in range(299) for j in range(i) if sizes[j] >= similarity * sizes[i])


def shingles(text):
    parts = text.encode().lower().split()
    return {b" ".join(parts[i : i + 5]) for i in range(max(1, len(parts) - 4))}


def similar_pairs(texts, least=0.8):
    """All pairs of at least so similar texts, by the rarest shingles of each (a prefix filter)."""
    sets = [shingles(t) for t in texts]
    seen = Counter(x for s in sets for x in s)
    held, found = {}, []
    for i, s in enumerate(sets):
        rarest = sorted(s, key=lambda x: (seen[x], x))[: len(s) - int(np.ceil(least * len(s) - 1e-9)) + 1]
        for j in {j for x in rarest for j in held.get(x, ())}:
            both = len(s & sets[j])
            if both >= least * (len(s) + len(sets[j]) - both):
                found.append((i, j))
        for x in rarest:
            held.setdefault(x, []).append(i)
    return found


def test_recall_against_all_pairs_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]
    texts = list(dict.fromkeys(t for _, t in rows))
    ids = {}
    for i, t in rows:
        ids.setdefault(t, i)
    kept = {r["doc_id"] for r in sh.keep_one_of_near_duplicates(docs).select("doc_id").collect()}
    pairs = similar_pairs(texts)
    caught = sum(not (ids[texts[i]] in kept and ids[texts[j]] in kept) for i, j in pairs)
    near = {k for pair in pairs for k in pair}
    assert len(pairs) >= 40 and caught >= 0.95 * len(pairs)
    assert all(ids[t] in kept for k, t in enumerate(texts) if k not in near)


def test_texts_of_one_fingerprint_are_compared(spark):
    noise = " ".join(f"n{i}" for i in range(40))
    texts = ["same " * 200 + noise, "same " * 220 + noise.replace("n", "m"), "same " * 200 + noise]
    assert sh.fingerprint(texts[0].encode(), 5) == sh.fingerprint(texts[1].encode(), 5)
    assert sorted(r["doc_id"] for r in sh.keep_one_of_near_duplicates(table(spark, texts)).collect()) == [0, 1]


def test_hubs_and_chains(spark):
    from cataloom.llm.components import connected_components
    from cataloom.llm.scratch import Scratch

    links = [(0, i) for i in range(1, 400)] + [(i, i + 1) for i in range(1000, 1200)] + [(5, 5), (2000, 1999)]
    got = dict(connected_components(spark.createDataFrame(links, "u long, v long"), Scratch(spark, "test")).collect())
    assert got == {**{i: 0 for i in range(400)}, **{i: 1000 for i in range(1000, 1201)}, 1999: 1999, 2000: 1999}


CLASHING = ["own", "own_key", "own_kept", "row", "node", "root", "fingerprint", "size", "made", "digest", "raw", "key", "kept", "found", "score", "a.b"]


def odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(30000))
    texts = [None, "", " ", "one two three", "one two three", long, long + " x", " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(60))]
    rows = [(i if i != 4 else None, t, *(f"{c}{i}" for c in CLASHING)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING))


@pytest.mark.parametrize("stage", ["near", "substrings", "secrets", "toxicity"])
def test_clashing_columns_keep_their_values(spark, stage):
    from cataloom.llm import secrets, toxicity

    rows = odd_rows(spark)
    labels = spark.createDataFrame([(1000, 0)], "doc_id long, toxic int")
    train = spark.createDataFrame([(1000, "fine")], "doc_id long, text string")
    run = {
        "near": sh.keep_one_of_near_duplicates, "substrings": rc.without_repeats, "secrets": secrets.redact_secrets,
        "toxicity": lambda d: toxicity.drop_toxic(d.unionByName(train, allowMissingColumns=True), labels).where("doc_id is null or doc_id < 1000"),
    }[stage]
    got = run(rows)
    assert got.columns == rows.columns
    before = {tuple(r[2:]): r for r in rows.collect()}
    after = [(tuple(r[2:]), r) for r in got.collect()]
    assert all(key in before and r["doc_id"] == before[key]["doc_id"] for key, r in after)
    kept = sorted(int(key[0][3:]) for key, _ in after)
    if stage == "near":
        assert kept == [0, 3, 5, 7]
    else:
        assert stage == "toxicity" or kept == list(range(9))
    text = {int(key[0][3:]): r["text"] for key, r in after}
    if stage == "substrings":
        assert text[0] is None and text[1] == "" and text[2] == " " and text[4] == "one two three" and text[5] == text[7] == text[8] == ""
    elif stage == "secrets":
        assert all(text[i] == before[key]["text"] for key in before for i in [int(key[0][3:])])
    assert run(rows.limit(0)).count() == 0


def brute(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        stay = [True] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                stay[i : i + window] = [False] * window
        kept = [x for x, s in zip(w, stay) if s]
        out.append((len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


@pytest.mark.parametrize("window, levels", [(35, 3), (6, 2), (35, 0)])
def test_substrings_against_brute_force(spark, window, levels):
    rng = random.Random(window)
    passage = " ".join(f"p{rng.randint(0, 99)}" for _ in range(60))
    texts = [" ".join(rng.choice(["a", "b", "c", "d"]) for _ in range(rng.randint(0, 60))) for _ in range(20)]
    texts += [f"x{i} {passage} y{i} z" for i in range(4)] + ["run " * 200, "other " + "run " * 90, "ab ab " * 50, None, "", " ", texts[0], texts[1], "é " * 40]
    texts += [" ".join(f"u{rng.randint(0, 9)}" for _ in range(3000))]
    classes, cut = rc.repeats(table(spark, texts), window=window, levels=levels)
    assert classes.count() == len({t or "" for t in texts}) and cut.count() >= 0
    got = rc.dedup_substrings(table(spark, texts), window=window).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got] == brute(texts, window)


def test_hot_keys_are_dealt_out(spark):
    rows = spark.createDataFrame([(7 if i % 3 else i, i) for i in range(900)], "name long, cid long")
    keys = rows.groupBy("name").count().withColumnRenamed("count", "n").where("n > 1 or name = 30")
    got = rc._with_key_of(rows, keys, ["name"], ["cid"])
    assert sorted(map(tuple, got.collect())) == sorted([(7, i) for i in range(900) if i % 3] + [(30, 30)])
    assert rc._with_key_of(rows, keys.limit(0), ["name"], ["cid"]).count() == 0


def test_substrings_of_nothing(spark):
    assert rc.dedup_substrings(table(spark, [])).count() == 0
    kept = rc.without_repeats(table(spark, ["a b", None])).orderBy("doc_id").collect()
    assert [r["text"] for r in kept] == ["a b", None]


def test_texts_are_split_in_small_groups():
    from cataloom.llm import recompression

    texts = [b"w " * 1000] * 250 + [None, b""]
    found = list(recompression._groups(texts))
    assert [(a, b) for a, b, *_ in found] == [(0, 100), (100, 200), (200, 252)] and sum(len(table) for _, _, table, *_ in found) == 250_000
