import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cataloom.llm import byte_bpe, packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = ["Hello world, it's 2024!", "", None, "é🙂 漢字\x1c\x85 x", "a" * 3000, "word " * 2500, "<|endoftext|> x", "İΣΣ ΌΣΟΣ", "tab\tnew\nline\x1cx", "Hello world, it's 2024!"]


@pytest.fixture(scope="module")
def coders():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return byte_bpe.load(RANKS), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_encoding_is_the_library_one(coders, text):
    own, library = coders
    text = text.encode("utf-8", "ignore").decode()
    ids = own.encode(text)
    assert ids == library.encode_ordinary(text) and own.decode(ids) == text.encode()


def test_round_trip(spark, coders):
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens int")
    got = byte_bpe.round_trip(rows).orderBy("doc_id").collect()
    for r, t in zip(got, TEXTS):
        ids = np.array(coders[1].encode_ordinary(t or ""), dtype="<u4")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert byte_bpe.round_trip(rows.limit(0)).count() == 0


def test_packing(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, piece int")
    got = packing.pack_documents(rows).collect()
    by_doc = {}
    for r in sorted(got, key=lambda r: r["piece"]):
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i, t in enumerate(TEXTS):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want = [(k, 2048 * k, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(np.split(ids, range(2048, len(ids), 2048)))]
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[i if i else None]] == want
    sequences = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(sequences.values()) <= 2048
    assert packing.pack_documents(rows.limit(0)).count() == 0


def test_rule_against_all_choices():
    rng, capacity = random.Random(6), 12
    rule, gaps = packing.SumOfSquares(capacity), []
    for _ in range(400):
        size = rng.randint(1, capacity)
        choices = {}
        for gap in {g for g in gaps if g >= size} | {None}:
            after = [g for g in gaps]
            if gap is not None:
                after.remove(gap)
            after.append((capacity if gap is None else gap) - size)
            choices[gap] = sum(after.count(g) ** 2 for g in set(after) if g)
        bins = rule.bins
        rule.place(size)
        open_ = sorted(g for g in np.repeat(np.arange(capacity + 1), rule.open))
        assert sum(c * c for c in rule.open) == min(choices.values())
        least = min(choices.values())
        tightest = min((g for g, s in choices.items() if s == least and g is not None), default=None)
        assert (rule.bins > bins) == (tightest is None)
        gaps.append((capacity if tightest is None else tightest) - size)
        if tightest is not None:
            gaps.remove(tightest)
        gaps = [g for g in gaps if g]
        assert open_ == sorted(gaps)


def test_packing_many_copies(spark):
    rows = spark.createDataFrame([(7, "the same text " * 9)] * 300, "doc_id long, text string")
    made = packing.pieces(rows, public_tokenizers.path("word_bpe_49k.json")).selectExpr("*", "monotonically_increasing_id() AS row")
    got = packing.sequences(made, 300, shard_pieces=20).collect()
    assert len(got) == 300 and len({r["sequence_id"] >> 32 for r in got}) > 8


def test_words_are_remembered_and_forgotten(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "CACHE", 30)
    own = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(3)
    for _ in range(20):
        texts = [" ".join(f"word{rng.randint(0, 60)}" for _ in range(rng.randint(0, 8))) for _ in range(3)]
        ids, counts = own.encode(pa.array(texts))
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]


def test_sum_of_squares_fills_bins():
    rng = random.Random(4)
    sizes = np.array([rng.randint(1, 2048) for _ in range(4000)])
    bins = packing.pack(sizes)
    filled = np.bincount(bins, weights=sizes)
    assert filled.max() <= 2048 and (filled > 0).all()
    assert len(filled) <= 1.03 * max(np.ceil(sizes.sum() / 2048), (sizes > 1024).sum())
    assert len(packing.pack(np.array([], dtype=np.int64))) == 0


def test_ids_are_the_plain_library_ones():
    import pyarrow as pa

    own, library = packing.WordIds(public_tokenizers.path("word_bpe_49k.json")), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(8)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|endoftext", "|>", " ", "\n", "a", "Word's", "é", "12", "<|", "\u0301", "漢字", "\ue000", "\u00a0", "\x1c"]
    texts = ["<|endoftext|> a", "a<|endoftext|>b<|startoftext|><|endoftext|>", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(1500))]
    ids, counts = own.encode(pa.array(texts))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert 49407 in want[0] and want[0][0] == 49407
