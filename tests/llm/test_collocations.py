import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cataloom.llm import collocations as c

FOLDED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(FOLDED))]


def brute_force(rows, least, most_words, share, top):
    out = []
    for lang in {r[1] or "und" for r in rows}:
        f = Counter(tuple(p[i : i + k]) for t, la in rows if (la or "und") == lang for p in pieces(t) for k in range(1, most_words + 1) for i in range(len(p) - k + 1))
        n = sum(v for k, v in f.items() if len(k) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and inside(q) and 100 * b >= share * a for q, b in found.items()):
                continue
            s, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def some(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "漢字", "a-b", "x", "y", "\x1cq", "one", "two"]
    marks = [" ", " ", " ", "  ", "\t", ", ", "\n", ".", " ! ", " "]
    texts = ["".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [(t if rng.random() < 0.95 else None, rng.choice(["en", "en", "fr", None])) for t in texts] + [("same old song " * 30, "en"), ("", "de")]


@pytest.mark.parametrize("least, most_words, hot", [(10, 3, 200), (3, 3, 200), (2, 4, 5), (3, 3, 30), (2, 2, 4)])
def test_collocations_against_brute_force(spark, monkeypatch, least, most_words, hot):
    """Also with longer phrases, and with prefixes dealt out at every length."""
    monkeypatch.setattr(c, "HOT_SHARE", hot)
    rows = some(least * 10 + most_words)
    table = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, rank int").repartition(3)
    got = sorted(map(tuple, c.collocations(table, least, most_words, top=40).collect()))
    assert got == brute_force(rows, least, most_words, 50, 40) and len(got) > 5


def test_no_documents(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert c.collocations(empty).count() == 0
    assert c.collocations(spark.createDataFrame([(None, None), ("", "en"), (" .\n", "en")], "text string, lang string")).count() == 0


def test_pieces_and_places():
    texts = [None, "A b,C\td", "", "İ!!x  Y", "tail\n"]
    distinct, code, piece, text = c.pieces_of(pa.array(["cut off", *texts]).slice(1))
    words = [distinct[int(i)].as_py() for i in code]
    assert words == ["a", "b", "c", "d", "İ", "x", "y", "tail"] and text.tolist() == [1, 1, 1, 1, 3, 3, 3, 4]
    assert piece[0] == piece[1] != piece[2] == piece[3] and piece[5] == piece[6]
    distinct, code, piece, text = c.pieces_of(pa.array([], pa.string()))
    assert len(code) == len(piece) == 0


def test_bits_come_back(spark):
    at = [1, 2, 32768, 32769, 99999, (1 << 24) - 1]
    bits = c._bits_of(spark.createDataFrame([(a,) for a in at], "place long"), "place", 24)
    assert np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist() == [a - 1 for a in at]


def test_scores_pass_64_bits(spark):
    """A count of ten thousand million, squared and times a million, as the query's SQL writes it."""
    a = 10_000_000_007
    got = spark.sql(f"SELECT CAST(CAST(1000000 AS DECIMAL(7,0)) * (CAST({a}L AS DECIMAL(19,0)) * CAST({a}L AS DECIMAL(19,0))) AS DECIMAL(38,0)) div (CAST({a + 4}L AS DECIMAL(19,0)) * CAST({a * 3}L AS DECIMAL(19,0)))").first()[0]
    assert int(got) == 1000000 * a * a // ((a + 4) * a * 3)
