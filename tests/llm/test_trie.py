import hashlib
import random
import zlib

import pytest

from cataloom.llm import trie


def brute_force(rows):
    convs = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        convs.setdefault(c, []).append((role or "", text or ""))
    made = {}
    for c, own in convs.items():
        h, head = zlib.crc32(str(c).encode()) % 9, c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = tuple(convs.get(head, [])[:h] + own[h:])
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def sums(p):
        below = [sums(q) for q in children.get(p, [])]
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        return sum(b[0] for b in below) or 1, own + sum(b[1] for b in below)

    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *sums(p),
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(made[c]) == len(p)).encode()).hexdigest())
        for p, m in members.items()
    )


def some(seed, n=60):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-20, n), n):
        turns = list(range(rng.randint(1, 12)))
        rows += [(c, t if t or rng.random() < 0.5 else None, rng.choice(["user", "user", None]), rng.choice(["a", "é", "", None, "long text " * 30])) for t in turns]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("primes, mask", [(trie.PRIMES, -1), ((5, 3), -1), (trie.PRIMES, 1), ((3, 2), 3)])
def test_trie_against_brute_force(spark, primes, mask):
    """Also with primes and hashes so small that fingerprints and turns collide all the time."""
    rows = [*some(mask + primes[0]), (None, 1, "user", "nobody")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    got = sorted(map(tuple, trie.conversation_trie(table, primes, mask).collect()), key=lambda r: (r[0], r[1], r[7]))
    assert got == sorted(brute_force(rows), key=lambda r: (r[0], r[1], r[7]))


def test_one_long_conversation_and_many_copies(spark):
    """A conversation that spans ranges, and hundreds of copies of one that begins as it does."""
    rows = [(0, t, "user", f"t{t % 7}") for t in range(700)] + [(c, t, "user", f"t{t % 7}") for c in range(5, 900, 5) for t in range(3)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["depth"]): tuple(r) for r in trie.conversation_trie(table).collect()}
    assert len(got) == 701 and got[0, 0][3:7] == (180, 1, 1, 179 * 6)
    ends = ",".join(str(c) for c in range(5, 900, 5))
    assert got[0, 3][2:] == (0, 180, 1, 1, 179 * 2, hashlib.sha256(ends.encode()).hexdigest())


def test_empty_and_turnless(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie.conversation_trie(spark.createDataFrame([], schema)).count() == 0
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(c, 1, "user", "a")]
    got = [tuple(r) for r in trie.conversation_trie(spark.createDataFrame(rows, schema)).collect()]
    assert got == brute_force(rows) and len(got) == 1
