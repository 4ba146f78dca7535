"""Byte-level BPE encoding by backtracking over longest matches, and decoding.

An encoding is the one BPE result exactly if all neighbouring tokens are compatible: if merging
their bytes from scratch would leave the border between them standing.  So a text is walked from
the left with the longest token that fits and is compatible with its predecessor; where none is, the
place is marked as a dead end and the walk steps back.  Each place dies at most once and the tokens
at a place are few, so the time is linear.  Bytes are mapped to Latin-1 characters, which
pyahocorasick takes, to find the longest token at every place in one pass.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .resident import resident

CACHE = 600_000
PAIRS = 1_000_000


def _merge(parts: list[bytes], ranks: dict[bytes, int], below: int) -> list[bytes]:
    """Plain BPE by merges of rank less than ``below``; used on single tokens when the tables are built."""
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], below))
        if ranks.get(parts[best] + parts[best + 1], below) >= below:
            break
        parts = [*parts[:best], parts[best] + parts[best + 1], *parts[best + 2 :]]
    return parts


class ByteBpe:
    """Encoder and decoder for a rank file (base64 token and rank on each line)."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in rows}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.shorter: dict[int, int | None] = {}
        self.trie = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.trie.add_word(token.decode("latin-1"), (len(token), rank))
            self.shorter[rank] = next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ranks), None)
            if len(token) > 1:
                parts = _merge([token[i : i + 1] for i in range(len(token))], self.ranks, rank)
                if len(parts) == 2:
                    pair = self.ranks[parts[0]], self.ranks[parts[1]]
                    self.halves[rank], self.merged[pair] = pair, rank
        self.trie.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE over the bytes of both tokens leaves them as they are.

        Both tokens are taken apart again, the younger merge (of the higher rank) first; at each
        moment of that history the two parts at the border must not have been due to merge before
        the merge just undone.
        """
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        a, b, due, result = left, right, None, True
        while True:
            joint = self.merged.get((a, b))
            if joint is not None and (due is None or joint < due):
                result = False
                break
            # on equal ranks the left one of two equal merges is done first, so the right is undone first
            undo_left = a in self.halves and (b not in self.halves or a > b)
            if undo_left:
                due, a = a, self.halves[a][1]
            elif b in self.halves:
                due, b = b + 1, self.halves[b][0]
            else:
                break
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[(left, right)] = result
        return result

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece (the pattern is not applied)."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest: list[int | None] = [None] * (n + 1)
        for end, (size, rank) in self.trie.iter(piece.decode("latin-1")):
            longest[end - size + 1] = rank
        alive = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            while token is not None:
                end = at + len(self.bytes_of[token])
                if alive[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self.shorter[token]
            if token is not None:
                out.append(token)
                at, token = end, longest[end]
            elif out:
                alive[at] = 0
                last = out.pop()
                at -= len(self.bytes_of[last])
                token = last
            else:
                raise ValueError("a byte of the text is no token")
        return out

    def encode_bytes(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        pieces, known = self.pattern.findall(text), self.pieces
        if len(known) > CACHE:
            known.clear()
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            for p in pieces:
                if p not in known:
                    known[p] = np.array(self.encode_piece(p.encode("utf-8", "replace")), dtype="<u4").tobytes()
            return b"".join(map(known.__getitem__, pieces))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def load(path: str) -> ByteBpe:
    """The encoder of a rank file, built once in each process."""
    return resident(("byte_bpe", path), lambda: ByteBpe(path))


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row; a null text has no ids."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for b in batches:
            ids = [np.frombuffer(bpe.encode_bytes(t), dtype="<u4").astype(np.int32) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": ids})

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return picked.mapInPandas(run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of ``docs``.

    Each match of the pattern is encoded by itself; the decoded bytes come from the ids.  Null texts
    count as empty, of which both hashes are those of no bytes; repeated rows and null ids stay.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for b in batches:
            n, ids_sha, decoded_sha = [], [], []
            for text in b["text"]:
                raw = bpe.encode_bytes(text)
                n.append(len(raw) // 4)
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                decoded_sha.append(hashlib.sha256(bpe.decode(np.frombuffer(raw, dtype="<u4").tolist())).hexdigest())
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": decoded_sha})

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return picked.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``documents``."""
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
