"""Splitting columns of texts into words with Arrow kernels, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows whose texts hold about ``most`` bytes together (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct, codes, counts): the distinct words of the texts, each word's place among them in
    reading order, and the number of words of each text.  Words end at ASCII white space; an
    empty word may stand at either end of a text or for an empty text."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = pc.dictionary_encode(parts.flatten())
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False), counts
