"""String similarity by longest common subsequences, natively."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def common_subsequence(a: Column, b: Column) -> Column:
    """The length of the longest common subsequence, one row of the table at a time in a fold."""
    x, y = F.filter(F.split(a, ""), lambda c: c != ""), F.filter(F.split(b, ""), lambda c: c != "")
    start = F.transform(F.sequence(F.lit(0), F.size(y)), lambda i: F.lit(0))

    def row(above: Column, c: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(y))

        def cell(made: Column, j: Column) -> Column:
            best = F.when(F.get(y, j - 1) == c, F.get(above, j - 1) + 1).otherwise(F.greatest(F.get(above, j), F.get(made, j - 1)))
            return F.array_append(made, best)

        return F.when(F.size(y) > 0, F.aggregate(places, F.array(F.lit(0)), cell)).otherwise(above)

    return F.element_at(F.aggregate(x, start, row), -1)


def ratio(a: Column, b: Column) -> Column:
    """0 to 100: twice the common subsequence over both lengths; 100 for two empty strings, 0 for one."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).when(
        a == b, F.lit(100.0)
    ).otherwise(common_subsequence(a, b) * F.lit(200.0) / total)


def sorted_tokens(text: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(text, r"(?U)\s+"), lambda t: t != "")), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    return ratio(sorted_tokens(a), sorted_tokens(b))


def subsequence_length(a: str, b: str) -> int:
    """The same length for two Python strings, with one big-integer step a character."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    every = (1 << len(a)) - 1
    free = every
    for c in b:
        hit = free & places.get(c, 0)
        free = ((free + hit) | (free - hit)) & every
    return len(a) - free.bit_count()


def ratio_of(a: str, b: str) -> float:
    if not a and not b:
        return 100.0
    return 200.0 * subsequence_length(a, b) / (len(a) + len(b)) if a and b else 0.0


def token_sort_ratio_of(a: str, b: str) -> float:
    return ratio_of(*(" ".join(sorted(x.split())) for x in (a, b)))


def token_sort_ratio_arrow(a: Column, b: Column) -> Column:
    """``token_sort_ratio`` on Arrow batches, for longer strings and many pairs."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([token_sort_ratio_of(p, q) for p, q in zip(x, y)], dtype="float64")

    return run(a, b)
