"""Building blocks of rules as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(values: Iterable[str]) -> Column:
    """An array literal of strings."""
    return F.array(*(F.lit(v) for v in values)).cast("array<string>")


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` written once, however often ``f`` uses it.  Without it expressions
    that use their parts several times grow exponentially where the optimizer puts them together."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def filled(c: Column) -> Column:
    """Null where a string is null or empty; ``c`` is used twice, so give it a column or use ``let``."""
    return F.when(c != "", c)


def first_filled(*columns: Column) -> Column:
    """The first string that is neither null nor empty."""
    return F.coalesce(*map(filled, columns))


def has(c: Column) -> Column:
    """Whether a string is neither null nor empty; never null."""
    return F.coalesce(F.length(c) > 0, F.lit(False))


def yes(c: Column) -> Column:
    """A boolean with null as false."""
    return F.coalesce(c, F.lit(False))


def matches(text: Column, pattern: str) -> Column:
    """Whether a pattern is found anywhere, case aside, as Unicode defines words and cases."""
    return text.rlike("(?iU)" + pattern)


def first_match(text: Column, patterns: Iterable[str]) -> Column:
    """The first of the patterns that is found in ``text``, or null."""
    return F.coalesce(*(F.when(matches(text, p), F.lit(p)) for p in patterns))


def any_match(text: Column, patterns: Iterable[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | matches(text, p)
    return yes(out)


def any_part(text: Column, parts: Iterable[str]) -> Column:
    """Whether one of the strings is a part of ``text``."""
    out = F.lit(False)
    for p in parts:
        out = out | text.contains(p)
    return yes(out)


def listed(*items: Column) -> Column:
    """An array of the items that are not null."""
    return F.array_compact(F.array(*items))


def appended(array: Column, value: str, when: Column, unless: Iterable[str]) -> Column:
    """``array`` with ``value`` at its end where ``when`` holds and none of ``unless`` is in it."""
    return let(array, lambda a: F.when(when & ~F.arrays_overlap(a, words(unless)), F.array_append(a, F.lit(value))).otherwise(a))


def removed(array: Column, value: str, when: Column) -> Column:
    """``array`` without the first occurrence of ``value`` where ``when`` holds."""
    return let(array, lambda a: F.filter(a, lambda x, i: ~when | (x != value) | (i + 1 != F.array_position(a, value))))


def is_web(c: Column) -> Column:
    return yes(c.startswith("http://") | c.startswith("https://"))
