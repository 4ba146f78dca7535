"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings.

Everything is a native column expression; texts without a candidate are dismissed by one regular
expression a kind, and only the rest pay for positions and windows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import columns, fresh

#: Kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12


@dataclass(frozen=True)
class CharacterClass:
    """Strings of one class of characters: which they are, the window, and the bits it must reach."""

    name: str
    pattern: str
    window: int
    bits: float


#: Classes of candidate strings, the first that fits a string holds for it.
CLASSES = (
    CharacterClass("hex", r"^[0-9A-Fa-f]+$", 16, 3.0),
    CharacterClass("alphanumeric", r"^[A-Za-z0-9]+$", 20, 3.75),
    CharacterClass("base64", r"^[A-Za-z0-9+/=_-]+$", 20, 3.85),
)
#: What a candidate string is: a long run of these characters with a digit and a letter.
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
#: Harmless high-entropy strings: placeholders, alphabets in order, UUIDs, dates, words joined by marks.
#: Repeated groups are possessive: they run as loops, whatever the length, and never on Java's stack.
ALLOWED = (
    r"(?i)example|sample|placeholder|dummy|changeme",
    r"(?i)0123456789|123456789|abcdefghij|qwertyuiop",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[A-Z]?[a-z]*+(?:[-_/=+](?:[0-9]{1,4}+|[A-Z]?[a-z]*+))*+$",
)
GROUP = 256


def _starts(parts: Column, initial: Column) -> Column:
    """Running sums: for structs (gap, len) the (start, end) of each, counted from ``initial``."""

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + x["len"]
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("out"))

    zero = F.struct(initial.alias("at"), F.lit([]).cast("array<struct<start:int,end:int>>").alias("out"))
    return F.aggregate(parts, zero, step, lambda s: s["out"])


def match_spans(text: Column, pattern: str, keep: Column | None = None) -> Column:
    """(start, end) in code points of the leftmost non-overlapping matches of ``pattern``.

    The texts between matches come from ``split``, so positions are running sums of lengths; they are
    summed in groups of 256 matches, then the groups, which keeps long lists of matches cheap.
    ``keep``: an array of booleans, one a match, that says which to return.
    """
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)) if "(" not in pattern.replace("(?", "") else F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    parts = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len"))
    )
    groups = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / F.lit(GROUP)).cast("int")),
        lambda i: F.slice(parts, i * GROUP + 1, F.lit(GROUP)),
    )
    total = F.transform(
        groups,
        lambda g: F.struct(F.lit(0).alias("gap"), F.aggregate(g, F.lit(0), lambda a, x: a + x["gap"] + x["len"]).alias("len")),
    )
    spans = F.flatten(F.zip_with(groups, _starts(total, F.lit(0)), lambda g, at: _starts(g, at["start"])))
    if keep is not None:
        spans = F.transform(
            F.filter(F.zip_with(spans, keep, lambda s, k: F.struct(s.alias("s"), k.alias("k"))), lambda x: x["k"]), lambda x: x["s"]
        )
    return spans


def _c_log_c(c: Column) -> Column:
    return F.when(c > 0, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def most_entropy(chars: Column, window: int) -> Column:
    """The largest Shannon entropy, in bits, of ``window`` neighbouring characters (null where fewer).

    H = log2(w) - S / w with S the sum of c log2 c over the counts c.  The counts are carried along, one
    for each of the 128 ASCII characters (candidate strings have no others); moving on by one character
    changes two of them, and S by their terms only.
    """
    w = F.lit(window)

    def move(counts: Column, s: Column, x: Column, by: int) -> Column:
        """(counts, s) with one more or less of the character number x."""
        c = F.element_at(counts, x)
        changed = F.concat(F.slice(counts, F.lit(1), x - 1), F.array(c + by), F.slice(counts, x + 1, F.lit(128) - x))
        return F.struct(changed.alias("counts"), (s - _c_log_c(c) + _c_log_c(c + by)).alias("s"))

    def enter(state: Column, x: Column) -> Column:
        return move(state["counts"], state["s"], x, 1)

    codes = F.transform(chars, lambda x: F.ascii(x) + 1)
    zero = F.struct(F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("s"))
    first = F.aggregate(F.slice(codes, F.lit(1), w), zero, enter)
    # a step for each further place: what leaves and what enters
    n = F.greatest(F.size(codes) - w, F.lit(0))
    moves = F.zip_with(F.slice(codes, F.lit(1), n), F.slice(codes, w + 1, n), lambda out, new: F.struct(out.alias("out"), new.alias("new")))

    def step(state: Column, m: Column) -> Column:
        left = move(state["own"]["counts"], state["own"]["s"], m["out"], -1)
        now = move(left["counts"], left["s"], m["new"], 1)
        return F.struct(now.alias("own"), F.least(state["low"], now["s"]).alias("low"))

    low = F.aggregate(moves, F.struct(first.alias("own"), first["s"].alias("low")), step, lambda s: s["low"])
    return F.when(F.size(chars) >= w, F.log2(F.lit(float(window))) - low / w)


def is_random(candidate: Column) -> Column:
    """Whether a candidate string looks like a secret: a digit and a letter, on no allow-list, and
    some window as random as its character class asks for."""
    chars = F.split(candidate, "")
    reached = F.lit(False)
    for c in reversed(CLASSES):
        # a window of n different characters has log2(n) bits at most, so most long runs need no fold
        enough = F.size(F.array_distinct(chars)) >= math.ceil(2**c.bits)
        found = F.when(enough, F.coalesce(most_entropy(chars, c.window) >= c.bits, F.lit(False))).otherwise(F.lit(False))
        reached = F.when(candidate.rlike(c.pattern), found).otherwise(reached)
    mixed = candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]")
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | candidate.rlike(pattern)
    return F.when(mixed & ~allowed, reached).otherwise(F.lit(False))


def _with_spans(docs: DataFrame, text: Column, into: str) -> DataFrame:
    """``docs`` with a struct ``into`` of the spans of each kind, arrays of (start, end)."""
    none = F.lit([]).cast("array<struct<start:int,end:int>>")
    value_fits = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)), lambda v: F.length(v) >= ASSIGN_LEAST)
    strings = F.regexp_extract_all(text, F.lit(f"({CANDIDATE})"), F.lit(1))
    out = docs.withColumn(into, F.struct(
        F.when(text.rlike(ASSIGN), match_spans(text, ASSIGN, value_fits)).otherwise(none).alias("assign"),
        F.when(text.rlike(ACCESS), match_spans(text, ACCESS)).otherwise(none).alias("access"),
        F.when(text.rlike(HEX), match_spans(text, HEX)).otherwise(none).alias("hex"),
        F.when(text.rlike(CANDIDATE), match_spans(text, CANDIDATE, F.transform(strings, is_random))).otherwise(none).alias("entropy"),
    ))
    spans = F.col(into)
    base = F.concat(*(spans[k] for k in KINDS[:3]))
    beyond = F.filter(spans["entropy"], lambda e: ~F.exists(base, lambda b: (b["start"] <= e["start"]) & (b["end"] >= e["end"])))
    return out.withColumn(into, spans.withField("entropy", beyond))


def _in_order(found: Column, kinds: tuple[str, ...]) -> Column:
    """Spans of the kinds by start, then kind: structs (start, order, end)."""

    def placed(order: int) -> Column:
        return F.transform(
            found[kinds[order]], lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"))
        )

    return F.array_sort(F.concat(*map(placed, range(len(kinds)))))


def _written(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["order"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans) for every row of ``docs``.

    Spans count code points, end exclusive, written kind:start:end.  ``base_sha256`` hashes those
    of the three patterns; ``spans`` has the entropy spans as well, except those inside a pattern's
    span.  Null and empty texts have none; repeated rows and null ids stay; other columns are
    not read; an empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    found = F.col("found")
    return _with_spans(texts, F.col("text"), "found").select(
        "doc_id",
        *(F.size(found[k]).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_written(_in_order(found, KINDS[:3])).cast("binary"), 256).alias("base_sha256"),
        _written(_in_order(found, KINDS)).alias("spans"),
    )


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each run of overlapping spans in ``text_col`` replaced by ``mark``.

    Null and empty texts, texts without spans and all other columns stay as they are, whatever their
    names; very long texts are read whole; repeated rows stay; an empty table gives an empty result.
    """
    own, text = fresh("own", docs.columns), F.coalesce(text_col, F.lit(""))
    found = _with_spans(docs, text, own).withColumn(own, _in_order(F.col(own), KINDS))
    # the kept stretches between runs of spans, joined once, so work grows with the text and its spans
    def step(state: Column, s: Column) -> Column:
        gap = F.struct(state["at"].alias("start"), s["start"].alias("end"))
        kept = F.when(s["start"] >= state["at"], F.concat(state["kept"], F.array(gap))).otherwise(state["kept"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), kept.alias("kept"))

    groups = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(own) - 1) / F.lit(GROUP)).cast("int")), lambda i: F.slice(F.col(own), i * GROUP + 1, F.lit(GROUP))
    )
    none = F.lit([]).cast("array<struct<start:int,end:int>>")

    def over(state: Column, g: Column) -> Column:
        done = F.aggregate(g, F.struct(state["at"].alias("at"), none.alias("kept")), step)
        return F.struct(done["at"].alias("at"), F.concat(state["kept"], F.array(done["kept"])).alias("kept"))

    start = F.struct(F.lit(0).alias("at"), F.lit([]).cast("array<array<struct<start:int,end:int>>>").alias("kept"))
    stretches = F.aggregate(
        groups, start, over, lambda s: F.concat(F.flatten(s["kept"]), F.array(F.struct(s["at"].alias("start"), F.length(text).alias("end"))))
    )
    clean = F.array_join(F.transform(stretches, lambda k: F.substring(text, k["start"] + 1, k["end"] - k["start"])), mark)
    return found.withColumn(text_col, F.when(F.size(own) > 0, clean).otherwise(F.col(text_col))).select(*columns(docs))


def op5_secret_scans(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``documents``."""
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
