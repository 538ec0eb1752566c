"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

Kinds, in the order used for spans that start together: ``assign`` (a value of at
least 8 characters after a key word), ``access`` (AKIA and capitals or digits, 16 or
more characters), ``hex`` (32 or more lower-case hexadecimal digits), ``entropy``.

Candidates for entropy are runs of at least 20 letters, digits and ``+/_=-``, or what spans of fixed
patterns leave of them. A candidate
belongs to one character class: hexadecimal (letters of one case), letters and digits, or
all. A window of 20 characters moves over it. The counts of its characters are kept, and these and the sum of
c*log2(c) over the counts c change only by the character that leaves and the one that enters; the sum
gives the Shannon entropy. The span runs from the first to the last window at or above the
limit of its class. Candidates that as a whole are harmless by the allow-list are left out, and spans that hold
a made-up value. Fixed patterns are never suppressed.

Defined cases: null text is empty and has no spans; equal rows have equal spans; positions are code
points, end exclusive; other columns pass through, but ``_base`` and ``_all`` give way to the results; an empty table
gives an empty table. Work is linear in the text.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatweave.llm.columns import let, running_sums

# The base patterns.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# A run of hexadecimal digits matches whole or not at all, so short ones can be skipped.
LONG_HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"

WINDOW = 20
# The characters of candidates, each with a count of its own.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Bits per character from which a window is suspicious. 20 random characters have about 3.3
# bits as hexadecimal digits and 4.1 as letters and digits, with few below these limits; words have less than 3.5.
LIMITS = {"hex": 2.9, "alnum": 3.7, "base64": 3.75}
MADE_UP = (r"(?i)example|placeholder|changeme|x{6}|0123456789|abcdefghij",)  # anywhere in a span
ALLOW = (
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",  # identifiers
    r"^[a-z]+(?:[-_/][a-z]+)+$",  # paths and slugs of words
    r"^[A-Za-z]+$",  # words
    r"^[0-9=_+/-]+$",  # numbers and rules
)
KINDS = ("assign", "access", "hex", "entropy")


def _spans(text: Column, pattern: str, kind: str, least: int, group: int = 0) -> Column:
    """Spans of all matches, leftmost and not overlapping, whose ``group`` is long enough."""
    order = KINDS.index(kind)
    none = F.array().cast("array<struct<start:bigint,ord:int,kind:string,end:bigint>>")

    def place(found: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), lambda x: F.length(x))
        steps = F.zip_with(gaps, found, lambda g, x: g + F.length(x))
        tested = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        marked = F.zip_with(
            F.zip_with(running_sums(steps), found, lambda e, x: F.struct(
                (e - F.length(x)).alias("start"), e.alias("end"))),
            tested, lambda s, x: F.struct(s["start"].alias("start"), F.lit(order).alias("ord"),
                                          F.lit(kind).alias("kind"), s["end"].alias("end"),
                                          F.length(x).alias("n")))
        return F.transform(F.filter(marked, lambda s: s["n"] >= least), lambda s: F.struct(
            s["start"].alias("start"), s["ord"].alias("ord"), s["kind"].alias("kind"), s["end"].alias("end")))

    return F.when(F.rlike(text, F.lit(pattern)), let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)).otherwise(none)


def _hot_range(value: Column, limit: Column, window: int = WINDOW) -> Column:
    """Start (inclusive) and end (exclusive) of the windows of ``value`` whose entropy is at
    least ``limit``; null if there is none. ``value`` has at least ``window`` characters."""
    terms = F.array(*[F.lit(c * log2(c) if c else 0.0) for c in range(window + 1)])

    def run(codes: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            counts, enters = state["counts"], F.get(codes, i)
            leaves = F.when(i >= window, F.get(codes, i - window)).otherwise(F.lit(-1))
            rest = F.greatest(i - window + 1, F.lit(0))
            out = F.when(leaves >= 0, let(F.get(counts, leaves), lambda c: F.get(terms, c - 1) - F.get(terms, c))).otherwise(F.lit(0.0))
            come = let(F.get(counts, enters) - (leaves == enters).cast("int"), lambda c: F.get(terms, c + 1) - F.get(terms, c))
            return let(state["sum"] + out + come, lambda total: let(
                (i >= window - 1) & (F.lit(log2(window)) - total / window >= limit),
                lambda hot: F.struct(
                    F.transform(counts, lambda c, j: c + (j == enters).cast("int") - (j == leaves).cast("int")).alias("counts"),
                    total.alias("sum"),
                    F.coalesce(state["first"], F.when(hot, rest)).alias("first"),
                    F.when(hot, i + 1).otherwise(state["last"]).alias("last"))))

        start = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"),
                         F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step)

    chars = F.filter(F.split(value, "", -1), lambda x: x != "")
    return let(F.transform(chars, lambda x: F.call_function("locate", x, F.lit(ALPHABET)) - 1), run)


def _class_limit(value: Column, limits: dict[str, float]) -> Column:
    return (F.when(F.rlike(value, F.lit("^(?:[0-9a-f]+|[0-9A-F]+)$")), limits["hex"])
            .when(F.rlike(value, F.lit("^[A-Za-z0-9]+$")), limits["alnum"]).otherwise(limits["base64"]))


def _rests(run: Column, base: Column) -> Column:
    """What spans of fixed patterns leave of a run, in order."""
    over = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))

    def rests(cuts: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(cuts)), lambda i: F.struct(
            F.aggregate(F.slice(cuts, F.lit(1), i), run["start"], lambda a, b: F.greatest(a, b["end"])).alias("start"),
            F.coalesce(F.get(cuts, i)["start"], run["end"]).alias("end")))

    return F.filter(let(over, rests), lambda r: r["end"] - r["start"] >= WINDOW)


def _entropy_spans(text: Column, base: Column, allow: tuple[str, ...], made_up: tuple[str, ...], limits: dict[str, float]) -> Column:
    plain = F.flatten(F.transform(_spans(text, CANDIDATE, "entropy", WINDOW), lambda s: _rests(s, base)))

    def cut(start: Column, end: Column) -> Column:
        return F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))

    def judge(s: Column) -> Column:
        hot = let(cut(s["start"], s["end"]), lambda v: F.when(~_any(v, allow), _hot_range(v, _class_limit(v, limits))))
        return let(hot, lambda r: F.struct(
            (s["start"] + r["first"]).alias("start"), F.lit(KINDS.index("entropy")).alias("ord"), F.lit("entropy").alias("kind"),
            (s["start"] + r["last"]).alias("end")))

    return F.filter(F.transform(plain, judge), lambda s: s["start"].isNotNull() & ~_any(cut(s["start"], s["end"]), made_up))


def _any(value: Column, patterns: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for pattern in patterns:
        found = found | F.rlike(value, F.lit(pattern))
    return found


def scan_secrets(docs: DataFrame, text_col: str = "text", allow: tuple[str, ...] = ALLOW,
                 made_up: tuple[str, ...] = MADE_UP, limits: dict[str, float] = LIMITS) -> DataFrame:
    """``docs`` with ``_base`` and ``_all``, sorted arrays of spans (start, ord, kind, end); input columns of
    these names give way to them."""
    rows = docs.drop("_base", "_all").select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    base = rows.select("row", "t", F.array_sort(F.concat(
        _spans(F.col("t"), ASSIGN, "assign", 8, 2), _spans(F.col("t"), ACCESS, "access", 16),
        _spans(F.col("t"), LONG_HEX, "hex", 32))).alias("_base"))
    return base.select("row.*", "_base", F.array_sort(F.concat(
        "_base", _entropy_spans(F.col("t"), F.col("_base"), allow, made_up, limits))).alias("_all"))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
