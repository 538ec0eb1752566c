"""Column expressions shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII white space: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \t\n\x0b\x0c\r"
SPACES = "[ \\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas of the body."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def row_key(id_col: str, *cols: str) -> Column:
    """The id, nulls last, and 128 hash bits of ``cols``: rows share it only if all of these are equal."""
    seen = [F.col(c) for c in cols] + [F.col(c).isNull() for c in cols]
    return F.struct(F.col(id_col).isNull().alias("blank"), F.col(id_col).alias("id"),
                    F.xxhash64(F.lit(1), *seen).alias("x"), F.xxhash64(F.lit(2), *seen).alias("y"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words between ASCII white space; none for a blank text."""
    return let(F.btrim(lower_ascii(text), F.lit(SPACE)), lambda t: F.when(
        t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACES, -1)))


def shingle_hashes(text: Column, size: int = 5) -> Column:
    """64-bit hashes of all runs of ``size`` words, in order and with repeats.

    Fewer words make one shingle, no words none.
    """
    def roll(h: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(h) - size),
                           lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(size)]))
        short = F.array(F.aggregate(h, F.lit(0).cast("bigint"), lambda a, x: F.xxhash64(a, x)))
        return (F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
                .when(F.size(h) < size, short).otherwise(runs))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), roll)


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an array of integers, in blocks, so that the cost stays
    near the length of the array for very long ones."""
    def grow(part: Column, base: Column) -> Column:
        start = F.array().cast("array<bigint>")
        sums = F.aggregate(part, start, lambda acc, x: F.array_append(
            acc, F.coalesce(F.try_element_at(acc, F.lit(-1)), base) + x))
        return sums

    def blocks(v: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")),
                            lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))

        def joined(p: Column) -> Column:
            totals = F.transform(p, lambda x: F.aggregate(
                x, F.lit(0).cast("bigint"), lambda a, y: a + y))
            bases = grow_plain(totals)
            return let(bases, lambda t: F.flatten(F.transform(p, lambda x, i: grow(
                x, F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get(t, i - 1))))))

        return F.when(F.size(v) == 0, F.array().cast("array<bigint>")).otherwise(let(parts, joined))

    def grow_plain(part: Column) -> Column:
        return grow(part, F.lit(0).cast("bigint"))

    return let(values.cast("array<bigint>"), blocks)
