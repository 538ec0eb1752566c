"""Integer arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_div(c: Column | str, by: int | Column) -> Column:
    """Integer quotient as a bigint, rounded down, without a detour through doubles."""
    c = F.col(c) if isinstance(c, str) else c
    by = F.lit(by) if isinstance(by, int) else by
    return F.call_function("div", c - F.pmod(c, by), by)


def ceil_div(c: Column | str, by: int) -> Column:
    """Quotient of a non-negative integer, rounded up."""
    c = F.col(c) if isinstance(c, str) else c
    return whole_div(c + F.lit(by - 1), by)
