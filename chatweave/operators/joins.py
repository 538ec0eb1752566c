"""Join choices that depend on a counted size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most rows a table may have and still be marked for broadcast.
BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a narrow table for broadcast if it really is small, else leave the choice
    of join to Spark."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def join_null_safe(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` with null equal to null; the key columns of ``df`` stay."""
    named = other.withColumnsRenamed({k: f"_other_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys]
    joined = df.join(named, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_other_{k}" for k in keys])
