"""Text put together from token rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatweave.functions.numbers import whole_div


def accumulate_tokens(tokens: DataFrame, key: str = "id", seq: str = "seq", token: str = "token",
                      part_size: int = 4096) -> DataFrame:
    """Concatenate the tokens of each response in order, without separator.

    Tokens are joined in parts first, so a long response reaches its last step as a
    few long strings.
    """
    part = whole_div(seq, part_size).alias("part")

    def joined(order: str, text: str):
        items = F.sort_array(F.collect_list(F.struct(F.col(order), F.col(text).alias("x"))))
        return F.array_join(F.transform(items, lambda i: i["x"]), "")

    parts = tokens.groupBy(key, part).agg(joined(seq, token).alias("x"), F.count(F.lit(1)).alias("n"))
    return parts.groupBy(key).agg(joined("part", "x").alias("text"), F.sum("n").alias("n_tokens"))
