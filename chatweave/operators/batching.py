"""Which row goes to which rank, step and slot of a training run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatweave.functions.numbers import ceil_div, whole_div
from chatweave.functions.tokens import padded, padded_labels, padded_mask
from chatweave.operators.ordered import CHUNK, Running, hash_chunks, running

# Logging, saving and retention intervals of a run.
LOGGING_STEPS = 10
SAVE_STEPS = 1000
SAVE_TOTAL_LIMIT = 3


# Rows of a chunk of a seeded order.
CHUNK_ROWS = 50_000


@dataclass(frozen=True)
class Layout:
    """Ranks, rows per rank and micro-batch, micro-batches per step."""

    ranks: int
    batch: int
    accumulation: int = 1

    @property
    def rows_per_step(self) -> int:
        return self.ranks * self.batch * self.accumulation


def shuffle_digest(key: str, seed: int, epoch: int = 0) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(epoch)), F.col(key).cast("string")))


def order_digits(rows: int) -> int:
    """Hex digits of a digest that deal ``rows`` rows to chunks of ``CHUNK_ROWS`` or so: 1 to 4."""
    digits = 1
    while digits < 4 and rows > CHUNK_ROWS * 16**digits:
        digits += 1
    return digits


def seeded_order(df: DataFrame, key: str, seed: int, epoch: int = 0, digits: int | None = None) -> DataFrame:
    """Add ``idx``, the position in a seeded random order, and ``idx_total``.

    The order is that of a digest of (seed, epoch, key), so it depends on neither
    partitioning nor engine. Chunks are digest prefixes: even by construction, and
    known row by row, so nothing is sampled or materialised. Their number follows the
    number of rows, which is counted unless ``digits`` is given.
    """
    digits = order_digits(df.count()) if digits is None else digits
    hashed = hash_chunks(df.withColumn("_digest", shuffle_digest(key, seed, epoch)), "_digest", digits)
    placed = running(
        hashed, [], ["_digest", key],
        {"idx": Running("sum", F.lit(1).cast("long"), inclusive=False)}, totals=["idx"],
    )
    return placed.drop("_digest", CHUNK)


def rank_shards(ordered: DataFrame, layout: Layout, wrap: bool = True) -> DataFrame:
    """Deal rows to ranks by position.

    With ``wrap`` the first rows are dealt again until all ranks hold equally many;
    the copies are made row by row, without another scan.
    """
    ranks = F.lit(layout.ranks)
    if wrap:
        full = ceil_div("idx_total", layout.ranks) * ranks
        places = F.sequence(F.col("idx"), full - F.lit(1), F.col("idx_total"))
        ordered = ordered.withColumn("idx", F.explode(places))
    return ordered.withColumn("rank", F.pmod("idx", ranks).cast("int")).withColumn(
        "rank_idx", whole_div("idx", layout.ranks)
    )


def step_batches(sharded: DataFrame, layout: Layout) -> DataFrame:
    """Add ``step``, ``micro`` (micro-batch of the step) and ``slot`` (row of the
    micro-batch); the last batch of a rank may be short."""
    nth = whole_div("rank_idx", layout.batch)
    return (
        sharded.withColumn("step", whole_div(nth, layout.accumulation))
        .withColumn("micro", F.pmod(nth, F.lit(layout.accumulation)).cast("int"))
        .withColumn("slot", F.pmod("rank_idx", F.lit(layout.batch)).cast("int"))
    )


def batch_plan(
    df: DataFrame, key: str, length: str, layout: Layout, seed: int, epoch: int = 0,
    wrap: bool = True, digits: int | None = None,
) -> DataFrame:
    """The narrow plan table: key, rank, step, micro, slot, length and padded width."""
    narrow = df.select(key, F.col(length).alias("length"))
    ordered = seeded_order(narrow, key, seed, epoch, digits)
    placed = step_batches(rank_shards(ordered, layout, wrap), layout)
    # A micro-batch has at most ``batch`` rows, so this window stays small.
    width = F.max("length").over(Window.partitionBy("rank", "step", "micro"))
    return placed.withColumn("width", width).drop("idx_total", "rank_idx")


def place_rows(tokens: DataFrame, plan: DataFrame, key: str, ids: str) -> DataFrame:
    """The token rows with their places, still without pads.

    Token files are far smaller than the arrays in them, hence the hint against
    broadcasting them by file size.
    """
    joined = plan.join(tokens.select(key, F.col(ids).alias("ids")).hint("merge"), key)
    return joined.select(key, "rank", "step", "micro", "slot", "length", "width", "ids")


def pad_rows(placed: DataFrame, key: str, pad: int) -> DataFrame:
    """Placed rows padded to the width of their batch, with mask and labels."""
    ids, width = "ids", F.col("width")
    return placed.select(
        key, "rank", "step", "micro", "slot", "length", "width",
        padded(ids, width, pad).alias("input_ids"),
        padded_mask(ids, width).alias("attention_mask"),
        padded_labels(ids, width).alias("labels"),
    )


def pad_batches(tokens: DataFrame, plan: DataFrame, key: str, ids: str, pad: int) -> DataFrame:
    """Join the plan to the token rows and pad each row to the width of its batch.

    Widths come from the narrow plan, so token arrays are shuffled once, by a unique
    key, and padded after that.
    """
    return pad_rows(place_rows(tokens, plan, key, ids), key, pad)


def padding_waste(plan: DataFrame) -> DataFrame:
    """Tokens, padded tokens and the wasted share per rank."""
    return plan.groupBy("rank").agg(
        F.sum("length").alias("tokens"),
        F.sum("width").alias("padded_tokens"),
        (F.lit(1.0) - F.sum("length") / F.sum("width")).alias("waste"),
    )


def run_steps(rows: Column | str, layout: Layout) -> Column:
    """Optimizer steps of one pass over ``rows`` rows."""
    rows = F.col(rows) if isinstance(rows, str) else rows
    return ceil_div(ceil_div(rows, layout.ranks), layout.batch * layout.accumulation)


def checkpoint_schedule(sizes: DataFrame, rows: str, layout: Layout, every: int = SAVE_STEPS) -> DataFrame:
    """One row per checkpoint of each run: multiples of ``every``, and the end."""
    planned = sizes.withColumn("steps", run_steps(rows, layout))
    marks = F.when(
        F.col("steps") >= every, F.sequence(F.lit(every).cast("long"), F.col("steps"), F.lit(every).cast("long"))
    ).otherwise(F.array().cast("array<bigint>"))
    steps = F.array_distinct(F.concat(marks, F.array("steps")))
    return planned.withColumn("step", F.explode(steps))


def keep_newest(checkpoints: DataFrame, run: str, step: str, limit: int = SAVE_TOTAL_LIMIT) -> DataFrame:
    """The newest ``limit`` checkpoints of each run.

    A bounded row number per group is cut down before the shuffle.
    """
    newest = Window.partitionBy(run).orderBy(F.desc(step))
    return checkpoints.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= limit).drop("_n")


def resume_point(checkpoints: DataFrame, run: str, step: str, rule: str = "fixed", at: int = SAVE_STEPS) -> DataFrame:
    """Step to resume each run from, null for a fresh start.

    ``fixed`` looks for the one checkpoint at step ``at``; ``newest`` takes the last.
    """
    found = F.max(F.when(F.col(step) == at, F.col(step))) if rule == "fixed" else F.max(step)
    return checkpoints.groupBy(run).agg(found.alias("resume_step"))


def downsample_metrics(metrics: DataFrame, step: str, value: str, run: str | None = None,
                       every: int = LOGGING_STEPS) -> DataFrame:
    """One row per ``every`` steps: the last step and the mean value since the last row."""
    bucket = whole_div(F.col(step) - 1, every).alias("bucket")
    keys = [run, bucket] if run else [bucket]
    return metrics.groupBy(*keys).agg(F.max(step).alias("last_step"), F.avg(value).alias("mean_value"))
