"""Expressions over token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters in a run, single digits, other marks in a run.
# The blank class is spelled out, as engines differ on \s.
PIECE_PATTERN = r"\p{L}+|\p{N}|[^\t\n\x0b\x0c\r \p{L}\p{N}]+"

# Length limits of the preparation and of the training stage.
PREPARE_MAX_LENGTH = 2048
TRAIN_MAX_LENGTH = 1024

IGNORED_LABEL = -100


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pieces(text: Column | str) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(PIECE_PATTERN), F.lit(0))


def byte_ids(text: Column | str) -> Column:
    """UTF-8 bytes as ids: each byte becomes one Latin-1 character, whose code
    point is the byte."""
    latin = F.decode(F.encode(_col(text), "UTF-8"), "ISO-8859-1")
    # The split ends with an empty string, which the slice leaves out.
    chars = F.slice(F.split(latin, ""), 1, F.length(latin))
    return F.transform(chars, lambda ch: F.ascii(ch))


def truncate(ids: Column | str, *limits: int) -> Column:
    """Keep the prefix; several limits in a row fold to the smallest."""
    return F.slice(_col(ids), 1, min(limits))


def attention_mask(ids: Column | str) -> Column:
    return F.array_repeat(F.lit(1), F.size(_col(ids)))


def pad_id(pad: int | None, eos: int) -> int:
    """The padding id defaults to the end-of-sequence id."""
    return eos if pad is None else pad


def _fill(value: int, ids: Column, width: Column) -> Column:
    return F.array_repeat(F.lit(value), (width - F.size(ids)).cast("int"))


def padded(ids: Column | str, width: Column, pad: int) -> Column:
    ids = _col(ids)
    return F.concat(ids, _fill(pad, ids, width))


def padded_mask(ids: Column | str, width: Column) -> Column:
    ids = _col(ids)
    return F.concat(attention_mask(ids), _fill(0, ids, width))


def padded_labels(ids: Column | str, width: Column) -> Column:
    """Every real token is trained; pads carry the ignored label."""
    ids = _col(ids)
    return F.concat(ids, _fill(IGNORED_LABEL, ids, width))


def new_tokens(output: Column | str, prompt_length: Column | str) -> Column:
    """Drop the prompt from a generated sequence."""
    out, n = _col(output), _col(prompt_length).cast("int")
    return F.slice(out, n + F.lit(1), F.greatest(F.size(out), F.lit(1)))


def without_ids(ids: Column | str, dropped: tuple[int, ...]) -> Column:
    # One generated loop per id beats an interpreted lambda for a few special ids.
    kept = _col(ids)
    for x in dropped:
        kept = F.array_remove(kept, x)
    return kept
