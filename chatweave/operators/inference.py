"""Batched maps and batch inference with a user-supplied model."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GenerationOptions:
    max_new_tokens: int = 2048
    do_sample: bool = True
    temperature: float = 0.7
    top_p: float = 0.9
    top_k: int = 50

    def arguments(self) -> dict:
        """Sampling arguments are passed only when sampling; temperature 0 is greedy."""
        sampling = self.do_sample and self.temperature > 0
        args = {"max_new_tokens": self.max_new_tokens, "do_sample": sampling}
        if sampling:
            args |= {"temperature": self.temperature, "top_p": self.top_p, "top_k": self.top_k}
        return args


def batched_map(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, batch_size: int = 10_000
) -> DataFrame:
    """Map pandas batches of ``batch_size`` rows, the last of a partition being shorter;
    the output has the columns of ``schema`` only. Partitions run in parallel."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n < batch_size:
                continue
            rows = pd.concat(held, ignore_index=True)
            whole = n - n % batch_size
            for start in range(0, whole, batch_size):
                yield fn(rows.iloc[start:start + batch_size].reset_index(drop=True))
            held, n = [rows.iloc[whole:]], n - whole
        if n:
            yield fn(pd.concat(held, ignore_index=True))

    return df.mapInPandas(run, schema)


# Models of this worker process, by the id of the function that uses them.
_MODELS: dict[str, Callable] = {}


def _model(key: str, factory: Callable[[], Callable]) -> Callable:
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = factory()
    return _MODELS[key]


def generator(
    factory: Callable[[], Callable], options: GenerationOptions = GenerationOptions(),
    batch_size: int | None = None,
) -> Callable[[Column | str], Column]:
    """Prompt text to ``struct<response, error>``.

    ``factory`` builds the model once per worker process. With a ``batch_size`` the model is
    called with lists of at most so many prompts and the generation arguments, and answers
    each; if a call fails, its prompts are tried one by one. Without, it is called with one
    prompt. A failing row yields an error, not a failed job.
    """
    arguments, key = options.arguments(), uuid.uuid4().hex

    @F.pandas_udf("struct<response:string,error:string>")
    def generate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        built = _model(key, factory)
        model = built if batch_size else lambda prompts, **kw: [built(p, **kw) for p in prompts]
        size = batch_size or 1

        def answers(prompts: list[str]) -> list[tuple[str | None, str | None]]:
            try:
                said = model(prompts, **arguments)
                if len(said) != len(prompts):
                    raise ValueError(f"{len(said)} answers to {len(prompts)} prompts")
                return [(x, None) for x in said]
            except Exception as e:
                if len(prompts) == 1:
                    return [(None, f"{type(e).__name__}: {e}")]
                return [x for p in prompts for x in answers([p])]

        for batch in batches:
            prompts = batch.tolist()
            rows = [x for i in range(0, len(prompts), size) for x in answers(prompts[i:i + size])]
            yield pd.DataFrame(rows, columns=["response", "error"])

    return generate


def infer(
    prompts: DataFrame, prompt: str, factory: Callable[[], Callable],
    options: GenerationOptions = GenerationOptions(), batch_size: int | None = None,
) -> DataFrame:
    """Add ``response`` and ``error`` to a prompt table."""
    answered = prompts.withColumn("_a", generator(factory, options, batch_size)(F.col(prompt)))
    return answered.select(*prompts.columns, "_a.response", "_a.error")
