"""Batch generation: prompts to messages, text, responses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatweave.functions.messages import prompt_messages, render
from chatweave.operators.inference import GenerationOptions, infer


def prompt_texts(prompts: DataFrame, prompt: str = "prompt", system: str | None = None,
                 default_system: str | None = None) -> DataFrame:
    """Add ``text``, the rendered prompt with an opened assistant turn."""
    messages = prompt_messages(F.col(prompt), F.col(system) if system else None)
    return prompts.withColumn("text", render(messages, default_system, generation_prompt=True))


def answer_prompts(
    prompts: DataFrame, factory: Callable[[], Callable], prompt: str = "prompt",
    system: str | None = None, options: GenerationOptions = GenerationOptions(), batch_size: int | None = None,
) -> DataFrame:
    return infer(prompt_texts(prompts, prompt, system), "text", factory, options, batch_size)
