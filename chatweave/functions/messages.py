"""Message arrays and chat templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatweave.schemas import MESSAGES

# The public ChatML markers.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def message(role: str | Column, content: Column | str) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), _col(content).alias("content"))


def no_messages() -> Column:
    return F.array().cast(MESSAGES)


def instruction_pair(prompt: Column | str, answer: Column | str) -> Column:
    return F.array(message("user", prompt), message("assistant", answer)).cast(MESSAGES)


def system_prefix(system: Column | str) -> Column:
    """One system message if the text is present and not empty, else nothing.

    Blanks alone count as present.
    """
    c = _col(system)
    return F.when(
        c.isNotNull() & (c != ""), F.array(message("system", c)).cast(MESSAGES)
    ).otherwise(no_messages())


def prompt_messages(prompt: Column | str, system: Column | str | None = None) -> Column:
    user = F.array(message("user", prompt)).cast(MESSAGES)
    return user if system is None else F.concat(system_prefix(system), user)


def render_message(role: Column, content: Column) -> Column:
    return F.concat(
        F.lit(TURN_START), role, F.lit("\n"), F.coalesce(content, F.lit("")), F.lit(TURN_END + "\n")
    )


def render(
    messages: Column | str,
    default_system: str | None = None,
    generation_prompt: bool = False,
) -> Column:
    """ChatML text of a message array.

    ``default_system`` is put in front when the first message is not a system
    one; ``generation_prompt`` opens an assistant turn at the end.
    """
    m = _col(messages)
    text = F.array_join(
        F.transform(m, lambda x: render_message(x["role"], x["content"])), ""
    )
    if default_system is not None:
        first_role = F.try_element_at(m, F.lit(1))["role"]
        head = render_message(F.lit("system"), F.lit(default_system))
        text = F.concat(
            F.when(F.coalesce(first_role, F.lit("")) == "system", "").otherwise(head), text
        )
    if generation_prompt:
        text = F.concat(text, F.lit(f"{TURN_START}assistant\n"))
    return text


def last_messages(messages: Column | str, n: int = 20) -> Column:
    """The last ``n`` elements, also of shorter arrays."""
    m = _col(messages)
    return F.slice(m, F.greatest(F.size(m) - F.lit(n - 1), F.lit(1)), F.lit(n))
