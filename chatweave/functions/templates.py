"""Chat templates as data.

A template says what is written around the messages of each role, what becomes of a system message,
and what opens an answer; ``compile_template`` makes expressions over message arrays of it. Templates can be kept as JSON.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatweave.functions.text import strip

RULES = ("turn", "first_user", "drop")


@dataclass(frozen=True)
class ChatTemplate:
    """``turns``: role to the texts before and after its messages.

    ``system``: a system message at the start is a ``turn`` of its own, is put into the ``first_user``
    message between the two texts of ``system_marks``, or is dropped. ``default_system`` stands in
    where there is none. ``start`` opens the text, ``answer`` opens an answer that is to be written.
    With ``trim`` contents lose white space at both ends.
    """

    name: str
    turns: dict[str, tuple[str, str]]
    start: str = ""
    answer: str = ""
    system: str = "turn"
    system_marks: tuple[str, str] = ("", "")
    default_system: str | None = None
    trim: bool = False

    def __post_init__(self) -> None:
        if self.system not in RULES:
            raise ValueError(f"{self.name}: system must be one of {RULES}")
        if "user" not in self.turns or "assistant" not in self.turns:
            raise ValueError(f"{self.name}: turns must have user and assistant")
        if self.system == "turn" and "system" not in self.turns:
            raise ValueError(f"{self.name}: turns must have system, or another rule for it")
        if any(len(marks) != 2 or not all(isinstance(m, str) for m in marks) for marks in (*self.turns.values(), self.system_marks)):
            raise ValueError(f"{self.name}: marks are two texts")

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> ChatTemplate:
        given = json.loads(text)
        unknown = set(given) - set(cls.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown fields {sorted(unknown)}")
        if "system_marks" in given:
            given["system_marks"] = tuple(given["system_marks"])
        given["turns"] = {role: tuple(marks) for role, marks in given.get("turns", {}).items()}
        return cls(**given)


# Marks of public templates.
CHATML = ChatTemplate(
    "chatml", {r: (f"<|im_start|>{r}\n", "<|im_end|>\n") for r in ("system", "user", "assistant")},
    answer="<|im_start|>assistant\n")
HEADERS = ChatTemplate(
    "headers", {r: (f"<|start_header_id|>{r}<|end_header_id|>\n\n", "<|eot_id|>") for r in ("system", "user", "assistant")},
    start="<|begin_of_text|>", answer="<|start_header_id|>assistant<|end_header_id|>\n\n", trim=True)
INST = ChatTemplate(
    "inst", {"user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>")},
    system="first_user", system_marks=("<<SYS>>\n", "\n<</SYS>>\n\n"), trim=True)
TEMPLATES = {t.name: t for t in (CHATML, HEADERS, INST)}


def compile_template(template: ChatTemplate, messages: Column | str, answer: bool = False) -> Column:
    """The text of a message array; a message of another role stops the job.

    Null contents are empty; a null array is a null text. Where the rule is not ``turn``, a system
    message can only be the first one, and one for the ``first_user`` message needs such a message after it.
    """
    m = F.col(messages) if isinstance(messages, str) else messages

    def content(x: Column) -> Column:
        text = F.coalesce(x["content"], F.lit(""))
        return strip(text) if template.trim else text

    def written(x: Column, text: Column) -> Column:
        out = F.raise_error(F.concat(F.lit(f"{template.name}: no marks for role "), F.coalesce(x["role"], F.lit("null"))))
        for role, (before, after) in reversed(template.turns.items()):
            out = F.when(x["role"] == role, F.concat(F.lit(before), text, F.lit(after))).otherwise(out)
        return out

    first = F.get(m, F.lit(0))
    given = F.coalesce(first["role"] == "system", F.lit(False))
    default = template.default_system
    if template.system == "turn":
        text = F.array_join(F.transform(m, lambda x: written(x, content(x))), "")
        if default is not None:
            before, after = template.turns["system"]
            text = F.concat(F.when(given, "").otherwise(before + default + after), text)
    else:
        rest = F.when(given, F.slice(m, 2, F.greatest(F.size(m) - 1, F.lit(0)))).otherwise(m)
        text = F.array_join(F.transform(rest, lambda x: written(x, content(x))), "")
        if template.system == "first_user":
            system = F.when(given, content(first))
            if default is not None:
                system = F.coalesce(system, F.lit(default))
            opened, closed = template.system_marks
            head = F.when(system.isNotNull(), F.concat(F.lit(opened), system, F.lit(closed))).otherwise("")
            text = F.array_join(F.transform(rest, lambda x, i: written(
                x, F.when((i == 0) & (x["role"] == "user"), F.concat(head, content(x))).otherwise(content(x)))), "")
    return F.concat(F.lit(template.start), text, F.lit(template.answer if answer else ""))
