"""Record formats of the training platforms.

A format is a function from the three texts of a sample (what the system, the user and the assistant
say) to the columns of its record. Beside it stands how records are put into files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

LINES, ARRAY = "jsonl", "json_array"
SPEAKERS = ("system", "user", "assistant")

# System, user and assistant text to the record's columns, in order.
Build = Callable[[Column, Column, Column], list[Column]]


def chat(turns: str, text: str, roles: Sequence[str] = SPEAKERS) -> Build:
    """One column ``turns``: a list of turns, each with its role and its text under ``text``."""

    def build(*said: Column) -> list[Column]:
        each = (
            F.struct(F.lit(role).alias("role"), words.alias(text))
            for role, words in zip(roles, said, strict=True)
        )
        return [F.array(*each).alias(turns)]

    return build


def flat(keys: Sequence[str] = SPEAKERS, constants: Mapping[str, object] | None = None) -> Build:
    """A column for each text, and constants, which win over a text of the same key."""

    def build(*said: Column) -> list[Column]:
        columns = dict(zip(keys, said, strict=True))
        columns.update({key: constant(value) for key, value in (constants or {}).items()})
        return [column.alias(key) for key, column in columns.items()]

    return build


def constant(value: object) -> Column:
    """A literal for any JSON-like value."""
    if isinstance(value, dict):
        return F.struct(*(constant(v).alias(k) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return F.array(*map(constant, value))
    return F.lit(value) if value is not None else F.lit(None).cast("string")


@dataclass(frozen=True)
class RecordFormat:
    """``build``, whether records begin with a running id, and what the files hold and are called."""

    build: Build
    with_id: bool = False
    container: str = LINES
    suffix: str = ".jsonl"


# The key names and role names each platform expects.
FORMATS: dict[str, RecordFormat] = {
    "openai": RecordFormat(chat("messages", "content")),
    "internal": RecordFormat(
        chat("conversations", "context", ("system", "human", "assistant")), with_id=True
    ),
    "ark": RecordFormat(flat(("instruction", "input", "output")), container=ARRAY, suffix=".json"),
}


def get_format(fmt: str | RecordFormat) -> RecordFormat:
    """The format of that name in FORMATS, to which callers may add; a format passes through."""
    if isinstance(fmt, RecordFormat):
        return fmt
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, known: {', '.join(FORMATS)}")
    return FORMATS[fmt]
