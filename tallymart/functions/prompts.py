"""Prompt text rules: preview, emptiness, word count and model routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C

# Fixed value: the white space that separates words is Unicode white space plus the four separators.
WORD_GAP = r"(?U)[\s\x1c-\x1f]+"
WORD_CHAR = r"(?U)[^\s\x1c-\x1f]"


def preview(prompt: Column) -> Column:
    return F.left(prompt, F.lit(C.PREVIEW_CHARS))


def has_text(prompt: Column) -> Column:
    """At least one character that is not white space; NULL prompts have none."""
    return F.coalesce(prompt.rlike(WORD_CHAR), F.lit(False))


def word_count(text: Column) -> Column:
    """Words in the whole text; white space at either end adds none."""
    return F.size(F.array_remove(F.split(text, WORD_GAP), ""))


def contains_any(text: Column, keywords: list[str]) -> Column:
    """Plain substring test: "rapid" contains "api"."""
    return reduce(lambda left, right: left | right, [text.contains(word) for word in keywords])


def choose_model(lowered: Column, words: Column) -> Column:
    """First rule that applies decides; ``lowered`` is the whole prompt in lower case."""
    return (
        F.when(lowered.isNull(), F.lit(None).cast("string"))
        .when(contains_any(lowered, C.SENSITIVE_KEYWORDS), "phi3")
        .when(words < C.SHORT_PROMPT_BELOW, "phi3")
        .when(contains_any(lowered, C.TECHNICAL_KEYWORDS), "mistral")
        .when(words > C.LONG_PROMPT_ABOVE, "mistral")
        .otherwise("llama3.2")
    )
