"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Whitespace tokens, the default tokenizer."""
    return F.array_remove(F.split(text, r"[ \t\n\r]+"), "")


def is_blank(text: Column) -> Column:
    """Nothing is left after stripping Unicode white space and separators."""
    return ~text.rlike(r"(?U)[^\s\x1c-\x1f]")


def is_truthy(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def pair_prompt(first: Column, second: Column) -> Column:
    """One text for a premise and a hypothesis; a missing side is written as None."""
    none = F.lit("None")
    return F.concat(
        F.lit("Premise: "), F.coalesce(first, none), F.lit(" Hypothesis: "), F.coalesce(second, none)
    )


def shorten(name: Column) -> Column:
    """Names over 50 characters: the first 48 and two dots."""
    return F.when(F.length(name) > 50, F.concat(F.substring(name, 1, 48), F.lit(".."))).otherwise(name)


def unit_score(score: Column) -> Column:
    """A 0-5 score, possibly text, as 0-1."""
    return score.cast("double") / 5.0
