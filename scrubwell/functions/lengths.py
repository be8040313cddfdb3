"""Length rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubwell import rules
from scrubwell.functions.text import sentences, strip, tokens


def null_short(text: Column, min_chars: int) -> Column:
    """NULL for texts with fewer than ``min_chars`` characters."""
    return F.when(F.length(text) >= min_chars, text)


def truncate_chars(text: Column, max_chars: int) -> Column:
    """The first ``max_chars`` characters without trailing whitespace."""
    edge = rules.SPACE.removeprefix("(?U)")
    cut = F.regexp_replace(F.substring(text, 1, max_chars), rf"(?U){edge}+\z", "")
    return F.when(F.length(text) > max_chars, cut).otherwise(text)


def truncate_tokens(text: Column, max_tokens: int, whole_sentences: bool = True) -> Column:
    """At most ``max_tokens`` tokens, ending after a whole sentence if one fits.

    The running total is folded over the token counts of the sentences, so no
    text is copied before the cut is known.
    """
    words = tokens(text)
    first_words = F.array_join(F.slice(words, 1, max_tokens), " ")
    short = F.size(words) <= max_tokens
    if not whole_sentences:
        return F.when(short, text).otherwise(first_words)
    parts = sentences(text)
    counts = F.transform(parts, lambda sentence: F.size(tokens(sentence)))
    start = F.struct(
        F.lit(0).alias("taken"), F.lit(0).alias("total"), F.lit(True).alias("open")
    )

    def take(state: Column, count: Column) -> Column:
        fits = state["open"] & (state["total"] + count <= max_tokens)
        return F.struct(
            F.when(fits, state["taken"] + 1).otherwise(state["taken"]).alias("taken"),
            F.when(fits, state["total"] + count).otherwise(state["total"]).alias("total"),
            fits.alias("open"),
        )

    taken = F.aggregate(counts, start, take, lambda state: state["taken"])
    whole = strip(F.array_join(F.slice(parts, F.lit(1), taken), " "))
    return F.when(short, text).when(taken > 0, whole).otherwise(first_words)
