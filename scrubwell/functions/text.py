"""Column helpers shared by all text steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubwell import rules


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once and use it many times in one expression.

    Inside a lambda nothing is shared: an array built there and looked up per
    element would be rebuilt per element.  A one-element array binds it.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends (``trim`` only knows the space)."""
    edge = rules.SPACE.removeprefix("(?U)")
    return F.regexp_replace(text, rf"(?U)^{edge}+|{edge}+\z", "")


def has_code(text: Column) -> Column:
    """True when the text holds a code span.

    A closed fence contains six backticks, and any two backticks enclose an
    inline span, so one pattern answers for both.  ``contains`` is a plain byte
    search that settles nearly every text.
    """
    return text.contains("`") & text.rlike(rules.CODE_INLINE)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\D", "")


def literal_replacement(token: str) -> str:
    """Escape ``\\`` and ``$``, which name groups in a replacement string."""
    return token.replace("\\", "\\\\").replace("$", "\\$")


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def replace_matches(
    text: Column, pattern: str, change: Callable[[Column], Column], hits: Column | None = None
) -> Column:
    """Replace every match by ``change(match)`` using only built-in expressions.

    The text between matches and the matches are two arrays; the changed
    matches are zipped back between the gaps.
    """
    hits = matches(text, pattern) if hits is None else hits
    gaps = F.split(text, pattern, -1)
    changed = F.concat(F.transform(hits, change), F.array(F.lit("")))
    rejoined = F.array_join(F.zip_with(gaps, changed, lambda gap, hit: F.concat(gap, hit)), "")
    return rejoined


def sentences(text: Column) -> Column:
    """Cut after ``.``, ``?`` or ``!`` followed by whitespace."""
    return F.split(text, rules.SENTENCE_BREAK, -1)


def tokens(text: Column) -> Column:
    """Whitespace-separated tokens, no empty ones."""
    return F.filter(F.split(text, rules.SPACES, -1), lambda word: word != "")


def space_tokens(text: Column) -> Column:
    """Tokens between single spaces; doubled spaces give empty tokens."""
    return F.split(text, " ", -1)


def pieces(text: Column) -> Column:
    """Words, single punctuation marks and single whitespace characters, in order."""
    return matches(text, rules.WORD_PIECES)


def word_pieces(text: Column) -> Column:
    """Runs of word characters and single other characters, in order: cut at every word boundary."""
    return matches(text, rules.WORDS_AND_MARKS)


def characters(text: Column) -> Column:
    """One array element per code point."""
    return F.split(text, "", -1)


def character_grams(text: Column, size: int) -> Column:
    """All overlapping runs of ``size`` characters.

    Indexing an array is constant time, ``substring`` is not: it would walk the
    text from the start for every run.
    """
    return let(
        characters(text),
        lambda chars: F.transform(
            F.when(F.length(text) >= size, F.sequence(F.lit(0), F.length(text) - size)).otherwise(
                F.array().cast("array<int>")
            ),
            lambda at: F.concat(*[F.get(chars, at + offset) for offset in range(size)]),
        ),
    )


def splice(parts: Column, edits: Column) -> Column:
    """Join ``parts``, putting ``edits`` in place of the runs they name.

    ``edits`` is an array of ``struct(pos, len, token)`` in order of ``pos``
    without overlaps.  Each stretch between edits is sliced once, so the work
    grows with the text and not with text times edits.
    """

    def edge(at: Column) -> Column:
        edit = F.get(edits, at)
        return F.coalesce(edit["pos"] + edit["len"], F.lit(0))

    def stretch(edit: Column, at: Column) -> Column:
        start = edge(at - 1)
        kept = F.slice(parts, start + 1, edit["pos"] - start)
        return F.concat(F.array_join(kept, ""), edit["token"])

    last = edge(F.size(edits) - 1)
    tail = F.array_join(F.slice(parts, last + 1, F.size(parts) - last), "")
    return F.concat(F.array_join(F.transform(edits, stretch), ""), tail)
