"""Repeated words and sentences inside one text."""

import heapq

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubwell.functions.text import has_code, let, sentences, space_tokens


def drop_adjacent(items: Column) -> Column:
    """Keep an item unless it equals the item right before it."""
    return let(
        items,
        lambda all_items: F.filter(
            all_items,
            lambda item, place: (place == 0) | (item != F.get(all_items, place - 1)),
        ),
    )


def _thinner(min_gap: int):
    """The Arrow function for gaps above two.

    Its helpers live inside it, so it reaches the workers whole.
    """

    def thin_out(items: list[str]) -> list[str]:
        """Drop places of a value closer than the gap to its place before, value by value.

        The value whose first place comes first goes next.  Gaps run between
        places as they stand, those about to go included; a deletion can only bring
        the few places behind it too close, so only they are looked at again.
        First places never go, so the order of values is fixed.
        """
        end = len(items)
        before, after = list(range(-1, end)), list(range(1, end + 2))
        first: dict[str, int] = {}
        close: dict[str, set[int]] = {}
        waiting: list[tuple[int, str]] = []

        def too_close(place: int) -> bool:
            back = before[place]
            for _ in range(min_gap - 1):
                if back < 0:
                    return False
                if items[back] == items[place]:
                    return True
                back = before[back]
            return False

        def look_at(place: int) -> None:
            if too_close(place):
                value = items[place]
                if value not in close:
                    close[value] = set()
                    heapq.heappush(waiting, (first[value], value))
                close[value].add(place)

        for place, item in enumerate(items):
            first.setdefault(item, place)
            look_at(place)
        gone = set()
        while waiting:
            _, value = heapq.heappop(waiting)
            doomed = [place for place in close.pop(value) if too_close(place)]
            behind = set()
            for place in doomed:
                after[before[place]] = after[place]
                before[after[place]] = before[place]
            gone.update(doomed)
            for place in doomed:
                step = after[place]
                for _ in range(min_gap - 1):
                    while step in gone:
                        step = after[step]
                    if step >= end:
                        break
                    behind.add(step)
                    step = after[step]
            for place in behind:
                look_at(place)
        return [item for place, item in enumerate(items) if place not in gone]

    def thin_sentences(found):
        if found is None:
            return None
        kept = []
        for sentence in thin_out(found):
            body = sentence[:-1] if sentence[-1] in ".?!" else sentence
            kept.append(" ".join(thin_out(body.split(" "))) + sentence[len(body) :])
        return kept

    def thin(lists: pd.Series) -> pd.Series:
        return lists.map(thin_sentences)

    return F.pandas_udf(thin, "array<string>")


def split_sentences(text: Column) -> Column:
    """Non-blank sentences."""
    return F.filter(sentences(text), lambda sentence: sentence.rlike(r"\S"))


def _without_repeated_words(sentence: Column) -> Column:
    """The closing mark is set aside, so ``go go.`` holds the word twice."""
    last = F.right(sentence, F.lit(1))
    marked = last.isin(".", "?", "!")
    body = F.when(marked, F.left(sentence, F.length(sentence) - 1)).otherwise(sentence)
    end = F.when(marked, last).otherwise("")
    return F.concat(F.array_join(drop_adjacent(space_tokens(body)), " "), end)


def dedupe_sentences(text: Column) -> Column:
    """Delete a sentence equal to the one before it; texts with code stay."""
    kept = F.array_join(drop_adjacent(split_sentences(text)), " ")
    return F.when(has_code(text), text).otherwise(kept)


def dedupe_words(text: Column) -> Column:
    """Delete a word equal to the word before it, sentence by sentence."""
    cleaned = F.transform(split_sentences(text), _without_repeated_words)
    return F.when(has_code(text), text).otherwise(F.array_join(cleaned, " "))


def drop_repeats(text: Column, min_gap: int = 2) -> Column:
    """Repeated sentences, then repeated words, closer than ``min_gap`` go.

    A gap of two means adjacent repeats and is plain array work.  With larger
    gaps a deletion changes the gaps of all that follows, which array
    expressions cannot state, so an Arrow function thins the sentence lists.
    """
    if min_gap <= 1:
        return text
    if min_gap == 2:
        kept = drop_adjacent(split_sentences(text))
        cleaned = F.array_join(F.transform(kept, _without_repeated_words), " ")
        return F.when(has_code(text), text).otherwise(cleaned)

    plain = F.when(~has_code(text), split_sentences(text))
    return F.when(has_code(text), text).otherwise(F.array_join(_thinner(min_gap)(plain), " "))
