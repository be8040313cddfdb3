"""Periodic runs of words, found on a grammar of each text.

A run is a stretch of words that repeats with a period: at least ``REPEATS`` periods
and ``SHORTEST`` words long, and as long as it can be.  Three steps find them all:

1. *Re-Pair.*  The most frequent pairs of neighbouring symbols become new symbols,
   round by round, until no pair of a text occurs twice.  Every pair that comes
   before both its neighbours (by count, then by a scattered number) is replaced in
   the same round, so the rules are balanced and rounds are few.  What is left of a
   text is paired off level by level, which gives every text one root.
2. *Boundaries.*  A run lies whole in the smallest symbol that covers it and crosses
   the boundary of that symbol's two parts.  Two of its periods then lie on one side:
   the right part begins, or the left part ends, with a square of that period.  Such
   squares are known from the parts: a symbol begins with the squares its left part
   begins with, and with longer ones that are looked for once.  Every square at a
   boundary is extended as far as the symbol goes.
3. *Positions.*  What a symbol holds is carried to all its places in the text, and
   stretches of one period that overlap by a period are merged to maximal runs.

Texts of a group share every array operation; no rule spans two texts.  Stretches are
compared by fingerprints, and the runs found are compared word by word; should a
fingerprint ever have been wrong, the group is done again with another base.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORTEST = 6  # words of a run at least
REPEATS = 4  # periods of a run at least
GROUP_CHARS = 3 << 20  # texts of about so many characters are worked on at once
PRIMES = (2147483647, 2147483629)
SCATTER = np.uint64(0x9E3779B1)  # odd: a one-to-one map of 32-bit numbers
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def ragged(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices given by start and size: the number of the slice and the place, one after the other."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    return owner, np.arange(len(owner)) + (starts - (ends - sizes))[owner]


# --- the grammar ------------------------------------------------------------------
class Level:
    """Symbols made in one round: two parts each, and the places they stand at.

    ``start``, ``middle`` and ``end`` give the words of one place of each symbol;
    ``owner`` and ``place`` list all places, ``owner`` counting from ``first``.
    """

    def __init__(self, first, left, right, start, middle, end, owner, place):
        self.first, self.left, self.right = first, left, right
        self.start, self.middle, self.end = start, middle, end
        self.owner, self.place = owner, place


def grammar(words: np.ndarray, bounds: np.ndarray) -> list[Level]:
    """The rules of the texts, in the order they were made; the parts of a rule come before it.

    ``words`` are numbers that no two texts share, ``bounds`` the place after each text.
    """
    levels: list[Level] = []
    symbol = words.astype(np.int64)
    place = np.arange(len(words) + 1)  # where symbols begin, and the end
    last = np.zeros(len(words), bool)
    last[bounds[bounds > 0] - 1] = True
    fresh = int(words.max()) + 1 if len(words) else 0
    often = np.bincount(words, minlength=1) > 1
    live = often[symbol] & ~last
    live[:-1] &= often[symbol[1:]]
    while True:
        at = np.flatnonzero(live)
        chosen, rule = _choose(symbol, at, live)
        if not len(chosen):
            break
        first_of = np.unique(rule, return_index=True)[1]
        model = chosen[first_of]
        levels.append(
            Level(
                fresh, symbol[model], symbol[model + 1],
                place[model], place[model + 1], place[model + 2],
                rule, place[chosen],
            )
        )
        symbol[chosen] = fresh + rule
        fresh += len(model)
        last[chosen] = last[chosen + 1]
        kept = np.ones(len(symbol), bool)
        kept[chosen + 1] = False
        made = np.zeros(len(symbol), bool)
        made[chosen] = True
        made = made[kept]
        symbol, last, live = symbol[kept], last[kept], live[kept]
        place = place[np.append(kept, True)]
        live |= made
        live[:-1] |= made[1:]
        live &= ~last
    return levels + _paired_off(symbol, place, last, fresh)


def _choose(symbol: np.ndarray, at: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the pairs to replace, ascending, and the number of each one's rule.

    Pairs that occur once in the pairs at ``at`` are struck from ``live``.
    """
    nothing = np.empty(0, np.int64)
    if not len(at):
        return nothing, nothing
    pair = symbol[at] << 32 | symbol[at + 1]
    _, group = np.unique(pair, return_inverse=True)
    # of a chain of one symbol every second pair counts
    twin = symbol[at] == symbol[at + 1]
    joined = np.zeros(len(at), bool)
    joined[1:] = twin[1:] & twin[:-1] & (at[1:] == at[:-1] + 1) & (group[1:] == group[:-1])
    number = np.arange(len(at))
    offset = number - np.maximum.accumulate(np.where(joined, 0, number))
    counted = offset % 2 == 0
    times = np.bincount(group, weights=counted).astype(np.int64)
    repeated = times[group] > 1
    live[at[~repeated]] = False
    if not repeated.any():
        return nothing, nothing
    scattered = (group.astype(np.uint64) * SCATTER & np.uint64(0xFFFFFFFF)).astype(np.int64)
    rank = np.zeros(len(symbol) + 2, np.int64)
    rank[at[repeated] + 1] = times[group[repeated]] << 32 | scattered[repeated]
    own, before, after = rank[at + 1], rank[at], rank[at + 2]
    ahead = ((own > before) | (own == before)) & ((own > after) | (own == after))
    picked = repeated & counted & ahead
    picks = np.bincount(group[picked], minlength=len(times))
    picked &= picks[group] > 1
    return at[picked], np.unique(group[picked], return_inverse=True)[1]


def _paired_off(
    symbol: np.ndarray, place: np.ndarray, last: np.ndarray, fresh: int
) -> list[Level]:
    """Neighbours of what is left of each text paired off, until each text is one symbol."""
    levels = []
    while True:
        begins = np.concatenate(([True], last[:-1])) if len(last) else last
        number = np.arange(len(symbol))
        offset = number - np.maximum.accumulate(np.where(begins, number, 0)) if len(last) else number
        taken = np.flatnonzero((offset % 2 == 0) & ~last)
        if not len(taken):
            return levels
        rule = np.arange(len(taken))
        levels.append(
            Level(
                fresh, symbol[taken], symbol[taken + 1],
                place[taken], place[taken + 1], place[taken + 2],
                rule, place[taken],
            )
        )
        symbol[taken] = fresh + rule
        fresh += len(taken)
        last[taken] = last[taken + 1]
        kept = np.ones(len(symbol), bool)
        kept[taken + 1] = False
        symbol, last, place = symbol[kept], last[kept], place[np.append(kept, True)]


# --- comparing stretches -------------------------------------------------------------
class Stretches:
    """Fingerprints of all stretches of a sequence: equal stretches always compare equal."""

    def __init__(self, words: np.ndarray, base: int):
        self.words = words
        self.sums, self.powers = [], []
        for prime in PRIMES:
            power = np.ones(1, np.int64)
            while len(power) <= len(words):
                step = pow(base, len(power), prime)
                power = np.concatenate((power, power * step % prime))
            value = (words.astype(np.int64) * 2654435761 + base) % prime
            sums = np.zeros(len(words) + 1, np.int64)
            np.cumsum(value * power[: len(words)] % prime, out=sums[1:])
            self.sums.append(sums % prime)
            self.powers.append(power)

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches at ``a`` and at the later ``b`` are equal."""
        equal = np.ones(len(a), bool)
        for prime, sums, powers in zip(PRIMES, self.sums, self.powers):
            one = (sums[a + size] - sums[a]) % prime * powers[b - a] % prime
            equal &= one == (sums[b + size] - sums[b]) % prime
        return equal

    def ahead(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words are the same from ``a`` and from the later ``b`` on, ``most`` at most."""
        return self._reach(most, lambda n: self.same(a, b, n))

    def back(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The same for the words before ``a`` and before ``b``."""
        return self._reach(most, lambda n: self.same(a - n, b - n, n))

    @staticmethod
    def _reach(most, holds) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            fits = holds(middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low


# --- runs at boundaries ----------------------------------------------------------------
class Squares:
    """The periods of the squares that symbols begin (or end) with."""

    def __init__(self, symbols: int):
        self.start = np.zeros(symbols, np.int64)
        self.size = np.zeros(symbols, np.int64)
        self.parts = [np.empty(0, np.int64)]
        self.total = 0
        self.values = np.empty(0, np.int64)

    def of(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner, at = ragged(self.start[symbols], self.size[symbols])
        return owner, self.values[at]

    def add(self, first: int, many: int, owner: np.ndarray, period: np.ndarray) -> None:
        if not len(owner):
            return
        order = np.argsort(owner, kind="stable")
        sizes = np.bincount(owner, minlength=many)
        self.start[first : first + many] = self.total + np.cumsum(sizes) - sizes
        self.size[first : first + many] = sizes
        self.values = np.concatenate((self.values, period[order]))
        self.total += len(owner)


def _new_squares(level: Level, longest: np.ndarray, text: Stretches, leading: bool):
    """Squares a symbol begins or ends with that are longer than the part they begin or end in."""
    whole = level.end - level.start
    part = level.middle - level.start if leading else level.end - level.middle
    least = part // 2 + 1
    most = np.minimum(whole // 2, longest)
    owner, period = ragged(least, np.maximum(most - least + 1, 0))
    edge = level.start[owner] if leading else level.end[owner] - 1
    other = edge + period if leading else edge - period
    hit = text.words[edge] == text.words[other]
    owner, period = owner[hit], period[hit]
    first = level.start[owner] if leading else level.end[owner] - 2 * period
    hit = text.same(first, first + period, period)
    return owner[hit], period[hit]


def _found(levels: list[Level], text: Stretches, limit: np.ndarray) -> list[np.ndarray]:
    """``start, end, period`` of stretches in the text, not yet merged.

    ``limit`` holds for every word the longest period a run of its text can have.
    """
    symbols = levels[-1].first + len(levels[-1].left) if levels else 0
    heads, tails = Squares(symbols), Squares(symbols)
    found = []
    for level in levels:
        longest = limit[level.start]
        owner_h, period_h = heads.of(level.right)
        owner_t, period_t = tails.of(level.left)
        owner = np.concatenate((owner_h, owner_t))
        period = np.concatenate((period_h, period_t))
        if len(owner):
            from_right = np.arange(len(owner)) < len(owner_h)
            fits = REPEATS * period <= (level.end - level.start)[owner]
            owner, period, from_right = owner[fits], period[fits], from_right[fits]
            found.append(_crossing(level, owner, period, from_right, text))
        for squares, child, leading in ((heads, level.left, True), (tails, level.right, False)):
            owner, period = squares.of(child)
            more, longer = _new_squares(level, longest, text, leading)
            squares.add(
                level.first, len(child), np.concatenate((owner, more)), np.concatenate((period, longer))
            )
    return [np.concatenate(x) if x else np.empty(0, np.int64) for x in zip(*found)] or [
        np.empty(0, np.int64)
    ] * 3


def _crossing(level: Level, owner, period, from_right, text: Stretches):
    """The squares at boundaries extended as far as their symbols go, at all places of these."""
    middle = level.middle[owner]
    start = np.where(from_right, middle, middle - 2 * period)
    end = start + 2 * period
    start = start - text.back(start, start + period, start - level.start[owner])
    end = end + text.ahead(end - period, end, level.end[owner] - end)
    length = end - start
    runs = (length >= np.maximum(SHORTEST, REPEATS * period)) & (start < middle) & (middle < end)
    owner, period, start, end = owner[runs], period[runs], start[runs], end[runs]
    order = np.lexsort((period, end, start, owner))  # of one stretch the least period counts
    owner, period, start, end = owner[order], period[order], start[order], end[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    owner, period, start, end = owner[new], period[new], start[new], end[new]
    by_owner = np.argsort(level.owner, kind="stable")
    many = np.bincount(level.owner, minlength=len(level.left))
    first = np.cumsum(many) - many
    run, at = ragged(first[owner], many[owner])
    shift = level.place[by_owner[at]] - level.start[owner[run]]
    return start[run] + shift, end[run] + shift, period[run]


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Rows ``start, end, period`` of maximal runs with their least periods, by start and period."""
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    if not len(start):
        return np.empty((0, 3), np.int64)
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(period * far + end) - period * far
    begins = np.ones(len(start), bool)
    begins[1:] = (period[1:] != period[:-1]) | (start[1:] > reach[:-1] - period[1:])
    heads = np.flatnonzero(begins)
    ends = reach[np.append(heads[1:], len(start)) - 1]
    runs = np.stack((start[heads], ends, period[heads]), 1)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _proved(runs: np.ndarray, words: np.ndarray, text_of: np.ndarray) -> bool:
    """Whether all runs repeat with their periods, word by word, and no neighbour goes on."""
    for start, end, period in runs.tolist():
        if (words[start : end - period] != words[start + period : end]).any():
            return False
        for edge, inside in ((start - 1, start - 1 + period), (end, end - period)):
            if 0 <= edge < len(words) and text_of[edge] == text_of[start]:
                if words[edge] == words[inside]:
                    return False
    return True


def find_runs(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows ``start, end, period`` of all runs of the texts, by start, then period."""
    sizes = np.diff(np.concatenate(([0], bounds)))
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    limit = (sizes // REPEATS)[text_of]
    levels = grammar(words, bounds)
    for turn in count():
        text = Stretches(words, 1_000_003 + 7_919 * turn)
        runs = _merged(*_found(levels, text, limit))
        if _proved(runs, words, text_of):
            return runs


# --- texts -------------------------------------------------------------------------------
def _numbered(texts: list[str]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of texts, a number for each word that no two texts share, and the texts' ends."""
    split = [text.encode().split() for text in texts]
    numbers, fresh = [], 0
    for words in split:
        known: dict[bytes, int] = {}
        local = [known.setdefault(word, len(known)) for word in words]
        numbers.append(np.array(local, np.int64) + fresh)
        fresh += len(known)
    bounds = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))
    return split, np.concatenate(numbers) if numbers else np.empty(0, np.int64), bounds


def described(texts: list[str]) -> list[tuple[int, list, str]]:
    """Number of words, runs and collapsed text of each text."""
    split, words, bounds = _numbered(texts)
    runs = find_runs(words, bounds)
    drops = np.zeros(len(words) + 1, np.int64)
    np.add.at(drops, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drops, runs[:, 1], -1)
    kept = np.cumsum(drops[:-1]) == 0
    firsts = np.concatenate(([0], bounds[:-1])) if len(bounds) else bounds
    edges = np.searchsorted(runs[:, 0], np.concatenate((firsts, [len(words)])))
    rows = []
    for i, own in enumerate(split):
        first, held = int(firsts[i]), runs[edges[i] : edges[i + 1]]
        if len(held):
            stays = kept[first : first + len(own)].tolist()
            own = [word for word, stay in zip(own, stays) if stay]
        told = [
            {"start": s - first, "length": e - s, "period": p} for s, e, p in held.tolist()
        ]
        rows.append((len(split[i]), told, b" ".join(own).decode()))
    return rows


def _groups(texts: Iterator[str]) -> Iterator[list[str]]:
    group, held = [], 0
    for text in texts:
        group.append(text)
        held += len(text)
        if held >= GROUP_CHARS:
            yield group
            group, held = [], 0
    if group:
        yield group


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``<key>, n_words, runs, collapsed`` for every row.

    Words are runs without ASCII white space, numbered from 0.  ``runs`` lists
    ``start, length, period`` of every run by start, then period; ``period`` is the
    least one.  ``collapsed`` is the text's words joined by one space, without those
    that a run holds after its first period.  Null and empty texts have no words, no
    runs and an empty ``collapsed``; rows that repeat a key each get a row, null keys
    stay null; other columns are ignored, an empty table gives an empty one.  A text is
    worked on whole in the task that reads it: no shuffle, memory in proportion to the
    longest text or to ``GROUP_CHARS``.
    """
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in _groups(value.as_py() or "" for value in batch.column(1)):
                sizes, runs, collapsed = zip(*described(group))
                columns = [
                    batch.column(0).slice(at, len(group)),
                    pa.array(sizes, pa.int64()),
                    pa.array(runs, pa.list_(RUN)),
                    pa.array(collapsed, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "runs", "collapsed"])
                at += len(group)

    kind = named.schema["key"].dataType.simpleString()
    found = named.mapInArrow(
        describe,
        f"key {kind}, n_words bigint, "
        "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string",
    )
    return found.withColumnRenamed("key", key)
