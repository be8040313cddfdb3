"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton accepts every run of words of every item.  A document's words
stream through it and the longest run ending at each word is tracked; where it
reaches the window, the words it covers are hit.  The items of a block, never
more than ``block_words`` words, make one automaton, so memory has a bound
whatever the benchmark's size; documents pass once over each block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubwell.session import stage

WINDOW = 10
BLOCK_WORDS = 100_000
HIT_COLUMN = "__hit"

# Bytes of a word stay (A-Z lower-cased), all others become a space.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split() if text else []


class Automaton:
    """A suffix automaton over words, of all items together.

    ``items_at[state]`` are the items with a window whose words end in the state's
    class; ``short_at[state]`` maps the length of a whole short item to its ids.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = [(item, self._add(words), len(words)) for item, words in items if words]
        self.shortest = min((min(size, window) for _, _, size in ends), default=window)
        self.items_at: dict[int, set[str]] = {}
        self.short_at: dict[int, dict[int, set[str]]] = {}
        for item, path, size in ends:
            if size < window:
                state = self._holder(path[-1], size)
                self.short_at.setdefault(state, {}).setdefault(size, set()).add(item)
            else:
                for state in path[window - 1 :]:
                    self.items_at.setdefault(self._holder(state, window), set()).add(item)

    def _add(self, words: list[bytes]) -> list[int]:
        """Insert one item; the states of its prefixes."""
        last, path = 0, []
        for word in words:
            last = self._extend(last, self.ids.setdefault(word, len(self.ids) + 1))
            path.append(last)
        return path

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._split(last, word, known)
        made = self._state(self.length[last] + 1, {}, 0)
        while last != -1 and word not in self.next[last]:
            self.next[last][word] = made
            last = self.link[last]
        if last != -1:
            target = self.next[last][word]
            exact = self.length[target] == self.length[last] + 1
            self.link[made] = target if exact else self._split(last, word, target)
        return made

    def _split(self, last: int, word: int, target: int) -> int:
        """Part the shorter runs of ``target`` off into a state of their own."""
        twin = self._state(self.length[last] + 1, dict(self.next[target]), self.link[target])
        while last != -1 and self.next[last].get(word) == target:
            self.next[last][word] = twin
            last = self.link[last]
        self.link[target] = twin
        return twin

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _holder(self, state: int, length: int) -> int:
        """The state that holds the last ``length`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= length and self.link[state] > 0:
            state = self.link[state]
        return state

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans [start, end) of hit words, merged, and the items that occur."""
        spans: list[list[int]] = []
        found: set[str] = set()
        get = self.ids.get
        known = np.fromiter((get(word, 0) for word in words), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known > 0, [0]))))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start >= self.shortest:
                self._walk(known[start:end].tolist(), start, spans, found)
        return [(a, b) for a, b in spans], found

    def _walk(self, ids: list[int], offset: int, spans: list, found: set[str]) -> None:
        state = length = 0
        following, links, lengths = self.next, self.link, self.length
        for place, word in enumerate(ids, offset + 1):
            target = following[state].get(word)
            while target is None and state:
                state = links[state]
                length = lengths[state]
                target = following[state].get(word)
            if target is None:
                continue
            state, length = target, length + 1
            if length < self.shortest:
                continue
            covered = 0
            if length >= self.window:
                covered = self.window
                found |= self.items_at.get(self._holder(state, covered), set())
            if self.short_at:
                covered = max(covered, self._short(state, length, found))
            if covered:
                start = place - covered
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, place])

    def _short(self, state: int, length: int, found: set[str]) -> int:
        """The longest whole short item that ends here."""
        longest = 0
        while state > 0:
            for size, items in self.short_at.get(state, {}).items():
                if size <= length:
                    found |= items
                    longest = max(longest, size)
            state = self.link[state]
            length = min(length, self.length[state])
        return longest


HIT = "struct<n_words: bigint, spans: array<struct<start: bigint, stop: bigint>>, items: array<string>>"


def _search(text: Column, shared) -> Column:
    """One pass over an automaton that was broadcast."""

    @F.arrow_udf(HIT)
    def search(texts: pa.Array) -> pa.Array:
        automaton: Automaton = shared.value
        counts, spans, items = [], [], []
        for text in texts:
            words = words_of(text.as_py())
            hit, found = automaton.matches(words)
            counts.append(len(words))
            spans.append([{"start": a, "stop": b} for a, b in hit])
            items.append(sorted(found))
        span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
        return pa.StructArray.from_arrays(
            [
                pa.array(counts, pa.int64()),
                pa.array(spans, pa.list_(span)),
                pa.array(items, pa.list_(pa.string())),
            ],
            names=["n_words", "spans", "items"],
        )

    return search(text)


def _automata(items: DataFrame, window: int, key: str, text: str, block_words: int) -> Iterator:
    """Broadcasts of the blocks' automata, one after the other.

    Items are dealt out by hash to as many blocks as the words need, so a block
    has about ``block_words`` words (or one item that is longer).
    """
    spark = items.sparkSession
    named = items.select(
        F.col(key).cast("string").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    # Every second byte can start a word at most.
    most = named.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    blocks = max(1, int(most // (4 * block_words)) + 1)
    dealt = named.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    if blocks > 1:
        dealt = stage(dealt, "items")
    for block in range(blocks):
        rows = dealt.filter(F.col("block") == block).select("item", "text").toLocalIterator()
        texts = [(row.item or "", words_of(row.text)) for row in rows]
        yield spark.sparkContext.broadcast(Automaton(texts, window))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch made one."""
    merged: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if merged and start <= merged[-1][1]:
            start, stop = merged[-1][0], max(stop, merged.pop()[1])
        merged.append((start, stop))
    return merged


def _merged(groups: Column) -> Column:
    @F.arrow_udf("array<struct<start: bigint, stop: bigint>>")
    def merged(groups: pa.Array) -> pa.Array:
        span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
        done = []
        for group in groups:
            found = [(one["start"], one["stop"]) for one in group.as_py()]
            done.append([{"start": a, "stop": b} for a, b in merge(found)])
        return pa.array(done, pa.list_(span))

    return merged(groups)


def with_hits(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with a column HIT_COLUMN of ``n_words, spans, items`` per row.

    ``spans`` are the words [start, stop) inside any occurrence of a window:
    ``window`` words in a row of an item, or a whole item that is shorter.
    ``items`` are the ids (as strings, sorted) of the items with an occurring
    window; items without an id count as id "".  Null, empty and wordless texts
    of either table have no words and match nothing; repeated rows are treated
    alike.  Beyond the first block of items the documents are written with what
    was found so far and read again for the next block.
    """
    hit, told = F.col(HIT_COLUMN), docs
    for number, block in enumerate(_automata(items, window, item_key, item_text, block_words)):
        found = _search(F.col(text), block)
        if number:
            told = stage(told, "hits").withColumn("__more", found)
            more = F.col("__more")
            found = F.struct(
                hit["n_words"].alias("n_words"),
                _merged(F.concat(hit["spans"], more["spans"])).alias("spans"),
                F.array_sort(F.array_union(hit["items"], more["items"])).alias("items"),
            )
        told = told.withColumn(HIT_COLUMN, found).drop("__more")
    return told


def hit_words(spans: str) -> Column:
    return F.expr(f"aggregate({spans}, 0L, (n, s) -> n + s.stop - s.start)")


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """``<key>, n_words, n_hit, n_items, items_sha256, contaminated`` for every row."""
    told = with_hits(docs.select(key, F.col(text).alias("text")), items, **options)
    return told.select(key, HIT_COLUMN + ".*").select(
        key,
        "n_words",
        hit_words("spans").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def cut_spans(text: Column, spans: Column) -> Column:
    """The text without the words of its spans and what stands between them."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        done = []
        for text, group in zip(texts, spans):
            text, at, parts = text.as_py() or "", 0, []
            places = [(m.start(), m.end()) for m in re.finditer(_WORD, text)]
            for one in group.as_py():
                parts.append(text[at : places[one["start"]][0]])
                at = places[one["stop"] - 1][1]
            done.append("".join((*parts, text[at:])))
        return pa.array(done, pa.string())

    return cut(text, spans)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    longest: int = 0,
    coverage: float = 1.0,
    text: str = "text",
    **options,
) -> DataFrame:
    """``docs`` without what the test items cover; the columns as they are.

    A document goes if a span of more than ``longest`` words is hit; from the
    others the hit words are cut, and a document goes too if they are more than
    the share ``coverage`` of its words.  Texts without hits stay byte for byte.
    Of rows that share a key, each is judged by its own text.
    """
    told = with_hits(docs, items, text=text, **options)
    spans = F.col(HIT_COLUMN)["spans"]
    most = F.array_max(F.transform(spans, lambda s: s["stop"] - s["start"]))
    hit = hit_words(HIT_COLUMN + ".spans")
    kept = told.filter(
        (F.coalesce(most, F.lit(0)) <= longest) & (hit <= coverage * F.col(HIT_COLUMN)["n_words"])
    )
    if longest:
        cut = F.when(F.size(spans) > 0, cut_spans(F.col(text), spans)).otherwise(F.col(text))
        kept = kept.withColumn(text, cut)
    return kept.select(*docs.columns)
