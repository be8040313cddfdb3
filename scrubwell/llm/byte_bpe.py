"""Byte-level BPE by replaying the merges over all words of a batch at once.

The distinct words of a batch of texts lie in one chain of tokens.  An inverted
index leads from the rank of a token pair to the places where it stands; pending
ranks are taken in order, a rank's pairs are merged at all their places in one
step, and only the pairs with the touched neighbours enter the index anew.  Texts
are then put together from their words' ids.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the pattern for which words are cut without a regular expression.
CUT_BY_CLASS = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")
LETTER, NUMBER, OTHER, SPACE, END = range(5)
BLOCK_CHARS = 1 << 19  # texts are cut to words in blocks of this length
GROUP_CHARS = 6 << 20  # the words of this much text are merged at once
NONE = np.iinfo(np.int32).max


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of slices given by start and size, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


# --- cutting texts to words ---------------------------------------------------
@cache
def _classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array(
        [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8
    )
    blank = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
    table[[*blank, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return table


def cut_by_class(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin in the UTF-8 bytes of the joined texts, and every text's number of words.

    A word is a run of one class.  The last character of a white space run stands
    alone before other characters, and joins them if it is a space.  An apostrophe
    on its own takes a suffix of SUFFIXES.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le"), np.uint32)
    ends = np.cumsum(sizes + 1) - 1
    kind = _classes()[points]
    kind[ends] = END
    first = np.empty(len(kind), bool)
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    first[ends] = True
    first[ends[:-1] + 1] = True
    # white space before a word: its last character is cut off, a space joins the word
    heads = np.flatnonzero(first & (kind != SPACE) & (kind != END))
    heads = heads[heads > 0]
    heads = heads[kind[heads - 1] == SPACE]
    first[heads - 1] = True
    first[heads[points[heads - 1] == 0x20]] = False
    # an apostrophe that is a word of its own takes the suffix
    marks = np.flatnonzero((points == 0x27) & first)
    for mark in marks[kind[marks + 1] == LETTER].tolist():
        follow = "".join(map(chr, points[mark + 1 : mark + 3].tolist()))
        for suffix in SUFFIXES:
            if follow.startswith(suffix):
                stop = mark + 1 + len(suffix)
                first[mark + 1] = False
                first[stop] = True
                break
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    width[ends] = 0
    begin = np.cumsum(width) - width
    per_text = np.diff(np.concatenate(([0], np.cumsum(first)[ends] - np.arange(1, len(ends) + 1))))
    first[ends] = False
    return begin[first], per_text


def cut_by_pattern(texts: list[str], pattern: regex.Pattern) -> tuple[np.ndarray, np.ndarray]:
    """The same for any pattern; all characters of a text must be in some match."""
    words = [[word.encode() for word in pattern.findall(text)] for text in texts]
    sizes = np.fromiter((len(word) for text in words for word in text), np.int64)
    return np.cumsum(sizes) - sizes, np.fromiter(map(len, words), np.int64, len(words))


# --- merging --------------------------------------------------------------------
class Merges:
    """The vocabulary of a rank file: a merge joins two tokens to a third."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = sorted(
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        )
        self.pairs = np.array([pair for pair, _ in pairs] or [-1], np.int64)
        self.joined = np.array([rank for _, rank in pairs] or [NONE], np.int32)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of token pairs, NONE for pairs that do not merge or have a negative id."""
        wanted = left.astype(np.int64) << 32 | right
        found = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        fits = (self.pairs[found] == wanted) & (left >= 0) & (right >= 0)
        return np.where(fits, self.joined[found], NONE).astype(np.int32)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids, and the number of bytes of each; an unknown id is an error."""
        sizes = self.sizes[ids]
        return self.bytes[ragged(self.starts[ids], sizes)], sizes

    def replay(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, given as joined bytes and sizes, and every word's number of ids.

        Words get the merges in the order in which each alone would get them: the
        lowest rank first, from the left.
        """
        stops = np.cumsum(sizes + 1)  # a word's end mark is the place before its stop
        chain = Chain(self, data, sizes, stops)
        while chain.heap:
            chain.merge_next()
        kept = chain.token >= 0
        return chain.token[kept], np.diff(np.concatenate(([0], np.cumsum(kept)[stops - 1])))


class Chain:
    """The tokens of many words, linked in order, and the index of their pairs."""

    def __init__(self, merges: Merges, data: np.ndarray, sizes: np.ndarray, stops: np.ndarray):
        self.merges, self.stops = merges, stops
        length = int(stops[-1]) if len(stops) else 0
        inside = np.ones(length, bool)
        inside[stops - 1] = False
        self.token = np.full(length, -1, np.int32)
        self.token[inside] = merges.single[data]
        self.after = np.arange(1, length + 1, dtype=np.int32)
        self.before = np.arange(-1, length - 1, dtype=np.int32)
        self.level = np.full(length, NONE, np.int32)  # rank of the pair that begins at a place
        self.chosen = np.zeros(length + 1, bool)
        self.index: dict[int, list[np.ndarray]] = {}
        self.heap: list[int] = []
        starts = np.flatnonzero(inside[:-1] & inside[1:]) if length else np.zeros(0, np.int64)
        self._enter(starts, merges.rank(self.token[starts], self.token[starts + 1]))

    def _enter(self, places: np.ndarray, levels: np.ndarray) -> None:
        self.level[places] = levels
        live = levels != NONE
        places, levels = places[live], levels[live]
        if not len(places):
            return
        order = np.argsort(levels)
        places, levels = places[order], levels[order]
        cuts = np.flatnonzero(levels[1:] != levels[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(levels)]
        for a, b in zip(bounds, bounds[1:]):
            rank = int(levels[a])
            if rank not in self.index:
                self.index[rank] = []
                heapq.heappush(self.heap, rank)
            self.index[rank].append(places[a:b])

    def _without_overlap(self, places: np.ndarray) -> np.ndarray:
        """Of pairs that share a token, every second one from the left."""
        shares = self.after[places[:-1]] == places[1:]
        if not shares.any():
            return places
        number = np.arange(len(places))
        run = np.maximum.accumulate(np.where(np.concatenate(([True], ~shares)), number, 0))
        return places[(number - run) % 2 == 0]

    def _neighbours(self, rank: int, places: np.ndarray):
        """What merging the places at once would bring: ranks with the left and right token."""
        middle = self.after[places]
        right, left = self.after[middle], self.before[places]
        self.chosen[places] = True
        new_right = np.where(self.chosen[right], rank, self.token[right])
        self.chosen[places] = False
        self.chosen[middle] = True
        new_left = np.where((left >= 0) & self.chosen[left], rank, self.token[left])
        new_left = np.where(left >= 0, new_left, -1)
        self.chosen[middle] = False
        ids = np.full(len(places), rank, np.int32)
        levels = self.merges.rank(np.concatenate((new_left, ids)), np.concatenate((ids, new_right)))
        return levels[: len(places)], levels[len(places) :]

    def merge_next(self) -> None:
        rank = heapq.heappop(self.heap)
        held = self.index.pop(rank)
        places = np.unique(held[0] if len(held) == 1 else np.concatenate(held))
        places = places[self.level[places] == rank]
        if not len(places):
            return
        places = self._without_overlap(places)
        to_left, to_right = self._neighbours(rank, places)
        sooner = (to_left < rank) | (to_right < rank)
        if sooner.any():
            # In these words a lower rank comes next: one merge now, the others wait.
            word = np.searchsorted(self.stops, places, side="right")
            repeats = np.concatenate(([False], word[1:] == word[:-1]))
            waits = repeats & np.isin(word, word[sooner])
            if waits.any():
                self.index[rank] = [places[waits]]
                heapq.heappush(self.heap, rank)
                places = places[~waits]
                to_left, to_right = self._neighbours(rank, places)
        middle = self.after[places]
        right = self.after[middle]
        self.token[places] = rank
        self.token[middle] = -2
        self.level[middle] = NONE
        self.after[places] = right
        self.before[right] = places
        left = self.before[places]
        touched = left >= 0
        self._enter(
            np.concatenate((left[touched], places)), np.concatenate((to_left[touched], to_right))
        )


# --- texts -------------------------------------------------------------------------
def _blocks(texts: Iterable[str], length: int) -> Iterator[list[str]]:
    """Texts in order, gathered to blocks of bounded length; a longer text is a block."""
    block: list[str] = []
    held = 0
    for text in texts:
        block.append(text)
        held += len(text)
        if held >= length:
            yield block
            block, held = [], 0
    if block:
        yield block


def _cut(texts: list[str], pattern: str) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of texts as a dictionary array, and every text's number of words."""
    if pattern == CUT_BY_CLASS:
        begins, counts = cut_by_class(texts)
    else:
        begins, counts = cut_by_pattern(texts, regex.compile(pattern))
    data = "".join(texts).encode()
    offsets = np.append(begins, len(data)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )
    return words.dictionary_encode(), counts


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary values from joined bytes and sizes."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    values = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )
    return values.cast(pa.binary())


def encode(texts: list[str], merges: Merges, pattern: str) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Packed ids and decoded bytes of texts, block by block in order."""
    cuts = [_cut(block, pattern) for block in _blocks(texts, BLOCK_CHARS)]
    if not cuts:
        return
    words = pa.chunked_array([words for words, _ in cuts]).unify_dictionaries().chunks
    distinct = words[0].dictionary
    offsets = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1]
    data = np.frombuffer(distinct.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ids, counts = merges.replay(data, np.diff(offsets))
    starts = np.cumsum(counts) - counts
    for chunk, (_, per_text) in zip(words, cuts):
        of_word = chunk.indices.to_numpy()
        sizes = counts[of_word]
        flat = ids[ragged(starts[of_word], sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(per_text)]
        per_text_ids = np.diff(np.concatenate(([0], ends)))
        decoded, token_sizes = merges.decode(flat)
        bytes_at = np.concatenate(([0], np.cumsum(token_sizes)))[ends]
        yield (
            _binary(flat.astype("<u4").view(np.uint8), per_text_ids * 4),
            _binary(decoded, np.diff(np.concatenate(([0], bytes_at)))),
        )


def tokenise(
    docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``<key>, ids, decoded`` for every row: token ids and the bytes they decode to.

    ``ids`` is binary, little-endian unsigned 32-bit integers as training files
    hold them (``id_array`` unpacks them).  ``path`` is a rank file, read once by the
    driver and broadcast: one vocabulary, a few MB whatever the corpus.  Null
    counts as empty and gives no ids; words of any length and repeated rows are
    fine; other columns are ignored; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges(shared.value)
        for batch in batches:
            at = 0
            for group in _blocks((text.as_py() or "" for text in batch.column(1)), GROUP_CHARS):
                for ids, decoded in encode(group, merges, pattern):
                    keys = batch.column(0).slice(at, len(ids))
                    yield pa.RecordBatch.from_arrays([keys, ids, decoded], [key, "ids", "decoded"])
                    at += len(ids)

    named = docs.select(F.col(key), F.col(text))
    kind = named.schema[0].dataType.simpleString()
    return named.mapInArrow(encode_batches, f"`{key}` {kind}, ids binary, decoded binary")


def id_array(ids: Column) -> Column:
    """Packed ids as array<bigint>."""

    @F.arrow_udf("array<bigint>")
    def unpack(packed: pa.Array) -> pa.Array:
        rows = [None if row is None else np.frombuffer(row, "<u4") for row in packed.to_pylist()]
        return pa.array(rows, pa.list_(pa.int64()))

    return unpack(ids)
