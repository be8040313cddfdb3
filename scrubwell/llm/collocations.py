"""Phrases whose words stand together more often than chance, counted exactly in two passes.

Partition mining (SON).  The rows a task reads form shards of bounded size; splits of the input are put
together as long as they fit into one and every core has a task.  A shard is
mined completely for phrases that reach its share of the support: of ``count`` occurrences
asked for in a language, the share that the shard's bytes have in the language's bytes.
Shares add up to ``count``, so a phrase that misses its share in every shard misses ``count``;
the locally frequent phrases of all shards together lack no frequent one.  A phrase that
a shard did not report has fewer occurrences there than its share, so the reports also
bound each phrase's total from above; phrases whose bound is too low are no candidates.
Of more than FEW shards each has a small share and reports many phrases.  They name them by
hashes then, sorted and packed by ranges of hashes: about three bytes a phrase.  Phrases that
share a hash share their bound, which is then only higher.

The second pass counts all candidates in all shards.  Tasks know candidates by a table
of ``1 << slot_bits`` bits, of one size whatever the corpus: a phrase whose bit is unset is no
candidate, one whose bit is set is counted, and the exact totals decide.

In a shard, phrases grow word by word: one of k words is looked at only where both
its parts of k - 1 words are locally frequent (or candidates).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrubwell.session import stage

LONGEST = 5  # words of a phrase
COUNT = 100  # occurrences of a phrase at least
FIRST = 2000  # phrases returned for each language
SHARD_WORDS = 12 << 20  # a task closes a shard when it holds so many words
WORD_BYTES = 5  # of text for each of them, by which tasks are filled
CHUNK = 1 << 19  # places whose phrases are told apart at once
SLOT_BITS = 26  # 8 MB of bits
FEW = 8  # shards that report phrases as they are
KEY_BITS = 32  # of a hash, beside the range it is in
RANGES = 8  # of hashes for each shard, so that a range holds as much whatever the corpus
HELD = 1 << 21  # hashes a task holds before it passes them on
UNKNOWN = "und"
BREAK = b"\xff"  # stands for a break between pieces: no byte of UTF-8
# A-Z in lower case, tabs as spaces, the characters between pieces as breaks
LETTERS = bytes(
    0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b
    for b in range(256)
)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Numbers(dict):
    """Numbers words in the order they are first asked for; the break is 0."""

    def __init__(self):
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Shard:
    """The words of some documents, as numbers by language."""

    def __init__(self):
        self.numbers: dict[str, Numbers] = {}
        self.parts: dict[str, list[np.ndarray]] = {}
        self.octets: dict[str, int] = {}
        self.totals: dict[str, int] = {}
        self.size = 0

    def add(self, lang: str, text: str, total: int) -> None:
        data = text.encode()
        words = data.translate(LETTERS).replace(BREAK, b" \xff ").split()
        words.append(BREAK)
        if lang not in self.numbers:
            self.numbers[lang], self.parts[lang] = Numbers(), []
            self.octets[lang] = 0
            self.totals[lang] = total
        numbers = self.numbers[lang]
        self.parts[lang].append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        self.octets[lang] += len(data)
        self.size += len(words)

    def languages(self) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
        """Language, the words of its documents, a break after each, and the words by number.

        What is given out is held here no longer.
        """
        for lang in list(self.numbers):
            names = list(self.numbers.pop(lang))
            yield lang, np.concatenate(self.parts.pop(lang)), names


def shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Shard]:
    """The documents of a task (``lang, text, total``) in shards of about ``most`` words.

    A shard may pass ``most`` by a quarter: the little that a full task holds beyond it would be a
    shard of its own, whose share of the support is so small that it reports every phrase.
    """
    shard = Shard()
    for batch in batches:
        for lang, text, total in zip(*batch.columns):
            shard.add(lang.as_py(), text.as_py(), total.as_py())
            if shard.size >= most + most // 4:
                yield shard
                shard = Shard()
    if shard.size:
        yield shard


def grow(
    words: np.ndarray, longest: int, accept: Callable[[int, np.ndarray, np.ndarray], np.ndarray]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, first places and counts of the distinct accepted phrases, length by length.

    ``accept`` gets the same of all phrases whose parts were accepted.  Phrases that begin alike come
    together, about CHUNK places at a time, so the working memory is little more than the words.
    """
    known = np.zeros(len(words) + 1, np.int32)  # number of the accepted phrase that begins here
    for length in range(1, longest + 1):
        numbered, number = np.zeros_like(known), 0
        for at in _alike(words, known, length):
            if length == 1:
                keys = words[at]
            else:
                keys = known[at].astype(np.int64) << 32 | known[at + 1]
            _, first, phrase, counts = np.unique(
                keys, return_index=True, return_inverse=True, return_counts=True
            )
            good = accept(length, at[first], counts)
            yield length, at[first][good], counts[good]
            numbered[at] = np.where(good, number + np.cumsum(good), 0)[phrase]
            number += int(good.sum())
        if not number:
            return
        known = numbered


def _alike(words: np.ndarray, known: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """The places of phrases that may be accepted, equal phrases in one array, about CHUNK places in each."""
    if length == 1:
        begins, open_ones = words, words > 0
    else:
        begins, open_ones = known[:-1], (known[:-1] > 0) & (known[1:] > 0)
    many = -(-int(np.count_nonzero(open_ones)) // CHUNK)
    bucket = (begins % max(many, 1)).astype(np.uint16)
    for own in range(many):
        picked = np.flatnonzero(open_ones & (bucket == own))
        if len(picked):
            yield picked


def spell(words: np.ndarray, names: list[bytes], places: np.ndarray, length: int) -> list[str]:
    """The phrases of so many words at places."""
    columns = [words[places + i].tolist() for i in range(length)]
    return [b" ".join([names[n] for n in numbers]).decode() for numbers in zip(*columns)]


def slots(
    lang: str, words: np.ndarray, hashes: np.ndarray, places: np.ndarray, length: int, bits: int
) -> np.ndarray:
    """The slot of each phrase in a table of ``1 << bits`` candidates: the first bits of its hash."""
    value = np.full(len(places), xxhash.xxh64_intdigest(lang.encode(), length), np.uint64)
    for i in range(length):
        value = (value ^ hashes[words[places + i]]) * GOLDEN
        value ^= value >> np.uint64(32)
    return (value * GOLDEN >> np.uint64(64 - bits)).astype(np.int64)


def _hashes(names: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))


def _mine(count: int, longest: int, shard_words: int, slot_bits: int):
    """Locally frequent phrases of a task's shards; without a phrase, what unreported ones may have."""

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, shard_words):
            for lang, words, names in shard.languages():
                octets, total = shard.octets[lang], shard.totals[lang]
                least = max(1, -(-count * octets // total)) if total else 1
                yield _rows(lang, [None], [None], [least - 1])
                hashes = _hashes(names)
                for length, places, counts in grow(words, longest, lambda *x: x[2] >= least):
                    slot = slots(lang, words, hashes, places, length, slot_bits)
                    for part in _parts(len(places)):
                        told = spell(words, names, places[part], length)
                        yield _rows(lang, told, slot[part], counts[part] - (least - 1))

    return mine


def _pack(count: int, longest: int, shard_words: int, range_bits: int):
    """Hashes and counts of the locally frequent phrases of a task's shards, by language and range of hashes.

    ``rest`` is what a phrase may have in the shard that was not reported.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, shard_words):
            for lang, words, names in shard.languages():
                octets, total = shard.octets[lang], shard.totals[lang]
                least = max(1, -(-count * octets // total)) if total else 1
                hashes = _hashes(names)
                held, size = [], 0
                for length, places, counts in grow(words, longest, lambda *x: x[2] >= least):
                    mark = slots(lang, words, hashes, places, length, range_bits + KEY_BITS)
                    held.append((mark, counts - (least - 1)))
                    size += len(mark)
                    if size >= HELD:
                        yield _packed(lang, held, range_bits, 0)
                        held, size = [], 0
                yield _packed(lang, held, range_bits, least - 1)

    return pack


def _packed(lang: str, held: list, range_bits: int, rest: int) -> pa.RecordBatch:
    """A row for each range: its hashes in order, as steps from one to the next, and their counts.

    With a ``rest`` ranges without a hash have a row too.
    """
    marks = np.concatenate([mark for mark, _ in held] or [np.empty(0, np.int64)])
    counts = np.concatenate([many for _, many in held] or [np.empty(0, np.int64)])
    order = np.argsort(marks)
    marks, counts = marks[order], counts[order].astype(np.uint32)
    ends = np.searchsorted(marks, np.arange((1 << range_bits) + 1) << KEY_BITS)
    rows = []
    for part, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
        if b > a or rest:
            steps = np.diff(marks[a:b], prepend=part << KEY_BITS).astype(np.uint32)
            rows.append((lang, part, _planes(steps), _planes(counts[a:b]), rest))
    columns = zip(*rows) if rows else ((),) * 5
    kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], PACKED)


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers as all their lowest bytes, then the next ones: high bytes, mostly alike, stand together."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplaned(octets: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(octets, np.uint8).reshape(4, -1).T).reshape(-1).view("<u4")


def _candidates(count: int, range_bits: int, slot_bits: int):
    """The slots of a range of hashes whose reported counts, with all that was not reported, reach ``count``."""

    def candidates(group: pa.Table) -> pa.Table:
        parts = []
        for steps, counts in zip(group["steps"], group["counts"]):
            keys = np.cumsum(_unplaned(steps.as_py()), dtype=np.uint64)
            parts.append(keys << np.uint64(32) | _unplaned(counts.as_py()))
        both = np.concatenate(parts)
        del parts
        both.sort()
        keys = (both >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        sums = np.add.reduceat((both & np.uint64(0xFFFFFFFF)).astype(np.int64), starts) if len(starts) else starts
        bound = sums + sum(group["rest"].to_pylist())
        good = keys[starts][bound >= count] | group["part"][0].as_py() << KEY_BITS
        return pa.table({"slot": np.unique(good >> (range_bits + KEY_BITS - slot_bits))})

    return candidates


def _count(bits, longest: int, shard_words: int, slot_bits: int):
    """Occurrences of the candidates in a task's shards; without a phrase, all words."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, np.uint8)
        for shard in shards(batches, shard_words):
            for lang, words, names in shard.languages():
                yield _rows(lang, [None], [None], [int((words > 0).sum())])
                hashes = _hashes(names)

                def listed(length: int, places: np.ndarray, _) -> np.ndarray:
                    slot = slots(lang, words, hashes, places, length, slot_bits)
                    return (table[slot >> 3] >> (slot & 7) & 1).astype(bool)

                for length, places, counts in grow(words, longest, listed):
                    for part in _parts(len(places)):
                        told = spell(words, names, places[part], length)
                        yield _rows(lang, told, [None] * len(told), counts[part])

    return tally


def _parts(size: int, most: int = 50_000) -> Iterator[slice]:
    return (slice(at, at + most) for at in range(0, size, most))


def _rows(lang: str, phrases, slot, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(phrases), pa.string()),
            pa.array(phrases, pa.string()),
            pa.array(slot, pa.int64()),
            pa.array(counts, pa.int64()),
        ],
        ["lang", "phrase", "slot", "many"],
    )


SCHEMA = "lang string, phrase string, slot bigint, many bigint"
PACKED = ["lang", "part", "steps", "counts", "rest"]
PACKED_SCHEMA = "lang string, part int, steps binary, counts binary, rest bigint"


def _table(candidates: DataFrame, slot_bits: int) -> bytes:
    """The bits of the candidates' slots, 64 in a number: as many numbers whatever the corpus."""
    numbers = candidates.groupBy(F.shiftright("slot", 6).alias("place")).agg(
        F.expr("bit_or(shiftleft(1L, int(slot % 64)))").alias("bits")
    )
    found = numbers.toArrow()  # a million rows at most
    table = np.zeros(1 << max(0, slot_bits - 6), "<i8")
    table[found["place"].to_numpy()] = found["bits"].to_numpy()
    return table.tobytes()


def _tasks(totals: DataFrame, shard_words: int) -> int:
    """How many tasks the splits of the input are put together to: a shard for each, and none idle.

    Each shard hands on a row for every phrase that is frequent there.  Were there as many shards as the
    input has splits, both factors of that product would grow with the corpus.  All tasks get the same
    number of splits: what one holds beyond a shard would be a shard with a share so small that every phrase reaches it.
    """
    octets, splits = totals.agg(F.sum("total"), F.max("split") + 1).first()
    if not octets:
        return splits or 1
    at_once = totals.sparkSession.sparkContext.defaultParallelism
    together = max(1, min(splits * shard_words * WORD_BYTES // octets, splits // at_once))
    return -(-splits // together)


def _shards(totals: DataFrame, shard_words: int) -> int:
    octets = totals.agg(F.sum("total")).first()[0] or 0
    return octets // (shard_words * WORD_BYTES) + 1


def _reported(known: DataFrame, count: int, longest: int, shard_words: int, slot_bits: int) -> DataFrame:
    """``slot`` of the candidates, from the phrases that the shards report."""
    mined = known.mapInArrow(_mine(count, longest, shard_words, slot_bits), SCHEMA)
    mined = mined.groupBy("lang", "phrase").agg(
        F.first("slot").alias("slot"), F.sum("many").alias("excess")
    )
    mined = stage(mined, "mined")
    missed = mined.filter("phrase IS NULL").select("lang", F.col("excess").alias("missed"))
    named = mined.filter("phrase IS NOT NULL")
    return named.join(missed, "lang").filter(F.expr(f"excess + missed >= {count}"))


def _reported_packed(
    known: DataFrame, many: int, count: int, longest: int, shard_words: int, slot_bits: int
) -> DataFrame:
    """``slot`` of the candidates, from hashes of the phrases that so many shards report."""
    range_bits = (RANGES * many - 1).bit_length()
    packed = known.mapInArrow(_pack(count, longest, shard_words, range_bits), PACKED_SCHEMA)
    found = packed.groupBy("lang", "part").applyInArrow(_candidates(count, range_bits, slot_bits), "slot bigint")
    return stage(found, "candidates")


def phrase_counts(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    count: int = COUNT,
    longest: int = LONGEST,
    shard_words: int = SHARD_WORDS,
    slot_bits: int = SLOT_BITS,
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, many`` of all phrases of 1 to ``longest`` words with ``count`` occurrences
    or more, and ``lang, n`` with all words of each language.  Both are written tables."""
    named = docs.select(
        F.coalesce(lang, F.lit(UNKNOWN)).alias("lang"), F.coalesce(text, F.lit("")).alias("text")
    )
    split = named.withColumn("split", F.spark_partition_id())
    totals = split.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("total"), F.max("split").alias("split"))
    totals = stage(totals, "octets")  # written, so that the planner sends it to the texts only if it is small
    known = named.join(totals, "lang").select("lang", "text", "total")
    known = known.coalesce(_tasks(totals, shard_words))

    asked, many = (count, longest, shard_words, slot_bits), _shards(totals, shard_words)
    candidates = _reported(known, *asked) if many <= FEW else _reported_packed(known, many, *asked)
    bits = docs.sparkSession.sparkContext.broadcast(_table(candidates, slot_bits))

    counted = known.mapInArrow(_count(bits, longest, shard_words, slot_bits), SCHEMA)
    counted = counted.groupBy("lang", "phrase").agg(F.sum("many").alias("many"))
    counted = stage(counted.filter(f"phrase IS NULL OR many >= {count}"), "counted")
    words = counted.filter("phrase IS NULL").select("lang", F.col("many").alias("n"))
    return counted.filter("phrase IS NOT NULL"), words


def _scored(counts: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the phrases of two words or more."""
    cut = (
        counts.withColumn("words", F.split("phrase", " "))
        .filter("size(words) > 1")
        .select("lang", "phrase", F.col("many").alias("a"), "words", F.expr("explode(sequence(1, size(words) - 1)) AS k"))
        .select(
            "lang", "phrase", "a", "k",
            F.expr("array_join(slice(words, 1, k), ' ')").alias("head"),
            F.expr("array_join(slice(words, k + 1, size(words) - k), ' ')").alias("rest"),
        )
    )
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("many").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("many").alias("r"))
    whole = "cast({} AS decimal(19, 0))".format
    score = F.expr(
        f"(cast(1000 AS decimal(4, 0)) * ({whole('a')} * {whole('n')})) div ({whole('l')} * {whole('r')})"
    )
    cut = cut.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(words, "lang")
    best = cut.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    )
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def _inside_longer(counts: DataFrame, cover: int) -> DataFrame:
    """``lang, phrase`` of those inside a longer phrase with ``cover`` hundredths of their count.

    Whoever is inside a longer phrase is inside one that is longer by a word, which
    occurs as often or more: only first and last words need to be taken off.
    """
    parts = counts.withColumn("words", F.split("phrase", " ")).filter("size(words) > 2")
    inner = F.expr(
        "explode(array(array_join(slice(words, 1, size(words) - 1), ' '),"
        " array_join(slice(words, 2, size(words) - 1), ' '))) AS phrase"
    )
    longer = parts.select("lang", F.col("many").alias("longer"), inner)
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return most.join(counts, ["lang", "phrase"]).filter(f"100 * longer >= {cover} * many").select("lang", "phrase")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    count: int = COUNT,
    longest: int = LONGEST,
    first: int = FIRST,
    cover: int = 100,
    shard_words: int = SHARD_WORDS,
    slot_bits: int = SLOT_BITS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language.

    Texts are cut to pieces at ``.,;:!?`` and line breaks, pieces to words at spaces and tabs, A-Z
    lower-cased.  ``a`` counts a phrase's occurrences inside pieces, overlaps included, ``n`` all words
    of the language, ``l`` and ``r`` the two parts of the phrase at the cut with the lowest ``score``,
    1000 a n / (l r) rounded down (ties: the earliest cut).  Phrases inside a longer one that has
    ``cover`` hundredths of their count are left out.  Rank is by score, then count, both descending,
    then the phrase's bytes.

    Rows without a language count as ``und``, null texts as empty; rows need no key, repeated rows count
    as often as they stand; other columns are ignored; an empty table gives an empty one.
    Texts are never shuffled.  Where shards are so many that their share of ``count`` is
    below two, the first pass reports every phrase it meets, as a hash of about three bytes for each
    and shard: its disk then follows the words of the corpus, not the shards times the frequent phrases.
    """
    counts, words = phrase_counts(docs, lang, text, count, longest, shard_words, slot_bits)
    scored = _scored(counts, words)
    left = scored.join(_inside_longer(counts, cover), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)
    return ranked.select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
