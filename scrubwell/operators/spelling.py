"""Spelling correction against a vocabulary table.

Works on distinct words: the vocabulary and the list of unknown words are
aggregates, suggestions are found by an equi-join on shared deletion keys, and
texts are changed only where a word has a suggestion.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubwell import rules
from scrubwell.functions.hashing import IDENTITY, content_identity
from scrubwell.functions.distance import alignment_distance
from scrubwell.functions.text import has_code, let, matches, splice
from scrubwell.session import stage

# --- fixed values: reach of a correction ----------------------------------
# Letters that make deletion keys.  Any number finds all pairs; more give more keys for each
# word and far fewer words that share one by chance, whose number grows with the square of the words.
PREFIX = 12
MAX_DISTANCE = 2
KEY_BITS = 26  # of the table of the terms' keys: 8 MB, whatever the vocabulary


def guarded_pieces(text: Column) -> Column:
    """Words, marks and spaces; web and e-mail addresses stay in one piece."""
    return matches(text, rules.GUARDED_PIECES)


def one_space_between_sentences(text: Column) -> Column:
    return F.when(has_code(text), text).otherwise(
        F.regexp_replace(text, rules.SENTENCE_BREAK, " ")
    )


def build_vocabulary(df: DataFrame, text: str = "text", min_count: int = 1) -> DataFrame:
    """``term, freq`` of all letter-only words seen ``min_count`` times, in lower case."""
    return (
        df.select(F.explode(guarded_pieces(F.col(text))).alias("piece"))
        .filter(F.col("piece").rlike(rules.LETTERS_ONLY))
        .groupBy(F.lower("piece").alias("term"))
        .agg(F.count("*").alias("freq"))
        .filter(F.col("freq") >= min_count)
    )


def correctable_words(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys, pos, word`` of the words a correction may touch."""
    plain = one_space_between_sentences(F.col(text))
    return (
        df.filter(~has_code(F.col(text)))
        .select(*keys, F.posexplode(guarded_pieces(plain)).alias("pos", "word"))
        .filter(F.col("word").rlike(rules.LOWER_WORD))
    )


def unknown_words(
    df: DataFrame, vocabulary: DataFrame, text: str = "text", keep: str | None = None
) -> DataFrame:
    """Words that are not in the vocabulary and do not match the pattern ``keep``."""
    words = correctable_words(df, [], text).select("word").distinct()
    if keep:
        words = words.filter(~F.col("word").rlike(keep))
    return words.join(vocabulary, words.word == vocabulary.term, "left_anti")


def deletion_keys(
    word: Column, limit: int = MAX_DISTANCE, held: Broadcast | None = None
) -> Column:
    """Hashes of the first letters of a word with up to ``limit`` of them left out.

    With ``held``, a table of :func:`key_table`, only those whose bit is set.

    Two words within ``limit`` steps of each other share at least one key, so
    the join on keys misses no pair.  An Arrow function: array expressions take
    twenty times as long to build the keys.
    """

    @F.arrow_udf("array<bigint>")
    def hashed(words: pa.Array) -> pa.Array:
        def keys(whole: str | None) -> np.ndarray | None:
            if whole is None:
                return None
            found = newest = {whole[:PREFIX]}
            for _ in range(limit):
                newest = {key[:at] + key[at + 1 :] for key in newest for at in range(len(key))}
                found = found | newest
            digests = (xxhash.xxh64_intdigest(key) for key in found)
            hashes = np.fromiter(digests, np.uint64, len(found))
            if table is not None:
                slots = hashes >> np.uint64(64 - KEY_BITS)
                hashes = hashes[table[slots >> 3] >> (slots & 7).astype(np.uint8) & 1 == 1]
            return hashes.view(np.int64)

        table = None if held is None else np.frombuffer(held.value, np.uint8)
        return pa.array([keys(value.as_py()) for value in words], pa.list_(pa.int64()))

    return hashed(word)


def key_table(keys: DataFrame) -> bytes:
    """A bit for the first ``KEY_BITS`` of every key: of one size, whatever the number of keys."""
    slot = F.shiftrightunsigned("key", 64 - KEY_BITS)
    numbers = (
        keys.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("place"))
        .agg(F.expr("bit_or(shiftleft(1L, int(slot % 64)))").alias("bits"))
    )
    found = numbers.toArrow()  # a million rows at most
    table = np.zeros(1 << KEY_BITS - 6, "<i8")
    table[found["place"].to_numpy()] = found["bits"].to_numpy()
    return table.tobytes()


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary ready for many lookups: its terms, their deletion keys, and which keys there are."""

    terms: DataFrame
    keys: dict[int, DataFrame]
    held: dict[int, Broadcast]


def prepare_vocabulary(vocabulary: DataFrame | Vocabulary) -> Vocabulary:
    """Write the terms and their deletion keys once.

    The keys are written because the planner would guess the size of an exploded table from
    the size before, and broadcast too much.
    """
    if isinstance(vocabulary, Vocabulary):
        return vocabulary
    terms = stage(vocabulary.select("term", "freq"), "vocabulary")
    keys = {
        limit: stage(
            terms.select(
                "term",
                "freq",
                F.explode(deletion_keys(F.col("term"), limit)).alias("key"),
            ),
            f"term-keys-{limit}",
        )
        for limit in range(1, MAX_DISTANCE + 1)
    }
    send = terms.sparkSession.sparkContext.broadcast
    return Vocabulary(terms, keys, {limit: send(key_table(table)) for limit, table in keys.items()})


def _nearest(unknown: DataFrame, vocabulary: Vocabulary, limit: int) -> DataFrame:
    """The best term within ``limit`` steps of each word that has one.

    Comparing words is the costly part, so the words are dealt to a fixed
    number of tasks by hash instead of letting small partitions be merged.
    Keys that no term has stay out of the shuffle.  The join is a merge: the planner takes the
    words for as small as the file they come from, and would send all their keys through the driver.
    """
    tasks = int(unknown.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    terms = vocabulary.keys[limit]
    words = unknown.repartition(tasks, "word").select(
        "word",
        F.explode(deletion_keys(F.col("word"), limit, vocabulary.held[limit])).alias("key"),
    )
    pairs = (
        words.hint("merge")
        .join(terms, "key")
        .filter(F.abs(F.length("word") - F.length("term")) <= limit)
        .withColumn("distance", alignment_distance(F.col("word"), F.col("term"), limit))
        .filter(F.col("distance").isNotNull())
    )
    best = F.min(F.struct("distance", (-F.col("freq")).alias("rank"), "term"))
    return (
        pairs.groupBy("word").agg(best.alias("best")).select("word", "best.term", "best.distance")
    )


def suggest_spelling(unknown: DataFrame, vocabulary: DataFrame | Vocabulary) -> DataFrame:
    """``word, term, distance``: the nearest term, the most frequent among equals.

    One step is tried before two: a word with a neighbour at one step needs no
    look at the many more pairs that share a key of the wider search.
    """
    vocabulary = prepare_vocabulary(vocabulary)
    near = stage(_nearest(unknown, vocabulary, 1), "suggestions-near")
    rest = unknown.join(near, "word", "left_anti")
    return near.unionByName(_nearest(rest, vocabulary, MAX_DISTANCE))


def spelling_map(
    df: DataFrame, vocabulary: DataFrame | Vocabulary, text: str = "text", keep: str | None = None
) -> DataFrame:
    """The suggestions for all words of ``df``, written once as a table."""
    known = prepare_vocabulary(vocabulary)
    unknown = stage(unknown_words(df, known.terms, text, keep), "unknown-words")
    return stage(suggest_spelling(unknown, known), "suggestions")


def correct_spelling(df: DataFrame, suggestions: DataFrame, text: str = "text") -> DataFrame:
    """Replace the words that have a suggestion.

    Texts are told apart by their content, so the table needs no key.
    Only those words are shuffled, with their place in the text; every text is
    then cut and put together again in its own row.
    """
    df = df.withColumns(content_identity(F.col(text)))
    edits = (
        correctable_words(df, IDENTITY, text)
        .join(suggestions.select("word", "term"), "word")
        .groupBy(*IDENTITY)
        .agg(
            F.array_sort(
                F.collect_set(
                    F.struct("pos", F.lit(1).alias("len"), F.col("term").alias("token"))
                )
            ).alias("_edits")
        )
    )
    plain = one_space_between_sentences(F.col(text))
    spliced = let(guarded_pieces(plain), lambda parts: splice(parts, F.col("_edits")))
    return (
        df.join(edits, IDENTITY, "left")
        .withColumn(text, F.when(F.col("_edits").isNotNull(), spliced).otherwise(plain))
        .drop("_edits", *IDENTITY)
    )
