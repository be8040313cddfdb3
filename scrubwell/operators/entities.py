"""Redaction of listed names and words by a join with their table.

A list is a trie of pieces kept as a table.  Its first two levels are also known as bits of one
array of fixed size, by which a text drops, in its own row, every place where no listed name can
begin; only what is left is spelled out and looked up.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubwell import rules
from scrubwell.functions.hashing import IDENTITY, content_identity, pseudonym
from scrubwell.functions.text import let, pieces, splice, strip, word_pieces
from scrubwell.session import stage

# --- fixed values: the kinds of name that are redacted ---------------------
LABELS = ("PERSON", "NORP", "ORG", "GPE", "LOC")

SLOT_BITS = 20  # 128 KB of bits for the beginnings of names
Cut = Callable[[Column], Column]


def _slot(length: Column, first: Column, second: Column) -> Column:
    """Where the bit of a name's length and first two pieces is."""
    second = F.when(length > 1, second).otherwise("")
    return F.pmod(F.xxhash64(length.cast("int"), first, second), F.lit(1 << SLOT_BITS))


def _prepared(terms: DataFrame, cut: Cut, name: str) -> DataFrame:
    """``term, label, parts, slot``, one row per term, as a written table."""
    cut_up = terms.groupBy("term").agg(F.min("label").alias("label")).withColumn("p", cut(F.col("term")))
    parts = F.size("p")
    slot = _slot(parts, F.get("p", F.lit(0)), F.get("p", F.lit(1)))
    return stage(cut_up.select("term", "label", parts.alias("parts"), slot.alias("slot")), name)


def prepare_gazetteer(gazetteer: DataFrame, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """``term, label, parts, slot``, one row per name, as a written table; one that is stays as it is."""
    if "slot" in gazetteer.columns:
        return gazetteer
    trimmed = gazetteer.withColumn("term", strip(F.col("term")))
    named = trimmed.filter(F.col("label").isin(*labels) & (F.col("term") != ""))
    return _prepared(named, pieces, "gazetteer")


def prepare_words(words: DataFrame) -> DataFrame:
    """The same for a table of words or phrases (``term``), found in any case and as whole words.

    Terms that do not begin and end with a letter, digit or underscore are no whole words and
    match nothing; they are left out.
    """
    lowered = words.select(F.lower(strip(F.col("term"))).alias("term"), F.lit("WORD").alias("label"))
    return _prepared(lowered.filter(F.col("term").rlike(rules.WHOLE_WORDS)), word_pieces, "words")


def _beginnings(names: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The bits of all names, 64 in a number, and the lengths in use.

    An array of one size whatever the list.  Names of many lengths are long together: a list of n
    pieces has fewer than sqrt(2 n) lengths.
    """
    spread = names.groupBy(F.shiftright("slot", 6).alias("place")).agg(
        F.expr("bit_or(shiftleft(1L, int(slot % 64)))").alias("bits")
    )
    bits = np.zeros(1 << (SLOT_BITS - 6), np.int64)
    for row in spread.collect():
        bits[row.place] = row.bits
    return bits, sorted(row.parts for row in names.select("parts").distinct().collect())


def find_entities(
    df: DataFrame,
    names: DataFrame,
    key: str | list[str] = "doc_id",
    text: str = "text",
    cut: Cut = pieces,
    fold: Cut = lambda piece: piece,
) -> DataFrame:
    """``keys, spans``: non-overlapping names of each text, longest first from the left.

    A run of pieces is spelled out and looked up by equality only where some name of its length
    begins with its first two pieces, as far as the bits tell.  Names do not begin with whitespace, so
    runs do not either.  ``fold`` is put on pieces before they are compared.
    """
    keys = [key] if isinstance(key, str) else list(key)
    bits, lengths = _beginnings(names)

    def runs(parts: Column) -> Column:
        places = F.when(F.size(parts) > 0, F.sequence(F.lit(0), F.size(parts) - 1))
        starts = F.filter(places, lambda at: ~F.get(parts, at).isin(" ", "\n"))

        def begins(at: Column, length: Column) -> Column:
            slot = _slot(length, F.get(parts, at), F.coalesce(F.get(parts, at + 1), F.lit("")))
            held = F.get(F.lit(bits), F.shiftright(slot, 6).cast("int"))
            bit = F.call_function("shiftright", held, slot.bitwiseAND(F.lit(63)).cast("int"))
            return bit.bitwiseAND(F.lit(1)) == 1

        def run(at: Column, length: Column) -> Column:
            return F.struct(
                at.alias("pos"),
                length.alias("parts"),
                F.array_join(F.slice(parts, at + 1, length), "").alias("term"),
            )

        known = F.array(*[F.lit(length) for length in lengths]).cast("array<int>")
        found = F.transform(
            starts,
            lambda at: F.transform(
                F.filter(known, lambda length: begins(at, length)), lambda length: run(at, length)
            ),
        )
        return F.flatten(found)

    folded = F.transform(cut(F.col(text)), fold)
    candidates = df.select(*keys, F.inline(let(folded, runs)))
    hits = candidates.join(names.drop("slot"), ["term", "parts"]).groupBy(*keys)
    spans = hits.agg(
        F.array_sort(
            F.collect_set(F.struct("pos", (-F.col("parts")).alias("order"), "term", "label"))
        ).alias("found")
    )
    kept_type = "array<struct<pos:int,len:int,term:string,label:string>>"
    start = F.struct(F.lit(0).alias("free"), F.array().cast(kept_type).alias("kept"))

    def keep(state: Column, span: Column) -> Column:
        fits = span["pos"] >= state["free"]
        taken = F.struct(
            span["pos"].alias("pos"),
            (-span["order"]).alias("len"),
            span["term"].alias("term"),
            span["label"].alias("label"),
        )
        return F.struct(
            F.when(fits, span["pos"] - span["order"]).otherwise(state["free"]).alias("free"),
            F.when(fits, F.concat(state["kept"], F.array(taken)))
            .otherwise(state["kept"])
            .alias("kept"),
        )

    chosen = F.aggregate(F.col("found"), start, keep, lambda state: state["kept"])
    return spans.select(*keys, chosen.alias("spans"))


def redact_entities(
    df: DataFrame,
    names: DataFrame,
    text: str = "text",
    token: str = rules.TOKENS["NAME"],
    hmac_key: str | None = None,
    spans: str | None = None,
) -> DataFrame:
    """Replace listed names; ``spans`` names a column to keep the found spans in.

    Texts are told apart by their content, so the table needs no key.
    """
    return _redacted(df, names, text, token, "NAME", hmac_key, spans, pieces, lambda piece: piece)


def redact_words(
    df: DataFrame,
    words: DataFrame,
    text: str = "text",
    token: str = rules.TOKENS["PROFANITY"],
    tag: str = "PROFANITY",
    hmac_key: str | None = None,
    spans: str | None = None,
) -> DataFrame:
    """Replace whole words of a table of any size (:func:`prepare_words`), in any case.

    What the pattern of ``redact.profanity`` does for a short list; where listed phrases begin
    alike, the longest is taken.  The ``term`` of a span is in lower case.
    """
    return _redacted(df, words, text, token, tag, hmac_key, spans, word_pieces, F.lower)


def _redacted(df, names, text, token, tag, hmac_key, spans, cut: Cut, fold: Cut) -> DataFrame:
    df = df.withColumns(content_identity(F.col(text)))
    found = find_entities(df, names, IDENTITY, text, cut, fold).withColumnRenamed("spans", "_spans")

    def edit(span: Column) -> Column:
        new = pseudonym(span["term"], tag, hmac_key) if hmac_key else F.lit(token)
        return F.struct(span["pos"].alias("pos"), span["len"].alias("len"), new.alias("token"))

    spliced = let(
        cut(F.col(text)),
        lambda parts: let(F.transform("_spans", edit), lambda edits: splice(parts, edits)),
    )
    redacted = df.join(found, IDENTITY, "left").withColumn(
        text, F.when(F.col("_spans").isNotNull(), spliced).otherwise(F.col(text))
    )
    redacted = redacted.drop(*IDENTITY)
    return redacted.withColumnRenamed("_spans", spans) if spans else redacted.drop("_spans")
