"""Near-duplicates by SimHash: a grid join on the bit counts of fingerprint segments.

A fingerprint's 64 bits are cut into 16 segments and mapped to the vector of
their bit counts.  The Manhattan distance of two vectors never exceeds the
number of differing bits, so it is a lower bound that can be searched with a
grid: fingerprints at most two bits apart have vectors at most two steps apart,
and those always share a cell that lies at most one step from either.  Every
distinct fingerprint enters its own cell and the neighbouring ones (33 at most),
fingerprints meet by cell, and the pairs that meet are verified on all 64 bits.

A cell that holds more than ``crowded`` fingerprints (one text edited in many
places) is not compared pair by pair.  Its fingerprints go to a grid of
one-bit segments, where the bound is exact: whoever shares a cell there is linked,
a cell has 65 members at most, and one edge per member is enough for the groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrubwell.llm.components import components
from scrubwell.session import stage

SEED = 42
BITS = 64
SEGMENT = 4  # bits of a segment; its count fits the same four bits
LOW_BITS = 0x1111111111111111
DISTANCE = 2
CROWDED = 64
BLOCK = 1 << 16  # hashes turned into bits at a time


def simhash(text: str | None, words: int) -> int:
    """The signed 64-bit fingerprint of one text; 0 without words."""
    tokens = text.encode().lower().split() if text else []
    if not tokens:
        return 0
    width = min(words, len(tokens))
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths) + np.arange(len(tokens))
    starts = (ends - lengths).tolist()
    joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    count = len(tokens) - width + 1
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())),
        np.uint64,
        count,
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, BLOCK):
        octets = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > count, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, words: int = 3) -> Column:
    """The SimHash of a text's word shingles (bigint): a bit is set if more than half have it.

    Words are runs without ASCII white space, A-Z lower-cased; a text of fewer
    words is one shingle; null, empty and blank texts give 0.
    """

    @F.arrow_udf("bigint")
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array((simhash(text.as_py(), words) for text in texts), pa.int64())

    return prints(text)


def _cells(prints: Column) -> Column:
    """The cell of the bit counts and every cell one step away, one count a hex digit."""
    digits = [
        F.shiftrightunsigned(prints, shift).bitwiseAND(F.lit(LOW_BITS)) for shift in range(SEGMENT)
    ]
    home = digits[0] + digits[1] + digits[2] + digits[3]
    steps = [F.lit(1 << shift) for shift in range(0, BITS, SEGMENT)]
    counts = [F.shiftright(home, shift).bitwiseAND(F.lit(15)) for shift in range(0, BITS, SEGMENT)]
    return F.array_compact(
        F.array(
            home,
            *[F.when(count < SEGMENT, home + step) for count, step in zip(counts, steps)],
            *[F.when(count > 0, home - step) for count, step in zip(counts, steps)],
        )
    )


def _verified_pairs(meetings: DataFrame) -> DataFrame:
    """Pairs that share a cell and differ in at most two of all bits."""
    grouped = meetings.groupBy("cell").agg(F.sort_array(F.collect_list("print")).alias("s"))
    pairs = F.expr(
        "flatten(transform(s, (a, i) -> transform("
        f"filter(slice(s, i + 2, size(s)), b -> bit_count(a ^ b) <= {DISTANCE}),"
        " b -> struct(a AS high, b AS low))))"
    )
    return grouped.select(F.inline(pairs))


def _crowded_pairs(prints: DataFrame) -> DataFrame:
    """Edges inside crowded cells, through the one-bit grid."""
    bits = [F.lit(1 << bit if bit < BITS - 1 else -(1 << bit)) for bit in range(BITS)]
    around = F.array("print", *[F.col("print").bitwiseXOR(bit) for bit in bits])
    shared = (
        prints.select("print", F.explode(around).alias("cell"))
        .groupBy("cell")
        .agg(F.collect_list("print").alias("s"))
        .filter("size(s) > 1")
    )
    return shared.select(F.array_min("s").alias("high"), F.explode("s").alias("low")).filter(
        "high != low"
    )


def links(prints: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Edges between distinct fingerprints (column ``print``) that connect all pairs two bits apart.

    Equal fingerprints must have been merged.  Whoever is at most two bits apart
    is joined by an edge or, in crowded cells, by edges through a third one.
    """
    cell = Window.partitionBy("cell")
    met = (
        prints.select("print", F.explode(_cells(F.col("print"))).alias("cell"))
        .withColumn("met", F.count("*").over(cell))
        .filter("met > 1")
    )
    met = stage(met, "cells")
    few = _verified_pairs(met.filter(F.col("met") <= crowded))
    many = _crowded_pairs(met.filter(F.col("met") > crowded).select("print").distinct())
    return few.union(many).distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, crowded: int = CROWDED
) -> DataFrame:
    """``<key>, fingerprint, component_id`` for every row: groups of texts linked by SimHash.

    ``component_id`` is the smallest key reachable over links of at most two
    differing bits.  Null, empty and blank texts share fingerprint zero.  Rows
    that repeat a key each get a row; null keys get a group but never name one
    (a group of null keys only has a null id).  Other columns are ignored, an
    empty table gives an empty one.
    """
    prints = stage(
        docs.select(
            F.col(key).alias("key"), fingerprint(F.col(text), words).alias("print")
        ),
        "fingerprints",
    )
    nodes = prints.groupBy("print").agg(F.min("key").alias("first"))
    groups = components(links(nodes.select("print"), crowded))
    linked = groups.join(nodes, groups.node == nodes.print).select("print", "component", "first")
    names = linked.groupBy("component").agg(F.min("first").alias("name"))
    named = stage(linked.join(names, "component").select("print", "name"), "groups")
    found = nodes.join(named, "print", "left").select(
        "print", F.coalesce("name", "first").alias("component_id")
    )
    return prints.join(found, "print").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """The rows of ``docs`` whose key names their group; all columns as they are.

    A key that several rows share stays if it names the group of any of them;
    rows without a key stay.
    """
    groups = near_duplicates(docs, key, text, words)
    gone = (
        groups.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.col(key) == F.col("component_id")).alias("stays"))
        .filter("not stays")
    )
    return docs.join(gone.select(key), key, "left_anti").select(*docs.columns)
