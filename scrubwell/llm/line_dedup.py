"""Repeated lines: hashes sorted over ranges, first occurrences streamed; DataFrame functions only.

Every line long enough becomes a row of hash, document and position, without
its text.  The rows are dealt out by ranges of hash and lane (a lane is a
part of the documents, so that a line found everywhere spreads over many
tasks) and sorted by document and position within; the first document of each
hash and lane streams past and every later row of it is dropped.  The lane
winners of a hash, one document per lane at most, are then settled the same
way.  What comes back is a bitmap per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrubwell.session import stage

BLANK = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LANES = 64
WORD = 64


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    trimmed = F.btrim(line, F.lit(BLANK))
    plain = F.octet_length(trimmed) == F.char_length(trimmed)
    return F.when(plain, F.lower(trimmed)).otherwise(F.translate(trimmed, UPPER, UPPER.lower()))


def _content(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _line_rows(docs: DataFrame, least: int) -> DataFrame:
    """``key, place, h1, h2, lane`` of the lines that may be dropped; two hashes make 128 bits."""
    lines = docs.select("key", F.posexplode(F.split(_content(F.col("text")), "\n", -1)))
    keyed = lines.select("key", F.col("pos").alias("place"), line_key(F.col("col")).alias("line"))
    return keyed.filter(F.char_length("line") >= least).select(
        "key",
        "place",
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"),
        F.pmod(F.xxhash64("key"), F.lit(LANES)).cast("int").alias("lane"),
    )


def _later(rows: DataFrame, *group: str) -> DataFrame:
    """``rows`` with ``first``, the smallest key of their group, in sorted order."""
    order = Window.partitionBy(*group).orderBy("key", "place")
    return rows.withColumn("first", F.first("key").over(order))


def dropped_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 10
) -> DataFrame:
    """``key, place`` of every line whose key at least one smaller document holds as well."""
    named = docs.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text")
    )
    rows = stage(_line_rows(named, least), "lines")
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, "h1", "h2", "lane")
    told = stage(_later(dealt, "h1", "h2", "lane"), "lanes")
    later = told.filter("key > first").select("key", "place")
    winners = _later(told.filter("key = first").drop("first", "lane"), "h1", "h2")
    return later.union(winners.filter("key > first").select("key", "place"))


def bitmaps(dropped: DataFrame) -> DataFrame:
    """``key, words``: per document the 64-bit words with a dropped line, as number and bits.

    A word in which every line stays is left out, so a bitmap is as long as the
    damage, not as the document; bit i of word w is set if line 64 w + i goes.
    """
    word = F.floor(F.col("place") / WORD).cast("int")
    bit = F.expr(f"shiftleft(1L, place % {WORD})")
    return (
        dropped.groupBy("key", word.alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
    )


def _places(words: str) -> str:
    """SQL for the sorted places of the set bits."""
    return (
        f"flatten(transform({words}, w -> filter(transform(sequence(0, {WORD - 1}),"
        f" i -> if((shiftright(w.bits, i) & 1L) = 1L, w.word * {WORD} + i, -1)), p -> p >= 0)))"
    )


def apply_bitmaps(
    docs: DataFrame, maps: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_lines, n_dropped, kept_text``: the lines that stay, joined again.

    Between two dropped lines the lines are copied as one slice.
    """
    named = docs.select(F.col(key).alias("key"), _content(F.col(text)).alias("text"))
    placed = named.join(maps.withColumn("gone", F.expr(_places("words"))), "key", "left")
    kept = (
        "array_join(flatten(zip_with(concat(array(-1), gone), concat(gone, array(n_lines)),"
        " (a, b) -> slice(lines, a + 2, b - a - 1))), '\\n')"
    )
    return (
        placed.withColumn("lines", F.split("text", "\n", -1))
        .withColumn("n_lines", F.size("lines"))
        .select(
            "key",
            F.col("n_lines").cast("bigint").alias("n_lines"),
            F.coalesce(F.size("gone").cast("bigint"), F.lit(0)).alias("n_dropped"),
            F.when(F.col("gone").isNull(), F.col("text"))
            .otherwise(F.expr(kept))
            .alias("kept_text"),
        )
    )


def drop_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 10
) -> DataFrame:
    """``<key>, n_lines, n_dropped, kept_text`` for every row.

    A line whose key has ``least`` code points or more and occurs in several
    documents stays in the one with the smallest id only (there with all its
    repeats).  Null and empty texts are one empty line.  Rows without an id keep
    all lines and take none from others; rows that share an id are one document,
    whose lines at one place go if any of them goes.  Other columns are ignored.
    """
    maps = bitmaps(dropped_lines(docs, key, text, least))
    return apply_bitmaps(docs, maps, key, text).withColumnRenamed("key", key)
