"""Exact duplicates by composable polynomial fingerprints and a chunkwise comparison.

A text's bytes, white space normalised, are read as digits of a number modulo
the prime 2**61 - 1.  Chunks are hashed on their own and put together by
shifting: ``hash(ab) = hash(a) * base**len(b) + hash(b)``, so a huge document is
hashed piece by piece, in any grouping.  Texts with equal length and
fingerprint are candidates.  Their chunks are compared as bytes: if every chunk
place of a class holds one content only, its texts are equal; otherwise the
class is split by SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubwell.functions.hashing import IDENTITY, content_identity
from scrubwell.session import stage

PRIME = (1 << 61) - 1
BASE = 0x1B873593CC9E2D51 % PRIME
CHUNK = 1 << 16
LIMB = 21  # bits; a dot product over a chunk stays exact in doubles
BLANKS = b" \t\n\x0b\x0c\r"


def normalise(text: str | None) -> bytes:
    """UTF-8 bytes with every run of ASCII white space as one space; null is empty."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return b" " if data else b""
    return b"".join(
        (b" " * (data[0] in BLANKS), b" ".join(words), b" " * (data[-1] in BLANKS))
    )


@cache
def _powers() -> np.ndarray:
    """Powers of the base, highest first, each cut into three limbs of doubles."""
    powers, value = [], 1
    for _ in range(CHUNK):
        powers.append(value)
        value = value * BASE % PRIME
    limbs = [[p >> (LIMB * i) & ((1 << LIMB) - 1) for i in range(3)] for p in reversed(powers)]
    return np.array(limbs, dtype=np.float64)


def chunk_hash(chunk: bytes) -> int:
    """The polynomial of at most CHUNK bytes; digits are byte values plus one."""
    digits = np.frombuffer(chunk, np.uint8).astype(np.float64) + 1
    limbs = digits @ _powers()[CHUNK - len(chunk) :]
    return sum(int(limb) << (LIMB * i) for i, limb in enumerate(limbs)) % PRIME


def combine(left: tuple[int, int], right: tuple[int, int]) -> tuple[int, int]:
    """The (hash, length) of two neighbouring pieces put together; associative."""
    return (left[0] * pow(BASE, right[1], PRIME) + right[0]) % PRIME, left[1] + right[1]


def polynomial(data: bytes) -> int:
    total = (0, 0)
    for at in range(0, len(data), CHUNK):
        piece = data[at : at + CHUNK]
        total = combine(total, (chunk_hash(piece), len(piece)))
    return total[0]


def digest(text: Column, modulus: int = PRIME) -> Column:
    """``length, print, sha`` of a normalised text.  A smaller modulus weakens ``print``, for tests."""

    @F.arrow_udf("struct<length: bigint, print: bigint, sha: binary>")
    def digests(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            data = normalise(text.as_py())
            rows.append(
                (len(data), polynomial(data) % modulus, hashlib.sha256(data).digest())
            )
        lengths, prints, hashes = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays(
            [
                pa.array(lengths, pa.int64()),
                pa.array(prints, pa.int64()),
                pa.array(hashes, pa.binary()),
            ],
            names=["length", "print", "sha"],
        )

    return digests(text)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of the texts that belong to the class they were joined with."""
    for batch in batches:
        for row in range(batch.num_rows):
            text, length, prints, sha = (batch.column(i)[row].as_py() for i in range(4))
            data = normalise(text)
            if len(data) != length or hashlib.sha256(data).digest() != sha:
                continue  # another text under the same key
            pieces = [data[at : at + CHUNK] for at in range(0, len(data), CHUNK)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([length] * len(pieces), pa.int64()),
                    pa.array([prints] * len(pieces), pa.int64()),
                    pa.array(range(len(pieces)), pa.int64()),
                    pa.array(pieces, pa.binary()),
                ],
                names=["length", "print", "place", "piece"],
            )


def _mixed_classes(docs: DataFrame, digests: DataFrame, classes: DataFrame) -> DataFrame:
    """``length, print`` of the classes whose texts are not all the same.

    Texts are found again by their key, those without one by a hash of their content.  Equal
    chunks meet in the task that reads them, so a class that holds a third
    of all rows sends one copy per task and chunk place.
    """
    many = digests.join(classes.filter("rows > 1"), ["length", "print"]).select(
        "key", *IDENTITY, "length", "print", "sha"
    )
    keyed = many.filter("key IS NOT NULL").drop(*IDENTITY).distinct()
    keyless = many.filter("key IS NULL").drop("key").distinct()
    nameless = docs.filter("key IS NULL").select("text").withColumns(content_identity(F.col("text")))
    columns = ["text", "length", "print", "sha"]
    texts = docs.join(keyed, "key").select(*columns)
    texts = texts.unionAll(nameless.join(keyless, list(IDENTITY)).select(*columns))
    pieces = texts.mapInArrow(
        _chunks, "length bigint, print bigint, place bigint, piece binary"
    ).distinct()
    contents = pieces.groupBy("length", "print", "place").count().filter("count > 1")
    return contents.select("length", "print").distinct()


def exact_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", modulus: int = PRIME
) -> DataFrame:
    """``<key>, keep_id, group_size, kept, text_sha256`` for every row.

    Texts are equal if identical after every run of ASCII white space became one
    space; null counts as empty.  ``keep_id`` is the smallest key of the group
    (null only if all its keys are), ``kept`` tells the rows that carry it: rows
    that repeat one key with one text are one document and stay together, rows
    without a key stay only if the group has no key.  Other columns are ignored;
    an empty table gives an empty one.
    """
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    digests = stage(
        named.select(
            "key",
            *[F.when(F.col("key").isNull(), value).alias(name) for name, value in content_identity(F.col("text")).items()],
            digest(F.col("text"), modulus).alias("d"),
        ).select("key", *IDENTITY, "d.*"),
        "digests",
    )
    classes = digests.groupBy("length", "print").agg(F.count("*").alias("rows"))
    mixed = stage(_mixed_classes(named, digests, classes), "mixed")
    told = digests.join(mixed.withColumn("mixed", F.lit(True)), ["length", "print"], "left")
    told = told.withColumn("part", F.when(F.col("mixed"), F.col("sha")).otherwise(F.lit(b"")))
    groups = told.groupBy("length", "print", "part").agg(
        F.min("key").alias("keep_id"), F.count("*").alias("group_size")
    )
    return told.join(groups, ["length", "print", "part"]).select(
        F.col("key").alias(key),
        "keep_id",
        "group_size",
        F.equal_null("key", "keep_id").alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay; all columns as they are.

    A key that several rows share stays if one of them does; rows without a key stay.
    """
    told = exact_duplicates(docs, key, text)
    gone = (
        told.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max("kept").alias("stays"))
        .filter("not stays")
    )
    return docs.join(gone.select(key), key, "left_anti").select(*docs.columns)
