"""Shards by rendezvous hashing of record keys over weighted shards; DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubwell.session import stage

WORD = 0xFFFFFFFF
FACTOR = 0x45D9F3B
RECORD = "__record"
BUCKETS = 256  # parts of a shard that are numbered apart


def _mix(x):
    """A 32-bit mixing function, for columns and for plain numbers; products stay below 2**59."""
    shift, meet = (
        (F.shiftright, lambda a, b: a.bitwiseXOR(b))
        if isinstance(x, Column)
        else (lambda a, n: a >> n, lambda a, b: a ^ b)
    )
    keep = (lambda a: a.bitwiseAND(F.lit(WORD))) if isinstance(x, Column) else lambda a: a & WORD
    for _ in range(2):
        x = keep(meet(x, shift(x, 16)) * FACTOR)
    return meet(x, shift(x, 16))


def mix_sql(x: str) -> str:
    """The mixing function as SQL text."""
    for _ in range(2):
        x = f"((xor({x}, ({x}) >> 16) * {FACTOR}) & {WORD})"
    return f"xor({x}, ({x}) >> 16)"


def with_record(docs: DataFrame, key: str, name: str = RECORD) -> DataFrame:
    """``docs`` with 32 hash bits of a key; a null key counts as 0.

    Whole numbers are taken as they are, keys of other types by a hash of their text.  The steps are columns of their own: written into one another, the mixing
    functions would repeat their input many times over.
    """
    whole = isinstance(docs.schema[key].dataType, T.IntegralType)
    named = F.col(key).cast("bigint") if whole else F.xxhash64(F.col(key).cast("string"))
    number = F.when(F.col(key).isNull(), 0).otherwise(named)
    high = F.shiftright(number, 32).bitwiseAND(F.lit(WORD))
    stepped = docs.withColumn(name, _mix(high))
    return stepped.withColumn(name, number.bitwiseAND(F.lit(WORD)).bitwiseXOR(F.col(name))).withColumn(
        name, _mix(F.col(name))
    )


def shard_hash(shard: int) -> int:
    return _mix((shard + 1) * 0x9E3779B1 & WORD)


def _bid(record: Column, shard: int, weight: float | None) -> Column:
    """What a shard bids for a record; ties go to the smaller shard.

    With equal weights the hash itself ranks as the weighted bid would.
    """
    drawn = _mix(record.bitwiseXOR(F.lit(shard_hash(shard))))
    if weight is not None:
        drawn = -weight / F.log((drawn + 0.5) / math.ldexp(1, 32))
    return F.struct(drawn.alias("bid"), F.lit(-shard).alias("minus"))


def best_bid(record: Column, weights: Mapping[int, float], even: bool) -> Column:
    if not weights or min(weights.values()) <= 0:
        raise ValueError("every shard needs a positive weight")
    bids = [_bid(record, shard, None if even else weight) for shard, weight in weights.items()]
    return bids[0] if len(bids) == 1 else F.greatest(*bids)


def shard_of(record: Column, weights: Mapping[int, float]) -> Column:
    """The shard (int) with the highest bid; shards with more weight win in proportion.

    A record's bids depend on its key and the shard alone.  Adding a shard moves
    exactly the records it outbids all others for, removing one moves only its own.
    """
    return (-best_bid(record, weights, len(set(weights.values())) == 1)["minus"]).cast("int")


def assign(
    docs: DataFrame,
    shards: int | Mapping[int, float],
    key: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
) -> DataFrame:
    """``<key>, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    ``shards`` is a number of equal shards or their weights.  ``slot`` numbers the
    rows of a shard from 0 without gaps; ``grown_shard`` is the shard with one
    more of average weight.  A null text has no bytes, a null key is keyed as 0
    (and keeps its null).  Rows that repeat a key go to the same shard and get
    slots of their own; equal rows are interchangeable.  Only keys and sizes are
    shuffled: a shard is numbered in ``buckets`` independent parts, whose counts
    (shards times buckets rows) give the offsets.
    """
    weights = dict.fromkeys(range(shards), 1.0) if isinstance(shards, int) else dict(shards)
    more = {max(weights) + 1: sum(weights.values()) / len(weights)}
    even = len(set(weights.values())) == 1
    content = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(content) + 16).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("crc"),
    )
    record = F.col(RECORD)
    placed = (
        with_record(sized, "key")
        .withColumn("best", best_bid(record, weights, even))
        .withColumn("grown", F.greatest("best", best_bid(record, more, even)))
        .select(
            *("key", "size", "crc"),
            (-F.col("best.minus")).cast("int").alias("shard"),
            (-F.col("grown.minus")).cast("int").alias("grown"),
            (_mix(record.bitwiseXOR(F.col("crc"))) % buckets).cast("int").alias("part"),
        )
    )
    placed = stage(placed, "placed")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "part")
        .count()
        .withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .select("shard", "part", "offset")
    )
    inside = Window.partitionBy("shard", "part").orderBy("key", "crc", "size")
    return (
        placed.withColumn("rank", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), ["shard", "part"])
        .select(
            F.col("key").alias(key),
            "size",
            F.col("crc").alias("text_crc32"),
            F.lit("key").alias("law"),
            "shard",
            (F.col("offset") + F.col("rank")).cast("bigint").alias("slot"),
            F.col("grown").alias("grown_shard"),
        )
    )


def write_shards(docs: DataFrame, path: str, shards: int | Mapping[int, float], key: str = "doc_id"):
    """Write all columns of ``docs`` as Parquet, one folder ``shard=N`` per shard.

    Every task writes its own files of every shard, so no shard is gathered.
    """
    weights = dict.fromkeys(range(shards), 1.0) if isinstance(shards, int) else dict(shards)
    if "shard" in docs.columns:
        raise ValueError("docs must not have a column shard")
    placed = with_record(docs, key).withColumn("shard", shard_of(F.col(RECORD), weights))
    placed.drop(RECORD).write.partitionBy("shard").parquet(path)
