"""One row per identical text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_texts(df: DataFrame, order: str = "doc_id", text: str = "text") -> DataFrame:
    """Keep the row with the smallest ``order`` of every distinct non-null text.

    An aggregate rather than a window: copies fall together inside each task
    before the shuffle, so a text that makes up a third of the corpus arrives
    as one row per task instead of filling one partition.  The hash comes first
    in the grouping, so sorts compare numbers and whole texts only on ties.
    """
    present = df.filter(F.col(text).isNotNull())
    grouped = present.groupBy(F.xxhash64(text).alias("_hash"), F.col(text))
    rest = [name for name in df.columns if name not in (text, order)]
    if not rest:
        return grouped.agg(F.min(order).alias(order)).select(*df.columns)
    # a null order comes last, and its row keeps its columns
    first = F.min_by(F.struct(order, *rest), F.struct(F.col(order).isNull(), order))
    return grouped.agg(first.alias("_row")).select(text, "_row.*").select(*df.columns)


def dedupe_report(findings: DataFrame, kept: DataFrame, key: str = "doc_id") -> DataFrame:
    """The findings of the rows that survived.

    Rows without a key are one group here: their findings stay if any of them survived.
    ``Cleaner.clean_distinct`` keeps findings on their row and can tell them apart.
    """
    stays = kept.select(F.col(key).alias("_key")).distinct()
    return findings.join(stays, F.equal_null(findings[key], stays["_key"]), "left_semi")
