"""Findings: what was changed, per text, and the reports made from them.

A cleaned table carries its findings as an array on the row they belong to.
Reports count inside the row first, so only small counts are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubwell.functions.text import let

TYPE = "array<struct<step:string,tag:string,original:string,replacement:string,pos:int>>"


def no_findings() -> Column:
    return F.array().cast(TYPE)


def explode_findings(cleaned: DataFrame, keys: list[str], findings: str = "findings") -> DataFrame:
    """One row per change: ``keys, step, tag, original, replacement, pos``."""
    return cleaned.select(*keys, F.inline(findings))


def audit_by_document(cleaned: DataFrame, keys: list[str], findings: str = "findings") -> DataFrame:
    """Per text a map ``tag:replacement`` to the originals, built in the row.

    The findings are sorted by label and place once and cut where the label changes.
    """

    def label(found: Column) -> Column:
        return F.concat(found["tag"], F.lit(":"), F.coalesce(found["replacement"], F.lit("None")))

    def labelled(item: Column, place: Column) -> Column:
        return F.struct(
            label(item).alias("label"),
            place.alias("place"),
            item["tag"].alias("tag"),
            item["replacement"].alias("replacement"),
            item["original"].alias("original"),
        )

    def runs(items: Column) -> Column:
        begins = F.filter(
            F.transform(
                items,
                lambda item, at: F.when(
                    (at == 0) | (item["label"] != F.get(items, at - 1)["label"]), at
                ),
            ),
            lambda at: at.isNotNull(),
        )
        return let(begins, lambda starts: F.transform(starts, lambda at, n: run(items, starts, at, n)))

    def run(items: Column, starts: Column, at: Column, n: Column) -> Column:
        end = F.coalesce(F.get(starts, n + 1), F.size(items))
        first = F.get(items, at)
        originals = F.transform(F.slice(items, at + 1, end - at), lambda item: item["original"])
        return F.struct(
            first["label"].alias("key"),
            F.struct(
                first["tag"].alias("tag"),
                first["replacement"].alias("replacement"),
                originals.alias("originals"),
            ).alias("value"),
        )

    in_order = F.array_sort(F.transform(F.col(findings), labelled))
    return cleaned.select(*keys, F.map_from_entries(let(in_order, runs)).alias("audit"))


def audit_by_key(findings: DataFrame) -> DataFrame:
    """How often each original was replaced under each tag.

    The originals of one tag grow with the corpus, so they stay rows with a
    count; no list of all of them is ever built.
    """
    return findings.groupBy("tag", "replacement", "original").agg(F.count("*").alias("n"))


def _tag_counts(found: Column) -> Column:
    tags = F.array_distinct(F.transform(found, lambda item: item["tag"]))
    return F.transform(
        tags,
        lambda tag: F.struct(
            tag.alias("tag"),
            F.size(F.filter(found, lambda item: item["tag"] == tag)).alias("n"),
        ),
    )


def report_by_source(
    cleaned: DataFrame, source: str | list[str] = "source", findings: str = "findings"
) -> DataFrame:
    """Changes and changed texts per source and tag.

    Each text contributes one row per tag, so texts are counted by adding up
    and no distinct count is needed.
    """
    groups = [source] if isinstance(source, str) else list(source)
    per_text = cleaned.select(*groups, F.inline(_tag_counts(F.col(findings))))
    return per_text.groupBy(*groups, "tag").agg(
        F.sum("n").alias("changes"), F.count("*").alias("texts")
    )


def report_by_run(cleaned: DataFrame, run: DataFrame, findings: str = "findings") -> DataFrame:
    """Totals per tag with the one-row run header beside them."""
    totals = report_by_source(cleaned, [], findings)
    header = F.struct(*[F.col(name) for name in run.columns])
    return totals.withColumn("_run", run.select(header.alias("_run")).scalar()).select(
        "_run.*", "tag", "changes", "texts"
    )
