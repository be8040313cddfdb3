"""Reports that are stored per run and add up over runs without reading the texts again.

Changes and changed texts are counts and add up exactly, as long as runs do not share rows.
How many *different* texts were changed, and which originals were replaced most often, does not add up;
for these a run stores sketches, which do.  A run's report is one row per group and tag, whatever the
size of the run, and a run that is reported again replaces its own report.  Where nearly all originals differ
a sketch names none of them; a run may store how often it replaced each, which adds up exactly.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HLL_BITS = 14  # relative standard error of distinct texts: 1.04 / sqrt(2 ** 14), 0.8 %
TRACKED = 10_000  # originals a sketch of a group follows; counts are exact while there are fewer
RUN = "run"


def distinct_error(bits: int = HLL_BITS) -> float:
    """The relative standard error of ``distinct_texts``."""
    return 1.04 / 2 ** (bits / 2)


def run_report(
    cleaned: DataFrame,
    groups: list[str] | None = None,
    text: str = "text",
    findings: str = "findings",
    bits: int = HLL_BITS,
    tracked: int = TRACKED,
) -> DataFrame:
    """``groups, tag, changes, texts, distinct_texts, originals`` of one cleaned table.

    The last two are sketches: of the changed texts as they are after cleaning, and of the replaced
    originals.  Counts and sketches are built in the tasks that clean; one row per group, tag and task is
    shuffled.  A group that holds most of the rows is no larger than another.
    """
    groups = groups or []
    found = cleaned.select(
        *groups, F.xxhash64(F.col(text)).alias("_content"), F.expr(f"posexplode({findings}) AS (_at, _found)"),
        F.col(findings).alias("_all"),
    )
    # the first finding of a tag stands for the text
    first = F.expr("array_position(transform(_all, f -> f.tag), _found.tag) = _at + 1")
    rows = found.select(*groups, "_content", "_found.tag", "_found.original", first.alias("_first"))
    return rows.groupBy(*groups, "tag").agg(
        F.count("*").alias("changes"),
        F.count_if("_first").alias("texts"),
        F.hll_sketch_agg("_content", bits).alias("distinct_texts"),
        F.expr(f"approx_top_k_accumulate(original, {tracked})").alias("originals"),
    )


def original_counts(
    cleaned: DataFrame, groups: list[str] | None = None, findings: str = "findings"
) -> DataFrame:
    """``groups, tag, original, n``: how often a run replaced each original, as rows, stored like a report."""
    groups = groups or []
    found = cleaned.select(*groups, F.explode(findings).alias("_found"))
    return found.select(*groups, "_found.tag", "_found.original").groupBy(*groups, "tag", "original").agg(
        F.count("*").alias("n")
    )


def top_originals(counts: DataFrame, groups: list[str] | None = None, top: int = 10) -> DataFrame:
    """``groups, tag, top_originals`` over the stored counts of runs, exact; equals in order of the original.

    Each task keeps its first ``top`` of a group before the shuffle, so a tag that holds
    most originals is no larger than another.
    """
    groups = groups or []
    whole = counts.filter(F.col("original").isNotNull()).groupBy(*groups, "tag", "original").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*groups, "tag").orderBy(F.desc("n"), "original")
    first = whole.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= top)
    items = F.array_sort(F.collect_list(F.struct("_rank", "original", "n")))
    return first.groupBy(*groups, "tag").agg(
        F.transform(items, lambda i: F.struct(i["original"].alias("item"), i["n"].alias("count"))).alias("top_originals")
    )


def store_report(report: DataFrame, path: str, run: str) -> None:
    """Write a run's report beside those of other runs; one of the same run is replaced."""
    report.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{RUN}={run}")


def stored_reports(spark: SparkSession, path: str) -> DataFrame:
    """The reports of all runs, with their ``run``."""
    return spark.read.option("basePath", path).parquet(path).withColumn(RUN, F.col(RUN).cast("string"))


def merged_report(
    reports: DataFrame,
    groups: list[str] | None = None,
    top: int = 10,
    tracked: int = TRACKED,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``groups, tag, runs, changes, texts, distinct_texts, top_originals`` over runs.

    ``changes`` and ``texts`` are exact.  ``distinct_texts`` has a relative standard error of
    :func:`distinct_error`.  ``top_originals`` lists ``item, count``, most frequent first; counts are exact
    while a group has no more than 3/4 of ``tracked`` different originals, beyond that they
    may be too low by at most 2 * changes / ``tracked``, and an original more frequent than that is never missing.
    With the stored :func:`original_counts` of the runs as ``counts`` it is exact.
    """
    groups = groups or []
    merged = reports.groupBy(*groups, "tag").agg(
        F.count_distinct(RUN).alias("runs"),
        F.sum("changes").alias("changes"),
        F.sum("texts").alias("texts"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_texts")).alias("distinct_texts"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(originals, {tracked}), {top})").alias("top_originals"),
    )
    if counts is None:
        return merged
    keys = [*groups, "tag"]
    exact = top_originals(counts, groups, top).toDF(*[f"_{name}" for name in keys], "_exact")
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in keys])
    listed = F.coalesce("_exact", "top_originals").alias("top_originals")
    return merged.join(exact, same, "left").select(*[c for c in merged.columns if c != "top_originals"], listed)
