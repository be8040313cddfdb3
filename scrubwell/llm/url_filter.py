"""Allow and block rules for web addresses, looked up by hashed host-suffix and path-prefix expressions.

Rules come in few shapes (number of host labels, length of the path).  An
address is cut to every shape the rules have, each cut is hashed, a four-byte
hash prefix joins it with the rules, the full digest confirms the match, and the
longest rule decides.  The number of cuts depends on the rules, not on how deep
an address nests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
Rule = tuple[str, str, str]  # verdict, host, path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a web address; both empty without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def _digest(host: Column, path: Column) -> Column:
    # A host has no slash and a path starts with one or is empty: one reading only.
    return F.sha2(F.concat(host, path), 256)


def _prefix(digest: Column) -> Column:
    return F.substring(digest, 1, 8)


def rule_table(spark, rules: Sequence[Rule]) -> DataFrame:
    """``rule, rule_verdict, digest, prefix``; of rules for one expression block wins."""
    merged: dict[tuple[str, str], str] = {}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict}")
        if merged.get((host, path)) != "block":
            merged[host, path] = verdict
    rows = [(host, path, verdict) for (host, path), verdict in merged.items()]
    table = spark.createDataFrame(rows, "host string, path string, rule_verdict string")
    digest = _digest(F.col("host"), F.col("path"))
    return table.select(
        F.concat("host", "path").alias("rule"),
        "rule_verdict",
        digest.alias("digest"),
        _prefix(digest).alias("prefix"),
    )


def _expressions(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Digests of the address cut to every shape the rules have; null where it is too short."""
    shapes = sorted({(rule[1].count(".") + 1, len(rule[2])) for rule in rules})
    cuts = []
    for labels, length in shapes:
        suffix = F.substring_index(host, ".", -labels)
        fits = (F.length(path) >= length) & (F.size(F.split(host, r"\.", labels + 1)) >= labels)
        cuts.append(F.when(fits, _digest(suffix, F.substring(path, 1, length))))
    return F.array_compact(F.array(*cuts))


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """All columns of ``pages`` and ``host, path, rule, verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's;
    the longest rule (host and path) wins, block before allow.  Without a rule
    the verdict is ``default`` and ``rule`` is null.  Null addresses and those
    without ``://`` have an empty host and path and meet no rule.  Columns of the
    input that are named like a new one are replaced.  Each host and path is
    looked up once, however many rows have it.
    """
    host, path = split_url(F.col(url))
    told = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    if not rules:
        return told.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    seen = told.select("host", "path").distinct()
    cut = seen.select(
        "host",
        "path",
        F.explode(_expressions(F.col("host"), F.col("path"), rules)).alias("cut"),
    ).withColumn("prefix", _prefix(F.col("cut")))
    listed = rule_table(pages.sparkSession, rules)
    hits = cut.join(listed, "prefix").filter("cut = digest")
    best = (
        hits.groupBy("host", "path")
        .agg(
            F.max(
                F.struct(F.length("rule").alias("size"), F.col("rule_verdict").alias("verdict"), "rule")
            ).alias("best")
        )
        .select("host", "path", "best.rule", "best.verdict")
    )
    return (
        told.join(best, ["host", "path"], "left")
        .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
        .select(*told.columns, "rule", "verdict")
    )
