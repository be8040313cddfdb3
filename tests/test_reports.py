"""Reports that add up over runs, and differences between tables."""

import pytest
from pyspark.sql import functions as F

from scrubwell.operators import reports
from scrubwell.plans.cleaner import Cleaner
from scrubwell.plans.config import NO_TABLES, CleanConfig
from scrubwell.sources import corpus

CLEANER = Cleaner(CleanConfig(replace_ip=True, **NO_TABLES))


def cleaned(spark, rows):
    return CLEANER.transform(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))


def test_runs_add_up(spark, tmp_path):
    path = str(tmp_path / "reports")
    one = [(1, "10.0.0.1 10.0.0.2", "a"), (2, "10.0.0.1", "a"), (3, "a@b.co", "b"), (4, None, "a")]
    two = [(5, "10.0.0.1", "a"), (6, "plain", "a"), (7, "a@b.co 10.0.0.9", "b")]
    reports.store_report(reports.run_report(cleaned(spark, two), ["source"]), path, "two")
    for _ in range(2):  # a run that is done again replaces its report
        reports.store_report(reports.run_report(cleaned(spark, one), ["source"]), path, "one")
    stored = reports.stored_reports(spark, path)
    rows = {(r.source, r.tag): r for r in reports.merged_report(stored, ["source"], top=2).collect()}
    told = {key: (r.runs, r.changes, r.texts, r.distinct_texts) for key, r in rows.items()}
    assert told == {
        ("a", "IPV4"): (2, 4, 3, 1), ("a", "RM_REPEATS"): (1, 1, 1, 1), ("b", "IPV4"): (1, 1, 1, 1), ("b", "EMAIL"): (2, 2, 2, 2),
    }
    assert [(t["item"], t["count"]) for t in rows["a", "IPV4"].top_originals] == [("10.0.0.1", 3), ("10.0.0.2", 1)]
    whole = {r.tag: (r.changes, r.texts) for r in reports.merged_report(stored).collect()}
    assert whole == {"IPV4": (5, 4), "EMAIL": (2, 2), "RM_REPEATS": (1, 1)}


def test_sketches_keep_their_error(spark, tmp_path):
    path = str(tmp_path / "reports")
    docs = spark.range(30_000).selectExpr(
        "id AS doc_id",
        "concat('mail u', if(id % 10 = 0, 7, id), '@example.com of ', id % 20000) AS text", "'s' AS source",
    )
    done = CLEANER.transform(docs)
    for run in range(4):
        part = done.filter(f"doc_id % 4 = {run}")
        reports.store_report(reports.run_report(part, tracked=1000), path, f"r{run}")
    row = reports.merged_report(reports.stored_reports(spark, path), top=1, tracked=1000).first()
    assert (row.changes, row.texts) == (30_000, 30_000)
    exact = done.select("text").distinct().count()
    assert abs(row.distinct_texts - exact) <= 4 * reports.distinct_error() * exact
    assert row.top_originals[0]["item"] == "u7@example.com"
    assert abs(row.top_originals[0]["count"] - 3001) <= 2 * 30_000 / 1000


def test_originals_that_nearly_all_differ_are_counted(spark, tmp_path):
    """A sketch that follows fewer originals than there are names none of them."""
    path, counted = str(tmp_path / "reports"), str(tmp_path / "originals")
    docs = spark.range(4000).selectExpr(
        "id AS doc_id", "concat('mail u', if(id = 9, 8, id), '@example.com') AS text", "cast(null AS string) AS source"
    )
    done = CLEANER.transform(docs)
    for run in range(2):
        part = done.filter(f"doc_id % 2 = {run}")
        reports.store_report(reports.run_report(part, ["source"], tracked=100), path, f"r{run}")
        reports.store_report(reports.original_counts(part, ["source"]), counted, f"r{run}")
    row = reports.merged_report(
        reports.stored_reports(spark, path), ["source"], 2, 100, counts=reports.stored_reports(spark, counted)
    ).first()
    assert (row.source, row.tag, row.runs, row.changes) == (None, "EMAIL", 2, 4000)
    assert [tuple(item) for item in row.top_originals] == [("u8@example.com", 2), ("u0@example.com", 1)]


def test_report_of_nothing(spark):
    assert reports.run_report(cleaned(spark, []), ["source"]).count() == 0
    assert reports.run_report(cleaned(spark, [(1, None, None)])).count() == 0


def exact(expected, written):
    lost = expected.exceptAll(written).withColumn("missing_from", F.lit("written"))
    extra = written.exceptAll(expected).withColumn("missing_from", F.lit("expected"))
    return sorted(map(repr, lost.unionAll(extra).collect()))


@pytest.mark.parametrize("buckets", [1, 7, 65_536])
def test_differences_are_those_of_whole_tables(spark, buckets):
    base = spark.range(500).selectExpr("id % 90 AS k", "if(id % 7 = 0, null, concat('t', id % 90)) AS t")
    other = base.filter("k <> 3").union(spark.createDataFrame([(None, None), (5, "t5"), (3, "x")], "k bigint, t string"))
    for left, right in ((base, base), (base, other), (other, base), (base.limit(0), base), (base, base.limit(0))):
        assert sorted(map(repr, corpus.differences(left, right, buckets).collect())) == exact(left, right)
    swapped = other.select("t", "k")
    assert sorted(map(repr, corpus.differences(base, swapped, buckets).collect())) == exact(base, other)


def test_one_differing_row_moves_few(spark):
    base = spark.range(20_000).selectExpr("id AS k", "concat('text ', id) AS t")
    other = base.withColumn("t", F.when(F.col("k") == 77, "changed").otherwise(F.col("t")))
    found = corpus.differing_buckets(base, other)
    assert found.count() <= 2
    compared = base.withColumn("_bucket", corpus._bucket(base.columns, corpus.BUCKETS)).join(found, "_bucket", "left_semi")
    assert 1 <= compared.count() < 0.05 * 20_000
    assert sorted(r.missing_from for r in corpus.differences(base, other).collect()) == ["expected", "written"]
    assert corpus.differing_buckets(base, base).count() == 0
