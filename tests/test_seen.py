"""Deduplication over several runs."""

import pytest
from pyspark.sql import functions as F

from scrubwell.operators import dedupe
from scrubwell.operators.seen import SeenTexts
from scrubwell.plans.cleaner import Cleaner
from scrubwell.plans.config import NO_TABLES, CleanConfig

RUNS = {
    "mon": [(5, "a"), (3, "a"), (4, "b"), (None, "c"), (9, None)],
    "tue": [(1, "a"), (7, "d"), (6, "d"), (8, "e"), (2, "")],
    "wed": [(0, "b"), (10, "f"), (11, "e"), (12, "c"), (13, "")],
}
WANT = {"mon": [(3, "a"), (4, "b"), (None, "c")], "tue": [(2, ""), (6, "d"), (8, "e")], "wed": [(10, "f")]}


def table(spark, rows):
    return spark.createDataFrame([(*row, "x") for row in rows], "doc_id bigint, text string, source string")


def told(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=lambda row: (row[0] is None, row))


@pytest.fixture
def seen(spark, tmp_path):
    made = SeenTexts(spark, str(tmp_path / "seen"), buckets=4, bits=6)
    yield made
    made.forget()


def test_three_runs_and_repeats(spark, seen, tmp_path):
    for run, rows in RUNS.items():
        got = seen.first_sights(table(spark, rows), run)
        assert got.columns == ["doc_id", "text", "source"]
        assert told(got) == WANT[run]
    before = seen.hashes().count()
    assert before == 7
    # a run done again, as after a failure: same rows, nothing written twice
    for run, rows in RUNS.items():
        assert told(seen.first_sights(table(spark, rows), run)) == WANT[run]
    assert seen.hashes().count() == before
    # another session finds what is in the folder
    seen.forget()
    again = SeenTexts(spark, str(tmp_path / "seen"), buckets=4, bits=6)
    assert told(again.first_sights(table(spark, RUNS["mon"] + [(50, "new")]), "thu")) == [(50, "new")]
    assert told(again.first_sights(table(spark, []), "fri")) == []


def test_equal_to_one_run(spark, tmp_path):
    rows = [(n, f"t{n * n % 97}") for n in range(400)]
    one = told(dedupe.dedupe_texts(table(spark, rows)))
    many = SeenTexts(spark, str(tmp_path / "many"), buckets=4)
    parts = [told(many.first_sights(table(spark, rows[at : at + 90]), f"run{at}")) for at in range(0, 400, 90)]
    assert sorted(row for part in parts for row in part) == one
    many.forget()


def test_the_index_is_not_moved(spark, seen):
    seen.first_sights(table(spark, RUNS["mon"]), "mon")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = table(spark, RUNS["tue"]).select(F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("text_hash"))
        met = asked.join(seen.hashes(), "text_hash", "left_semi")
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_cleaner_over_runs(spark, seen):
    cleaner = Cleaner(CleanConfig(replace_ip=True, **NO_TABLES))
    first = table(spark, [(1, "ip 10.0.0.1"), (2, "ip 10.0.0.2")])
    second = table(spark, [(3, "ip 10.0.0.3"), (4, "other 10.0.0.4")])
    cleaned, found = cleaner.clean_new(first, seen, "one")
    assert told(cleaned) == [(1, "ip [IPV4_REDACTED]")]
    assert [(r.doc_id, r.original) for r in found.collect()] == [(1, "10.0.0.1")]
    cleaned, found = cleaner.clean_new(second, seen, "two")
    assert told(cleaned) == [(4, "other [IPV4_REDACTED]")]
    assert [(r.doc_id, r.original) for r in found.collect()] == [(4, "10.0.0.4")]


def test_findings_of_rows_without_a_key_stay(spark):
    findings = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, "d")], "doc_id bigint, tag string")
    kept = spark.createDataFrame([(1, "t"), (None, "u"), (None, "v")], "doc_id bigint, text string")
    assert sorted(r.tag for r in dedupe.dedupe_report(findings, kept).collect()) == ["a", "c"]
    none = kept.filter("doc_id is not null")
    assert sorted(r.tag for r in dedupe.dedupe_report(findings, none).collect()) == ["a"]
