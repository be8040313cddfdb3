"""Streams give what the batch jobs give."""

import os

import pytest
from pyspark.sql import functions as F

from scrubwell import session
from scrubwell.plans.cleaner import Cleaner
from scrubwell.plans.config import NO_TABLES, CleanConfig
from scrubwell.sources.corpus import CORPUS_SCHEMA
from scrubwell.streaming import jobs

CONFIG = CleanConfig(replace_ip=True, **NO_TABLES)


def lines(spark, folder, rows, batch):
    df = spark.createDataFrame(rows, CORPUS_SCHEMA)
    df.coalesce(1).write.mode("append").json(str(folder))
    return batch


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    first = [(1, "mail a@b.co", "en", "s"), (2, "ip 10.0.0.1 10.0.0.1", "en", "s")]
    second = [(3, "the the end.", "en", "t")]
    cleaner = Cleaner(CONFIG)
    for rows in (first, second):
        lines(spark, source, rows, None)
        jobs.stream_clean(
            jobs.read_stream(spark, source), cleaner, out, state
        ).awaitTermination()
    streamed = spark.read.parquet(out).select("doc_id", "text").collect()
    batch = cleaner.transform(spark.createDataFrame(first + second, CORPUS_SCHEMA))
    assert sorted(streamed) == sorted(batch.select("doc_id", "text").collect())


def test_stream_batches_run_the_joining_steps(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    lines(spark, source, [(1, "helo", "en", "s")], None)
    cleaner = Cleaner(
        CleanConfig(**NO_TABLES | {"spell_check": True}),
        vocabulary=spark.createDataFrame([("hello", 5)], "term string, freq bigint")
    )
    jobs.stream_clean_batches(
        jobs.read_stream(spark, source), cleaner, out, state
    ).awaitTermination()
    assert [row.text for row in spark.read.parquet(out).collect()] == ["hello"]
    with pytest.raises(ValueError, match="spell_check"):
        jobs.stream_clean(jobs.read_stream(spark, source), cleaner, out, state)


def test_batches_share_dictionaries_and_leave_no_scratch(spark, tmp_path, monkeypatch):
    source, out, state, shared = (str(tmp_path / name) for name in ("in", "out", "state", "shared"))
    for rows in ([(1, "helo Ann Lee", "en", "s")], [(2, "worle of Bob", "en", "s")], [(3, "hello Ann Lee", "en", "s")]):
        lines(spark, source, rows, None)
    cleaner = Cleaner(
        CleanConfig(**NO_TABLES | {"spell_check": True, "replace_entities": True}),
        vocabulary=spark.createDataFrame([("hello", 5), ("world", 4), ("of", 9)], "term string, freq bigint"),
        gazetteer=spark.createDataFrame([("Ann Lee", "PERSON"), ("Bob", "PERSON")], "term string, label string"),
    )
    monkeypatch.setattr(session, "scratch_root", lambda _: shared)
    stream = jobs.read_stream(spark, source, files_per_batch=1)
    jobs.stream_clean_batches(stream, cleaner, out, state).awaitTermination()
    got = {row.doc_id: (row.text, row.batch) for row in spark.read.parquet(out).collect()}
    assert {key: text for key, (text, _) in got.items()} == {
        1: "hello [NAME_REDACTED]", 2: "world of [NAME_REDACTED]", 3: "hello [NAME_REDACTED]",
    }
    assert len({batch for _, batch in got.values()}) == 3
    # one dictionary each for three batches, and nothing that a batch wrote for itself
    left = sorted(name.rsplit("-", 1)[0] for name in os.listdir(shared))
    assert left == ["gazetteer", "term-keys-1", "term-keys-2", "vocabulary"]


def arrivals(spark, source, batches, delay, out, state, **options):
    """Rows ``(second, doc_id, text)`` batch by batch; let through, and still waiting."""
    made = [
        spark.createDataFrame(
            [(key, text, second) for second, key, text in batch], "doc_id bigint, text string, second bigint"
        ).withColumn("at", F.timestamp_seconds(F.col("second") + 1_700_000_040))
        for batch in batches
    ]
    for rows in made:
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = jobs.read_stream(spark, source, rows.schema, "parquet", 1)
        distinct = jobs.dedupe_stream(stream, "at", delay, **options)
        jobs.write_stream(distinct, out, state).awaitTermination()
    passed = spark.read.schema(distinct.schema).parquet(out)
    waiting = jobs.open_texts(spark, state, ["doc_id", "text"])
    return tuple(
        sorted(((row.doc_id, row.text) for row in frame.select("doc_id", "text").collect()), key=repr)
        for frame in (passed, waiting)
    )


def test_stream_dedupe_with_a_hot_text(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    rows = [(n, n, "hot" if n % 3 == 0 else f"t{n % 40}") for n in range(600)]
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    passed, waiting = arrivals(spark, source, [rows[:300], rows[300:]], "1 day", out, state)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider
    first = {}
    for _, key, text in rows:
        first.setdefault(text, key)
    assert (passed, waiting) == ([], sorted(((key, text) for text, key in first.items()), key=repr))


def test_stream_dedupe_keeps_the_smallest_and_forgets(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    batches = [
        # 7 comes before 3 but in one window; keys may be missing; no text is no row
        [(1, 7, "a"), (2, 3, "a"), (3, None, "b"), (4, 9, "b"), (5, None, "c"), (6, 1, None)],
        [(300, 2, "a"), (301, 4, "d")],  # a again, within the time
        [(600, 5, "e")],
        [(4000, 6, "a"), (4001, 8, "e")],  # an hour later both were forgotten
        [(8000, 10, "z")],
        [(9000, 11, "z"), (9000, 12, "y")],  # these windows are open
    ]
    passed, waiting = arrivals(spark, source, batches, "10 seconds", out, state, remember="30 minutes")
    want = [(3, "a"), (9, "b"), (None, "c"), (4, "d"), (5, "e"), (6, "a"), (8, "e"), (10, "z")]
    assert passed == sorted(want, key=repr)
    assert waiting == [(12, "y")]


def test_a_replay_in_any_order_loses_no_row(spark, tmp_path):
    """Files written against the order of their times, one a batch."""
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    hour = 3600
    for start in (3, 1, 2, 0, 9):
        rows = spark.createDataFrame(
            [(start * hour + n * 60 + 1_699_999_200, "a@b.co") for n in range(30)], "doc_id bigint, text string"
        ).withColumn("at", F.timestamp_seconds("doc_id"))
        rows.coalesce(1).write.mode("append").parquet(source)
    stored = spark.read.parquet(source)
    delay = jobs.replay_delay(stored, "at")
    assert int(delay.split()[0]) // 1000 >= 3 * hour
    assert jobs.replay_delay(stored.limit(0), "at") == "600000 milliseconds"
    stream = jobs.read_stream(spark, source, rows.schema, "parquet", 1)
    report = jobs.report_stream(Cleaner(CONFIG).transform(stream), "at", delay)
    jobs.write_stream(report, out, state).awaitTermination()
    closed = spark.read.schema(report.schema).parquet(out)
    open_ones = jobs.open_windows(spark, state)
    assert closed.count() and open_ones.count()
    whole = closed.unionByName(open_ones).orderBy("window_start").collect()
    assert [row.changes for row in whole] == [30] * 5
    assert len({row.window_start for row in whole}) == 5
    assert jobs.open_windows(spark, state).count() == open_ones.count()


def test_stream_report_counts_and_drops_late_rows(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    hour = 3600
    batches = [
        [(0, "a@b.co"), (10, "c@d.co a@b.co")],
        [(5 * hour, "e@f.co")],
        [(20, "late@x.co"), (9 * hour, "g@h.co")],
    ]
    for batch in batches:
        rows = spark.createDataFrame(
            [(second + 1_699_999_200, text) for second, text in batch], "doc_id bigint, text string"
        ).withColumn("at", F.timestamp_seconds("doc_id"))
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = jobs.read_stream(spark, source, rows.schema, "parquet", 1)
        cleaned = Cleaner(CONFIG).transform(stream)
        jobs.write_stream(jobs.report_stream(cleaned, "at"), out, state).awaitTermination()
    found = spark.read.parquet(out).filter("tag = 'EMAIL'").orderBy("window_start").collect()
    assert [(row.tag, row.changes) for row in found] == [("EMAIL", 3), ("EMAIL", 1)]
