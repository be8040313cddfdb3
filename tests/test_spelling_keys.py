"""The keys of unknown words neither pass through the driver nor are shuffled without a term."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from scrubwell.operators import spelling


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_of_words_are_not_broadcast(spark):
    words = spark.createDataFrame([("helo",), ("wrold",), ("zzzzzz",)], "word string")
    terms = spark.createDataFrame([("hello", 9), ("world", 5)], "term string, freq bigint")
    vocabulary = spelling.prepare_vocabulary(terms)
    words = spelling.stage(words, "words")  # a small file, as the planner sees it
    for limit in (1, 2):
        found = spelling._nearest(words, vocabulary, limit)
        assert "SortMergeJoin" in _plan(found) and "Broadcast" not in _plan(found)
        assert {tuple(row) for row in found.collect()} == {("helo", "hello", 1), ("wrold", "world", 1)}


def test_only_keys_that_a_term_has_leave_the_task(spark):
    terms = spark.createDataFrame([("hello", 9)], "term string, freq bigint")
    vocabulary = spelling.prepare_vocabulary(terms)
    known = {row.key for row in vocabulary.keys[2].select("key").collect()}
    words = spark.createDataFrame([("helo",), ("zzzzzz",), ("",), (None,)], "word string")
    keys = spelling.deletion_keys(F.col("word"), 2, vocabulary.held[2])
    rows = words.select("word", keys.alias("keys")).collect()
    every = words.select("word", spelling.deletion_keys(F.col("word"), 2).alias("keys")).collect()
    for row, whole in zip(rows, every):
        if row.word is None:
            assert row["keys"] is None
        else:
            assert set(row["keys"]) == known & set(whole["keys"])
    assert len(rows[0]["keys"]) > 0 and rows[1]["keys"] == []
    table = np.frombuffer(vocabulary.held[2].value, np.uint8)
    assert int(np.unpackbits(table).sum()) == len({key >> 38 & (1 << 26) - 1 for key in known})
