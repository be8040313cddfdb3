"""Grams are counted where texts are read, and meet the profiles once a text."""

import random
from collections import Counter

from pyspark.sql import functions as F

from scrubwell.functions.text import character_grams
from scrubwell.operators import language

ALPHABET = ["a", "b", "B", " ", "\n", "\x00", "é", "İ", "ſ", "😀", "\U0010ffff", "\u0301"]


def _rows(spark, size=60):
    rng = random.Random(size)
    values = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 40))) for _ in range(size)]
    values += [None, "", "ab", "abc", "a" * 500]
    return spark.createDataFrame([(n, v, rng.choice(["en", "de", None])) for n, v in enumerate(values)],
                                 "doc_id bigint, text string, lang string")


def test_profiles_count_every_gram_over_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(language, "CHUNK", 7)
    monkeypatch.setattr(language, "KINDS", 5)
    docs = _rows(spark)
    grams = docs.select("lang", F.explode(character_grams(F.lower("text"), 3)).alias("gram"))
    want = Counter((r.lang, r.gram) for r in grams.collect() if r.lang)
    profiles = language.profile_table(language.train_language_model(docs)).collect()
    assert {(r.lang, r.gram): r.n for r in profiles} == dict(want)


def test_scores_equal_the_sum_over_all_grams(spark):
    docs = _rows(spark).union(_rows(spark).limit(9))
    model = language.train_language_model(docs)
    profiles = {r.gram: r for r in model.profiles.collect()}
    floor = {name: spark.range(1).select(language._milli_log(F.lit(1) / F.lit(model.mass[name]))).first()[0]
             for name in model.languages}
    for row in language.detect_language(docs, model).withColumn(
        "grams", character_grams(F.lower("text"), 3)
    ).collect():
        found = row.grams or []
        scores = [
            (sum(profiles[g][f"gain_{name}"] for g in found if g in profiles) + len(found) * floor[name], name)
            for name in model.languages
        ]
        assert row.lang_detected == (max(scores)[1] if found else None)


def test_a_repeated_gram_is_one_row(spark):
    docs = spark.createDataFrame([("en", "a" * 10_000)], "lang string, text string")
    counted = docs.select(F.explode(language._counted(F.col("text"))).alias("has")).select("has.*").collect()
    assert [row.n for row in counted] == [9_998]
    tallied = language._tallied(docs.select(F.lit(1).cast("bigint").alias("place"), "text")).collect()
    assert [(row.place, row.gram, row.n) for row in tallied] == [(1, "aaa", 9_998)]
