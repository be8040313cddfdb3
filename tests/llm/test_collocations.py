"""Collocations against counting every phrase, with shards of every size, and hard rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from scrubwell.llm import collocations as co


def brute(rows, count, longest=5, first=2000, cover=100):
    """The result rows by counting all phrases."""
    many, words = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            tokens = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(tokens)
            for size in range(1, longest + 1):
                for at in range(len(tokens) - size + 1):
                    many[lang, tuple(tokens[at : at + size])] += 1
    often = {key: a for key, a in many.items() if a >= count}
    told = []
    for (lang, phrase), a in often.items():
        if len(phrase) < 2:
            continue
        if any(
            100 * b >= cover * a
            for (other, longer), b in often.items()
            if other == lang
            and len(longer) > len(phrase)
            and any(longer[i : i + len(phrase)] == phrase for i in range(len(longer)))
        ):
            continue
        n = words[lang]
        score, _, left, right = min(
            (1000 * a * n // (many[lang, phrase[:k]] * many[lang, phrase[k:]]), k, many[lang, phrase[:k]], many[lang, phrase[k:]])
            for k in range(1, len(phrase))
        )
        told.append((lang, " ".join(phrase), a, left, right, n, score))
    ranked = []
    for lang in {row[0] for row in told}:
        own = sorted((r for r in told if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *row[1:]) for i, row in enumerate(own[:first])]
    return sorted(ranked)


def rows_of(frame):
    assert frame.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(row) for row in frame.collect())


def corpus(draw, many):
    words = [f"W{i}" for i in range(12)] + ["é", "Ü", "\x1c", "\xa0", "中"]
    phrases = [" ".join(draw.choices(words, k=draw.randint(2, 6))) for _ in range(8)]
    for _ in range(many):
        parts = [
            draw.choice(phrases) if draw.random() < 0.6 else draw.choice(words)
            for _ in range(draw.randint(0, 30))
        ]
        text = "".join(part + draw.choice([" ", "  ", "\t", ". ", "\n", " ,"]) for part in parts)
        yield draw.choice(["en", "en", "en", "de", None, "und"]), text


@pytest.mark.parametrize("shard, slot_bits", [(30, 26), (300, 26), (300, 7), (1 << 20, 12)])
def test_against_counting_all(spark, shard, slot_bits):
    rows = list(corpus(random.Random(shard), 300))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    size = {"shard_words": shard, "slot_bits": slot_bits}
    assert rows_of(co.collocations(docs, count=10, **size)) == brute(rows, 10)
    few = co.collocations(docs, count=25, longest=3, first=4, cover=70, **size)
    assert rows_of(few) == brute(rows, 25, 3, 4, 70)


def test_candidates_are_few_where_shards_are_large(spark, monkeypatch):
    """A phrase that keeps under its share in all shards is not counted."""
    rows = [("en", f"common pair here x{i} rare{i % 150} word{i % 150}.") for i in range(3000)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    seen = []
    table = co._table
    monkeypatch.setattr(co, "_table", lambda c, bits: seen.append({r.phrase for r in c.collect()}) or table(c, bits))
    counts, words = co.phrase_counts(docs, count=400)
    assert {r.phrase for r in counts.collect()} == {"common", "pair", "here", "common pair", "pair here", "common pair here"}
    assert [(r.lang, r.n) for r in words.collect()] == [("en", 3000 * 6)]
    assert len(seen[0]) == 6


def test_exact_numbers_beyond_64_bits(spark):
    """Scores from counts whose products pass 64 bits."""
    big = 9_000_000_000_000
    counts = spark.createDataFrame(
        [("en", "a", big), ("en", "b", big - 1), ("en", "a b", big - 7)], "lang string, phrase string, many bigint"
    )
    words = spark.createDataFrame([("en", 7 * big)], "lang string, n bigint")
    row = co._scored(counts, words).first()
    assert row.score == 1000 * (big - 7) * 7 * big // (big * (big - 1))


def test_hard_rows(spark):
    long = "so it goes on, " * 30_000
    rows = [("en", long), ("en", None), (None, ""), (None, "a b. a b! a\tb\nA  B"), ("", "x y x y x y x y"), ("en", " \n ,.;")]
    docs = spark.createDataFrame(
        [(lang, text, "p", 1, 2) for lang, text in rows] * 2,
        "lang string, text string, phrase string, many int, total int",
    )
    assert rows_of(co.collocations(docs, count=6)) == brute(rows * 2, 6)
    assert rows_of(co.collocations(docs.limit(0))) == []
    names = docs.selectExpr("lang AS text", "text AS lang")
    assert rows_of(co.collocations(names, "text", "lang", count=6)) == brute(rows * 2, 6)


def test_phrases_grow_from_accepted_parts():
    words = np.array([1, 2, 1, 2, 1, 0, 2, 1, 0], np.int32)
    found = {
        (length, tuple(words[place : place + length].tolist())): many
        for length, places, counts in co.grow(words, 4, lambda *x: x[2] >= 2)
        for place, many in zip(places.tolist(), counts.tolist())
    }
    assert found == {(1, (1,)): 4, (1, (2,)): 3, (2, (1, 2)): 2, (2, (2, 1)): 3, (3, (1, 2, 1)): 2}


def test_shards_do_not_follow_the_splits_of_the_input(spark, monkeypatch):
    """A table in many small splits is mined in as few shards as keep every core at work."""
    rows = [("en", f"pair of words {i % 7} and x{i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(60)
    seen = []
    written = co.stage
    monkeypatch.setattr(co, "stage", lambda df, name: seen.append((name, written(df, name))) or seen[-1][1])
    result = rows_of(co.collocations(docs, count=100))
    assert result == brute(rows, 100)
    mined = dict(seen)["mined"]
    # what unreported phrases may have: a share less one from each shard, and no shard's share is small
    assert mined.filter("phrase IS NULL").first().excess >= 100 - 2 * spark.sparkContext.defaultParallelism
    assert mined.filter("phrase LIKE 'x%'").count() == 0


def test_places_in_chunks(monkeypatch):
    """The same phrases whether their places are told apart at once or in parts."""
    draw = np.random.default_rng(3)
    words = np.minimum(draw.geometric(0.2, 5000), 30).astype(np.int32) * (draw.random(5000) > 0.1)

    def found():
        return sorted(
            (length, tuple(words[place : place + length].tolist()), place, many)
            for length, places, counts in co.grow(words.astype(np.int32), 5, lambda *x: x[2] >= 3)
            for place, many in zip(places.tolist(), counts.tolist())
        )

    whole = found()
    monkeypatch.setattr(co, "CHUNK", 64)
    assert found() == whole and len({row[0] for row in whole}) == 5
