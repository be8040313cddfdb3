"""What shards report in the first pass: few bytes a phrase, and no frequent phrase missing."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from scrubwell.llm import collocations as c

BITS = 4


def _docs(rng, many: int, words: int) -> list[tuple[str, str]]:
    names = [f"w{n}" for n in range(words)]
    return [(rng.choice(["en", "fr"]), " ".join(rng.choices(names, k=20))) for _ in range(many)]


def _mined(docs, count: int, shard_words: int):
    totals = Counter()
    for lang, text in docs:
        totals[lang] += len(text.encode())
    rows = [(lang, text, totals[lang]) for lang, text in docs]
    batch = pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*rows)], ["lang", "text", "total"])
    return pa.Table.from_batches(list(c._pack(count, 5, shard_words, BITS)(iter([batch]))))


def _phrases(docs) -> Counter:
    found = Counter()
    for lang, text in docs:
        words = text.split()
        found.update((lang, " ".join(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    return found


def test_a_phrase_takes_few_bytes():
    docs = _docs(random.Random(1), 5000, 3000)
    told = _mined(docs, 1, 10**9)  # every phrase of one shard
    sent = sum(len(zlib.compress(b.as_py(), 1)) for name in ("steps", "counts") for b in told[name])
    assert len(_phrases(docs)) > 300_000
    assert sent < 4 * len(_phrases(docs))


@pytest.mark.parametrize("shard_words", [300, 3000, 10**9])
def test_no_frequent_phrase_is_missing(shard_words):
    docs, count, bits = _docs(random.Random(2), 600, 12), 30, 20
    told = _mined(docs, count, shard_words)
    table = np.zeros(1 << bits, bool)
    for lang in ("en", "fr"):
        for part in range(1 << BITS):
            group = told.filter(pa.compute.and_(pa.compute.equal(told["lang"], lang), pa.compute.equal(told["part"], part)))
            if len(group):
                for row in c._candidates(count, BITS, bits)(group).to_pylist():
                    table[row["slot"]] = True
    words = {"en": c.Numbers(), "fr": c.Numbers()}
    for (lang, phrase), many in _phrases(docs).items():
        numbers = np.array([words[lang][w] for w in phrase.encode().split()])
        hashes = c._hashes(list(words[lang]))
        slot = c.slots(lang, numbers, hashes, np.array([0]), len(numbers), bits)[0]
        assert table[slot] or many < count
    assert 0 < table.sum() < len(_phrases(docs))


def test_same_phrases_from_few_and_many_shards(spark, monkeypatch):
    docs = spark.createDataFrame(_docs(random.Random(3), 400, 12), "lang string, text string").repartition(12)
    staged, written = [], c.stage
    monkeypatch.setattr(c, "stage", lambda df, name: staged.append(name) or written(df, name))
    few = sorted(map(tuple, c.collocations(docs, count=20).collect()))
    assert "candidates" not in staged and few
    many = sorted(map(tuple, c.collocations(docs, count=20, shard_words=100).collect()))
    assert "candidates" in staged and many == few
