"""Periodic runs against brute force: hand-made sequences, hard rows, and the registered query."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest

from scrubwell.llm import periodic_runs, queries

FOLDER = "/root/testdata/sf0.001"


def brute_runs(words):
    """``start, length, period`` of all runs by trying every period at every word."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        at = 0
        while at < len(words) - period:
            stop = at
            while stop < len(words) - period and words[stop] == words[stop + period]:
                stop += 1
            if stop + period - at >= max(6, 4 * period):
                found.setdefault((at, stop + period), period)
            at = stop + 1
    runs = [(start, end - start, period) for (start, end), period in found.items()]
    return sorted(runs, key=lambda run: (run[0], run[2]))


def brute_collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def made(rows):
    return [(run["start"], run["length"], run["period"]) for run in rows]


def sequences():
    draw = random.Random(11)
    yield from ("", " \t", "a", "a a a a a", "a a a a a a", "a b a b a b a b", "a b " * 31 + "a")
    for _ in range(1500):
        size, kinds = draw.randint(0, 60), draw.choice([1, 2, 2, 3, 4, 8])
        words = [f"w{draw.randrange(kinds)}" for _ in range(size)]
        if draw.random() < 0.7:
            period, kinds = draw.randint(1, 12), draw.choice([2, 3, 9])
            root = [f"w{draw.randrange(kinds)}" for _ in range(period)]
            middle = (root * 8)[: draw.randint(4 * period, 8 * period)]
            words = words[: draw.randint(0, 10)] + middle + words[: draw.randint(0, 15)]
        yield " ".join(words)
    overlap = "a"  # Thue-Morse: squares, no cubes
    for _ in range(8):
        overlap += overlap.translate(str.maketrans("ab", "ba"))
    yield " ".join(overlap)
    one, two = "a", "ab"  # Fibonacci: many cubes, no run of four periods but short ones
    for _ in range(9):
        one, two = two, two + one
    yield " ".join(two)
    yield "x " * 3000
    yield " ".join(f"w{i % 700}" for i in range(5000))


def test_runs_against_every_period():
    texts = list(sequences())
    for text, (size, runs, collapsed) in zip(texts, periodic_runs.described(texts)):
        words = text.split()
        want = brute_runs(words)
        assert (size, made(runs)) == (len(words), want)
        assert collapsed == brute_collapsed(words, want)


def test_grammar_gives_the_texts_back_and_repeats_no_pair():
    texts = [text for text in sequences()][:300]
    _, words, bounds = periodic_runs._numbered(texts)
    levels = periodic_runs.grammar(words, bounds)
    for level in levels:
        for i in range(len(level.left)):
            model = words[level.start[i] : level.end[i]]
            for place in level.place[level.owner == i].tolist():
                assert (words[place : place + len(model)] == model).all()
    whole = {
        (int(place), int(place + level.end[o] - level.start[o]))
        for level in levels
        for o, place in zip(level.owner, level.place)
    }
    for start, end in zip([0, *bounds[:-1].tolist()], bounds.tolist()):
        assert end - start < 2 or (start, end) in whole


def test_wrong_fingerprints_are_noticed(monkeypatch):
    honest, bases = periodic_runs.Stretches.same, []

    def careless(self, a, b, size):
        """The first base takes everything for equal."""
        bases.append(self.sums[0][1])
        return np.ones(len(a), bool) if bases[-1] == bases[0] else honest(self, a, b, size)

    monkeypatch.setattr(periodic_runs.Stretches, "same", careless)
    words = "x y a b a b a b a b z q a c a d".split()
    _, runs, _ = periodic_runs.described([" ".join(words)])[0]
    assert made(runs) == brute_runs(words)
    assert len(set(bases)) == 2


def test_hard_rows(spark):
    long = " ".join(f"word{i % 977} and\nline number {i % 311} here" for i in range(20_000))
    texts = [None, "", " \n", "go go go go go go", "Go go go go go go", "é é é é é é é", long, "la " * 40_000]
    rows = [(i, text, "k", "r") for i, text in enumerate(texts)]
    rows += [(3, "go go go go go go", None, "r"), (None, "no no no no no no", "k", None), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key string, runs string")
    got = periodic_runs.periodic_runs(docs).collect()
    assert len(got) == len(rows)
    assert sum(row.doc_id is None for row in got) == 2
    texts_of = {}
    for key, text, *_ in rows:
        texts_of.setdefault(key, []).append(text)
    for row in got:
        candidates = [(text or "").encode().split() for text in texts_of[row.doc_id]]
        if row.n_words < 1000:
            known = [(w, brute_runs(w)) for w in candidates if len(w) == row.n_words]
            assert made(row.runs) in [runs for _, runs in known]
        elif row.doc_id == 7:
            assert made(row.runs) == [(0, 40_000, 1)] and row.collapsed == "la"
        else:
            words = [word.decode() for word in candidates[0]]
            assert row.collapsed == brute_collapsed(words, made(row.runs))
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    named = docs.selectExpr("doc_id AS text", "text AS doc_id")
    assert periodic_runs.periodic_runs(named, key="text", text="doc_id").columns[0] == "text"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query(spark):
    got = {row.doc_id: row for row in queries.op11_periodic_runs(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(got) == len(docs)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    planted = 0
    for doc in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", doc.text or "")
        size, check = len(words), zlib.crc32(str(doc.doc_id).encode())
        if check % 10 == 0 and size:
            start = check // 10 % size
            period = 1 + (size - start) // (3 + check // 10 % 8)
            words = [w if i < start else words[start + (i - start) % period] for i, w in enumerate(words)]
        runs, row = brute_runs(words), got[doc.doc_id]
        planted += bool(runs)
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == digest("".join(f"{s},{n},{p}\n" for s, n, p in runs))
        assert row.collapsed_sha256 == digest(brute_collapsed(words, runs))
        if runs:
            start, length, period = min(runs, key=lambda run: (-run[1], run[0], run[2]))
            top = (start, length, period, 1000 * length // period)
        else:
            top = (None,) * 4
        assert (row.start, row.length, row.period, row.exponent_milli) == top
    assert planted
