"""The training data operators against brute force, other libraries and hard rows."""

import hashlib
import itertools
import os
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F

from scrubwell.llm import (
    byte_bpe,
    decontaminate,
    exact_dedup,
    html_extract,
    line_dedup,
    near_copies,
    pii,
    queries,
    sharding,
    simhash,
    toxicity,
    url_filter,
)
from scrubwell.llm.components import components

FOLDER = "/root/testdata/sf0.001"
EXTRA = "key string, print string, length string, line string, record string, hit string"


@pytest.fixture(scope="module")
def hard(spark):
    """Rows that go wrong easily: nulls, blanks, repeats, long texts, clashing columns."""
    long = " ".join(f"word{i % 977} and\nline number {i % 311} here" for i in range(20_000))
    texts = [
        None, "", "   ", "\n\n", "One two three", "one  two\tthree", "one two three", "Ünïcode ÄB",
        long, long + " end", "a" * 70_000, "x\n" * 50, "this is a shared line\nown", "own\nThis is a shared line ",
    ]
    rows = [(i, text) for i, text in enumerate(texts)] + [(4, "One two three"), (None, "one two three"), (None, None)]
    clash = ["k", None, "l", "m", "r", "h"]
    return spark.createDataFrame(
        [(*row, *clash) for row in rows], f"doc_id bigint, text string, {EXTRA}"
    )


@pytest.fixture(scope="module")
def nothing(hard):
    return hard.limit(0)


def blank(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    size = min(3, len(words))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Smallest member reachable over links of two bits, by brute force."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("crowded", [1, 64])
def test_links_against_all_pairs(spark, crowded):
    draw = random.Random(3)
    prints = {draw.getrandbits(64) for _ in range(30)}
    for _ in range(400):
        seed = draw.choice(sorted(prints))
        for _ in range(draw.randint(1, 3)):
            seed ^= 1 << draw.randrange(64)
        prints.add(seed)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "print bigint")
    found = {r.node: r.component for r in components(simhash.links(table, crowded)).collect()}
    want = groups(prints)
    for i, j in itertools.combinations(range(len(prints)), 2):
        a, b = (found.get(signed[k], signed[k]) for k in (i, j))
        assert (a == b) == (want[i] == want[j])


def test_near_duplicates(hard, nothing):
    rows = hard.select("doc_id", "text").collect()
    prints = [fingerprint(row.text) for row in rows]
    got = simhash.near_duplicates(hard).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint) for r in got) == sorted(
        (r.doc_id is None, r.doc_id or 0, f"{p:016x}") for r, p in zip(rows, prints)
    )
    want = {}
    for group, row in zip(groups(prints), rows):
        if row.doc_id is not None:
            want[group] = min(want.get(group, row.doc_id), row.doc_id)
    by_print = {f"{p:016x}": want[g] for g, p in zip(groups(prints), prints)}
    assert all(by_print[r.fingerprint] == r.component_id for r in got)
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.one_of_each(hard)
    assert kept.columns == hard.columns
    assert {r.doc_id for r in kept.collect()} == set(want.values()) | {None}


def test_near_copies_against_all_pairs(spark, hard, nothing):
    draw = random.Random(12)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [None, "", "  ", "one two", "One  two", "one two three"]
    for size in (8, 30, 60, 120, 400):
        for _ in range(4):
            base = draw.choices(vocabulary, k=size)
            for changed in (0, 1, 1, 2, 3, 5):
                copy = list(base)
                for _ in range(changed):
                    copy[draw.randrange(size)] = draw.choice(vocabulary)
                texts.append(" ".join(copy))
    notice = " ".join(draw.choices(vocabulary, k=40))
    texts += [notice + " " + " ".join(draw.choices(vocabulary, k=k)) for k in (2, 3, 9, 40) for _ in range(8)]

    def cut(text):
        words = (text or "").lower().split()
        width = min(5, len(words))
        return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()

    sets = [cut(text) for text in texts]
    root, pairs = list(range(len(texts))), 0
    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = sets[i], sets[j]
        if 5 * len(a & b) >= 4 * len(a | b):
            pairs += a != b
            low, high = sorted((root[i], root[j]))
            root = [low if r == high else r for r in root]
    assert pairs > 50
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = near_copies.near_copies(table).collect()
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(root)) and len(found) == len(texts)
    kept = near_copies.one_of_each(hard)
    assert kept.columns == hard.columns and kept.filter("doc_id is null").count() == 2
    assert near_copies.one_of_each(nothing).count() == 0


@pytest.mark.parametrize("with_base", [True, False])
def test_copies_of_one_text_edited_in_many_places(spark, monkeypatch, with_base):
    """Texts of one family that are too far from each other are not held against each other in pairs."""
    draw = random.Random(21)
    base = [f"b{i}" for i in range(200)]

    def edited(words, changes, name):
        copy = list(words)
        for at in draw.sample(range(len(copy)), changes):
            copy[at] = f"{name}x{at}"
        return copy

    copies = [edited(base, draw.randrange(2, 16), f"c{i}") for i in range(160)]
    copies += [edited(copies[i], 2, f"d{i}") for i in range(0, 160, 40)]
    copies += [base[: 200 - k] for k in (30, 60, 90, 95)]
    texts = [" ".join(words) for words in ([base] * with_base + copies)]
    sets = [{tuple(text.split()[i : i + 5]) for i in range(len(text.split()) - 4)} for text in texts]
    root, linked = list(range(len(texts))), 0
    for i, j in itertools.combinations(range(len(texts)), 2):
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            linked += 1
            low, high = sorted((root[i], root[j]))
            root = [low if r == high else r for r in root]
    assert linked > 50 and len(set(root)) > 60
    held, verified = [], near_copies._verified

    def counted(pairs, *more):
        held.append(pairs.count())
        return verified(pairs, *more)

    monkeypatch.setattr(near_copies, "_verified", counted)
    monkeypatch.setattr(near_copies, "SAMPLE", 8)  # as in a large table: the sample holds few texts of a family
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = near_copies.near_copies(table).collect()
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(root)) and len(found) == len(texts)
    assert sum(held) < 10 * len(texts), held


def test_pipeline_drops_copies_with_one_word_replaced(spark):
    import corpus_pipeline

    draw = random.Random(13)
    texts = []
    for _ in range(40):
        words = [f"v{draw.randrange(5000)}" for _ in range(90)]
        texts += [" ".join(words), " ".join(words[:45] + ["changed"] + words[46:])]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = corpus_pipeline.drop_near_copies(spark, table, FOLDER)
    assert {r.doc_id for r in kept.collect()} == set(range(0, 80, 2))


def test_components(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)]
    edges += [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {x: find(x) for edge in edges if edge[0] != edge[1] for x in edge}
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in found} == want and len(found) == len(want)


def test_shards(spark, hard, nothing):
    rows = sharding.assign(hard, 7).collect()
    assert len(rows) == hard.count() and all(r.grown_shard in (r.shard, 7) for r in rows)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert {(r["size"], r.text_crc32) for r in rows} == {
        (len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()))
        for r in hard.select("text").collect()
    }
    assert sharding.assign(nothing, 3).count() == 0
    many = sharding.with_record(spark.range(20_000), "id")
    weights = {0: 1.0, 1: 1.0, 5: 2.0}
    table = many.select(
        sharding.shard_of(F.col(sharding.RECORD), weights).alias("a"),
        sharding.shard_of(F.col(sharding.RECORD), weights | {6: 1.0}).alias("b"),
    )
    counts = {r.a: r["count"] for r in table.groupBy("a").count().collect()}
    assert abs(counts[5] - 10_000) < 300 and abs(counts[0] - 5_000) < 300
    assert table.filter("a != b and b != 6").count() == 0
    assert abs(table.filter("b = 6").count() - 4_000) < 300


@pytest.mark.parametrize("modulus", [exact_dedup.PRIME, 1])
def test_exact_duplicates(hard, nothing, modulus):
    rows = hard.select("doc_id", "text").collect()
    got = exact_dedup.exact_duplicates(hard, modulus=modulus).collect()
    classes = {}
    for row in rows:
        classes.setdefault(blank(row.text), []).append(row.doc_id)
    want = []
    for text, ids in classes.items():
        keep = min(i for i in ids if i is not None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        want += [(i, keep, len(ids), i == keep, sha) for i in ids]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert exact_dedup.exact_duplicates(nothing).count() == 0
    assert exact_dedup.first_of_each(hard).columns == hard.columns


def test_fingerprints_compose():
    data = random.Random(1).randbytes(200_000)
    value = 0
    for byte in data:
        value = (value * exact_dedup.BASE + byte + 1) % exact_dedup.PRIME
    assert exact_dedup.polynomial(data) == value
    a, b, c = ((exact_dedup.polynomial(p), len(p)) for p in (data[:7], data[7:90_000], data[90_000:]))
    left = exact_dedup.combine(exact_dedup.combine(a, b), c)
    assert left == exact_dedup.combine(a, exact_dedup.combine(b, c)) == (value, len(data))


def test_line_dedup(hard, nothing):
    rows = [(r.doc_id, r.text or "") for r in hard.filter("doc_id is not null").collect()]
    rows = [(i, text.split("\n")) for i, text in dict(rows).items()]
    key = {
        line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(line_dedup.BLANK))
        for _, lines in rows
        for line in lines
    }
    first = {}
    for i, lines in rows:
        for line in lines:
            first[key[line]] = min(first.get(key[line], i), i)
    got = {r.key if "key" in r else r.doc_id: r for r in line_dedup.drop_repeated_lines(hard).collect()}
    for i, lines in rows:
        kept = [x for x in lines if len(key[x]) < 10 or first[key[x]] == i]
        assert got[i].kept_text == "\n".join(kept)
        assert (got[i].n_lines, got[i].n_dropped) == (len(lines), len(lines) - len(kept))
    assert line_dedup.drop_repeated_lines(nothing).count() == 0
    assert line_dedup.drop_repeated_lines(hard).count() == hard.count()


def test_pii_base_patterns():
    draw = random.Random(2)
    plain = {
        0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        2: r"[0-9]([\x20-]?[0-9])+",
        3: r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def fits(kind, value):
        digits = re.sub(r"\D", "", value)
        if kind == 1:
            return all(int(part) <= 255 for part in value.split("."))
        if kind == 2:
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
            return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
        return kind == 0 or 9 <= len(digits) <= 15

    for alphabet in ("a@.b_1 ", "0129. -+()", "1234567890 -", "+1 ()a.@2"):
        for _ in range(1500):
            text = "".join(draw.choices(alphabet, k=draw.randint(0, 40)))
            want = [
                (kind, *m.span()) for kind, p in plain.items() for m in re.finditer(p, text) if fits(kind, m[0])
            ]
            assert pii.base_spans(text) == sorted(want, key=lambda s: (s[1], s[0]))


def test_pii_table(spark, nothing):
    texts = [f"Mail me at user{i}@mail{i}.example.com or call +1 (415) 555-01{i:02}" for i in range(40)]
    texts += [f'the token = "ab{i:02}cd34ef56ab78" stays secret' for i in range(40)]
    texts += ["nothing here", None, "", "a" * 100_000 + "@"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in pii.find_spans(table).collect()}
    assert [s.kind for s in rows[3].base] == ["email", "phone"]
    assert all("secret" in [s.kind for s in rows[i].spans] for i in range(40, 80))
    assert all(not rows[i].spans for i in range(80, 84)) and len(rows) == len(texts)
    assert all({*r.base} <= {*r.spans} for r in rows.values())
    assert pii.find_spans(nothing).count() == 0
    assert pii.redact(texts[0], [tuple(s) for s in rows[0].spans]) == "Mail me at [EMAIL] or call [PHONE]"


def test_em_finds_the_reliable_labelers():
    draw = np.random.default_rng(4)
    truth = draw.random(4000) < 0.3
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.55, 0.5])
    cast = np.where((draw.random((4000, 6)) < right) == truth[:, None], pii.YES, pii.NO)
    patterns, place, counts = np.unique(cast, axis=0, return_inverse=True, return_counts=True)
    belief = pii.expectation_maximisation(patterns, counts)[place.ravel()]
    assert ((belief > 0.5) == truth).mean() > 0.95


def test_factorization_machine_learns_pairs():
    draw = random.Random(6)
    words = ["insult", "group", *(f"filler{i}" for i in range(40))]
    texts, toxic = [], []
    for _ in range(3000):
        picked = set(draw.sample(words[2:], 4)) | {w for w in words[:2] if draw.random() < 0.5}
        texts.append(toxicity.Terms().of(" ".join(picked)))
        toxic.append({"insult", "group"} <= picked)
    model = toxicity.fit(texts, np.array(toxic))
    score = lambda text: model.score(toxicity.Terms(model.place).of(text))
    assert score("insult group") > 0.5 > max(score("insult"), score("group"), score("filler1"))


def test_pairs_whose_terms_are_neutral_alone():
    """Each term as often toxic as any other; only both together are."""
    draw = random.Random(21)
    words = [f"word{i}" for i in range(400)]
    texts, toxic = [], []
    for _ in range(6000):
        picked = set(draw.choices(words, k=25))
        chance = draw.random()
        if chance < 0.05:
            picked |= {"left", "right"}
        elif chance < 0.5:
            picked.add("left")
        elif chance < 0.95:
            picked.add("right")
        bad = {"left", "right"} <= picked
        texts.append(toxicity.Terms().of(" ".join(picked)))
        toxic.append(bad or draw.random() < 0.05)
    toxic = np.array(toxic)
    seen = np.bincount(np.concatenate(texts), minlength=toxicity.SPACE).astype(float)
    bad = np.bincount(np.concatenate(texts), weights=np.repeat(toxic, [len(t) for t in texts]), minlength=toxicity.SPACE)
    ratio = toxicity._ratio(bad, seen, toxic.mean())
    terms = {name: toxicity.Terms().of(name) for name in ("left", "right")}
    model = toxicity.fit(texts, toxic)
    score = lambda text: model.score(toxicity.Terms(model.place).of(text))
    assert all((model.place[rows] >= 0).all() for rows in terms.values())
    assert score("left right word3") > 0.9
    assert max(score("left word3"), score("right word7"), score("word1 word2")) < 0.5
    assert max(ratio[rows].max() for rows in terms.values()) < 200


def test_terms_of_a_text_are_bounded_for_fitting_only():
    terms = np.arange(0, 9000, 3, dtype=np.int32)
    some = toxicity._bounded(terms, 100)
    assert len(some) == 100 and set(some) <= set(terms) and (np.diff(some) > 0).all()
    assert some.max() > 5000 and some.min() < 1000
    assert toxicity._bounded(terms, 5000) is terms


def test_toxicity_table(spark, hard, nothing):
    docs = spark.createDataFrame(
        [(i, f"text number {i} " + ("idiot scum" if i % 5 == 0 else "fine words")) for i in range(400)],
        "doc_id bigint, text string",
    )
    labels = docs.selectExpr("doc_id", "cast(doc_id % 5 = 0 as int) toxic")
    rows = toxicity.toxicity(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == int(r.doc_id % 5 == 0) for r in rows)
    assert toxicity.drop_toxic(docs, labels).count() == 320
    # a key that many rows share counts once, so the driver gets one row per chosen key
    crowd = docs.union(docs.filter("doc_id = 1").crossJoin(spark.range(50)).drop("id"))
    again = {r.doc_id: r.score for r in toxicity.toxicity(crowd, labels).collect()}
    assert again == {r.doc_id: r.score for r in rows}
    none = labels.limit(0)
    assert {r.score for r in toxicity.toxicity(hard, none).collect()} == {0.5}
    assert toxicity.toxicity(nothing, none).count() == 0


@pytest.mark.parametrize("pattern", [public_tokenizers.PATTERN, public_tokenizers.PATTERN + "|z"])
def test_tokens_equal_tiktoken(pattern):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    merges, draw = byte_bpe.Merges(ranks), random.Random(8)
    texts = ["", "'", "x's y'll ''s", " 's", "a" * 5000, " " * 900, "the" * 900, "<|endoftext|>"]
    for letters in ("ab", "aA \n", "abcdefghijklmnopqrstuvwxyz", "ab é漢字🎉 '\t\n1½", "' stremdl", " \nthe"):
        texts += ["".join(draw.choices(letters, k=draw.randint(0, 60))) for _ in range(400)]
    got = [x for ids, data in byte_bpe.encode(texts, merges, pattern) for x in zip(ids, data)]
    for text, (ids, data) in zip(texts, got, strict=True):
        assert np.frombuffer(ids.as_py(), "<u4").tolist() == other.encode_ordinary(text)
        assert data.as_py() == text.encode()
    assert regex.findall(public_tokenizers.PATTERN, "x's") == ["x", "'s"]


def test_tokens_table(hard, nothing):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    told = byte_bpe.tokenise(hard, path, public_tokenizers.PATTERN)
    want = sorted(((r.text or "").encode() for r in hard.collect()))
    assert sorted(bytes(r.decoded) for r in told.collect()) == want
    sizes = told.select((F.octet_length("ids") / 4 == F.size(byte_bpe.id_array(F.col("ids")))).alias("ok"))
    assert all(r.ok for r in sizes.collect())
    assert byte_bpe.tokenise(nothing, path, public_tokenizers.PATTERN).count() == 0


def test_urls(spark, nothing):
    draw = random.Random(9)
    hosts = ["com", "a.com", "A.Example.com", "www.example.com", "x.www.example.com", "net", "b.net", "", "acom"]
    paths = ["", "/", "/en/", "/en", "/en/x", "/es/1?u=/fr/", "/fr/#a", "/x/en/", "/" * 400]
    urls = [f"{draw.choice(['http', ''])}://{h}{p}" for h in hosts for p in paths] + ["no", None, "a.com/en/"]
    table = spark.createDataFrame([(u, "x") for u in urls], "url string, rule string")
    for row in url_filter.judge(table, queries.URL_RULES).collect():
        rest = row.url.split("://", 1)[1] if row.url and "://" in row.url else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [
            (len(h + p), h + p, v)
            for v, h, p in queries.URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        assert (row.host, row.path) == (host, path)
        assert (row.rule, row.verdict) == (max(fits)[1:] if fits else (None, "allow"))
    assert url_filter.judge(table.limit(0), queries.URL_RULES).count() == 0


def test_automaton_against_all_windows():
    draw = random.Random(2)
    for _ in range(200):
        letters = [bytes([97 + i]) for i in range(4)]
        items = [(str(i), draw.choices(letters[:3], k=draw.randint(0, 9))) for i in range(draw.randint(0, 6))]
        window = draw.choice([2, 3, 4, 5])
        automaton = decontaminate.Automaton(items, window)
        for _ in range(8):
            words = draw.choices(letters, k=draw.randint(0, 25))
            hit, found = set(), set()
            for item, own in items:
                size = min(window, len(own))
                for a in range(len(own) - size + 1 if own else 0):
                    for b in range(len(words) - size + 1):
                        if words[b : b + size] == own[a : a + size]:
                            hit |= {*range(b, b + size)}
                            found.add(item)
            spans, items_found = automaton.matches(words)
            assert {i for a, b in spans for i in range(a, b)} == hit and items_found == found


def test_decontamination_in_blocks(spark, hard, nothing):
    items = spark.createDataFrame(
        [(i, " ".join(f"i{i}w{j}" for j in range(30))) for i in range(20)] + [(None, None), (99, "")],
        "item_id bigint, text string",
    )
    docs = spark.createDataFrame(
        [(i, f"Before {' '.join(f'I{i}w{j},' for j in range(5, 5 + i))} after. i3w1 i3w2") for i in range(20)],
        "doc_id bigint, text string",
    )
    one = {r.doc_id: r for r in decontaminate.contamination(docs, items).collect()}
    assert all((r.n_hit, r.n_items) == ((i, 1) if i >= 10 else (0, 0)) for i, r in one.items())
    blocks = decontaminate.contamination(docs, items, block_words=40)
    assert {r.doc_id: r for r in blocks.collect()} == one
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items, longest=15).collect()}
    assert set(cut) == set(range(16)) and cut[12] == "Before , after. i3w1 i3w2"
    assert decontaminate.decontaminate(docs, items).count() == 10
    assert decontaminate.contamination(hard, items.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contamination(nothing, items).count() == 0


def test_html(spark):
    body = "<div id=nav5><a href=x>Home</a></div><div class='wrap no-sidebar'><div class=post>{}</div></div>"
    main = "<h1>T &amp; x</h1><p>Some  long <b>article\n text&nbsp;here <p>Second<ul><li>one<li>two</ul>"
    junk = "<nav>n</nav><div class='ad'>buy this thing now</div><form>f</form><aside>s</aside><script>'</p>'</script><!-- c -->"
    pages = [(i, f"http://a.com/{i}", body.format(main + junk)) for i in range(5)]
    pages += [(5, "http://a.com/5", "<p>no such container"), (6, None, None), (7, "x", "")]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    rows = {r.page_id: r for r in html_extract.main_text(table).collect()}
    want = "T & x\nSome long article text here\nSecond\none\ntwo"
    assert all(rows[i].text == want and rows[i].n_chars == len(want) for i in range(5))
    assert [rows[i].text for i in (5, 6, 7)] == ["no such container", "", ""]
    assert html_extract.main_text(table.limit(0)).count() == 0
    for source in ("<", "<p", "<!--", "<script>", "<div>" * 5000, '<a "' * 3000, "</p>" * 3000, "a<b"):
        html_extract.extract(source, "/div")


def test_html_text_beside_the_body():
    long = "".join(f"<p>paragraph {i} of a long article body</p>" for i in range(60))
    body = "<article><h1>Title</h1><p>lead text</p><div class=body>{}</div><section>end note</section></article>"
    page = f"<div class=side>beside</div>{body.format(long)}<footer>f</footer>"
    path = html_extract.best_path(page)
    for lines in (html_extract.extract(page, p).split("\n") for p in (path, None, "/main")):
        assert lines[:2] == ["Title", "lead text"] and lines[-1] == "end note" and len(lines) == 63
    plain = f"<div class=wrap><h1><a href=x>Title</a></h1><div class=body>{long}</div><div><a href=y>more links</a></div></div>"
    lines = html_extract.extract(plain, html_extract.best_path(plain)).split("\n")
    assert lines[0] == "Title" and len(lines) == 61
    # the path that the host voted for holds a part of this page's text only
    mixed = f"<div class=post>{long[:900]}</div><div class=rest>{long}</div>"
    rest = html_extract.extract(mixed, "/div.post").split("\n")
    assert sum("paragraph 59" in line for line in rest) == 1
    other = f"<main><div class=post>{long[:900]}</div><div class=rest>{long}</div></main>"
    assert "paragraph 59" in html_extract.extract(other, "/main/div.post")


def test_html_names_that_articles_use():
    text = "".join(f"<p>sentence {i} of the paper</p>" for i in range(20))
    parts = "<h2 id=search>Search</h2><h2 id=related-work>Related work</h2><h2 id=comment-syntax>Syntax</h2>"
    paper = f"<h1>Paper</h1>{parts}{text}<section id=discussion><p>we discuss this</p></section>"
    want = ["Search", "Related work", "Syntax", "we discuss this"]
    for page in (f"<article>{paper}</article>", f"<main id=search><article>{paper}</article></main>"):
        page += "<div id=comments><p>a remark of a reader</p></div>"
        lines = html_extract.extract(page, html_extract.best_path(page)).split("\n")
        assert set(want) <= set(lines) and "a remark of a reader" not in lines and lines[0] == "Paper"
    inside = f"<article>{paper}<div id=related><a href=x>other text</a></div><div id=comments><form>say</form>x</div></article>"
    lines = html_extract.extract(inside, None).split("\n")
    assert set(want) <= set(lines) and not {"other text", "x", "say"} & set(lines)
    assert "sentence 19" in html_extract.extract(f"<div class=discussion>{text}</div><p>short", None)
    kept = html_extract.extract("<article><p class=byline>By A</p><p>so <math><mi>x</mi></math> holds", None)
    assert kept == "By A\nso x holds"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for _, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, docs, FOLDER)
        assert kept.columns == docs.columns
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    last = {r.doc_id: r.text for r in docs.collect()}
    assert len({blank(text) for text in last.values()}) == len(last)
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {
        i: hashlib.sha256(texts[i].encode()).hexdigest() for i in last
    }


@pytest.mark.parametrize("tag", "canvas object svg select audio video noscript template script style textarea title".split())
def test_html_unclosed_elements_end_with_their_parent(tag):
    text = "<p>A paragraph of the article, long enough to count.</p>"
    page = f"<body><article><h1>Head</h1>{text}<div><{tag}></div>{text * 9}</article><footer>end</footer></body>"
    lines = html_extract.extract(page, html_extract.best_path(page)).split("\n")
    assert lines == ["Head"] + ["A paragraph of the article, long enough to count."] * 10


def test_html_form_around_the_page():
    text = "<p>A paragraph of the article, long enough to count.</p>" * 12
    fields = "<input type=hidden name=state value=1><label>Find</label><input name=q><button>Go</button>"
    for body in (text, f"<article>{text}</article>"):
        page = f"<form id=aspnetForm method=post>{fields}<div class=menu><a href=a>Home</a></div>{body}</form>"
        lines = html_extract.extract(page, html_extract.best_path(page)).split("\n")
        assert lines == ["A paragraph of the article, long enough to count."] * 12
    page = f"<div class=post>{text}</div><form><label>Mail</label>Write to us <input><input><select><option>a</select></form>"
    assert "Write" not in html_extract.extract(page, html_extract.best_path(page))


def test_html_hidden_elements_inside_a_line():
    page = "<article><p>One <svg><text>x</text></svg>line <button>Go</button>goes on.</p><p>Two</p></article>"
    assert html_extract.extract(page, html_extract.best_path(page)) == "One line goes on.\nTwo"


def test_html_class_names_inside_articles():
    text = "<p>A paragraph of the article, long enough to count.</p>"
    page = (
        f"<article><header><h1>Title</h1></header><div class=entry-header><h2>Part</h2></div><p class=ad-hoc>ad hoc</p>"
        f"<h2 class=search>Search trees</h2><section class=related-work>{text}</section>"
        f"<section class=discussion>{text}</section>{text * 8}<div class=ad>Buy it</div>"
        "<div class=menu><a href=a>one</a> <a href=b>two</a></div><div class=comments><p>Nice post</p></div></article>"
    )
    lines = html_extract.extract(page, html_extract.best_path(page)).split("\n")
    head = ["Title", "Part", "ad hoc", "Search trees"]
    assert lines == head + ["A paragraph of the article, long enough to count."] * 10


def test_html_pages_are_not_shuffled(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    plan = html_extract.main_text(pages)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_html_hard_rows(spark):
    page = "<article><h1>T</h1><p>" + "long words " * 30_000 + "</p></article>"
    rows = [(1, "http://a.b/c", page), (1, "http://a.b/c", page), (2, None, None), (None, "x", ""), (3, "http://a.b/d", "<svg>")]
    docs = spark.createDataFrame([(*r, "t", "h", 1) for r in rows], "page_id bigint, url string, html string, text string, host string, n_chars int")
    got = html_extract.main_text(docs).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 2 + 11 * 30_000 - 1), (1, 2 + 11 * 30_000 - 1), (2, 0), (3, 0)]


def test_exact_duplicates_without_keys(spark):
    rows = [(None, f"text {i % 700}") for i in range(3000)] + [(1, "text 5"), (2, "text 5"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for modulus in (exact_dedup.PRIME, 3):
        got = exact_dedup.exact_duplicates(docs, modulus=modulus).collect()
        assert len(got) == len(rows)
        by_text = {}
        for row in got:
            by_text.setdefault(row.text_sha256, set()).add((row.keep_id, row.group_size))
        assert len(by_text) == 701
        five = hashlib.sha256(b"text 5").hexdigest()
        assert by_text.pop(five) == {(1, 7)}
        assert by_text.pop(hashlib.sha256(b"").hexdigest()) == {(None, 2)}
        assert {len(one) for one in by_text.values()} == {1} and {k for one in by_text.values() for k, _ in one} == {None}


def test_sharding_by_text_keys(spark):
    rows = [(f"a-{i}", "x" * (i % 9)) for i in range(4000)] + [("a-1", "x"), (None, "n")]
    docs = spark.createDataFrame(rows, "name string, text string")
    told = sharding.assign(docs, 40, key="name").collect()
    assert len(told) == len(rows)
    assert all(r.grown_shard in (r.shard, 40) for r in told)
    held = {}
    for row in told:
        held.setdefault(row.shard, []).append(row.slot)
    assert len(held) == 40 and all(sorted(slots) == list(range(len(slots))) for slots in held.values())
    assert len({r.shard for r in told if r.name == "a-1"}) == 1


def test_pii_spans_in_great_number():
    found = [
        {"kind": 3, "start": at * 7, "stop": at * 7 + 9, "code": 0, "size": 1} for at in range(100_000)
    ]
    weights = np.zeros(pii._features(np.array([3]), np.array([0]), np.array([1])).shape[1])
    begun = time.perf_counter()
    spans = pii.decide(found, weights, 0.5)
    assert time.perf_counter() - begun < 4
    assert spans == [(3, at * 7, at * 7 + 9) for at in range(0, 100_000, 2)]


@pytest.mark.parametrize("text", ["JANE [AT] EXAMPLE [DOT] COM", "jane at example.com", "Jane (At) Example (Dot) Com"])
def test_pii_spelled_addresses_in_any_case(text):
    assert any(kind == 0 for kind, *_ in pii.candidates(text, []))


def test_toxicity_hands_the_driver_only_fitted_terms(spark, monkeypatch):
    """The same model as from whole texts, of which only the terms it is fitted on leave the tasks."""
    draw = random.Random(5)
    texts, labels = [], []
    for i in range(600):
        words = [f"w{draw.randrange(3000)}" + "abcdefghij"[draw.randrange(10)] * 3 for _ in range(40)]
        bad = i % 5 == 0
        words += (["vile"] if i % 10 == 0 else ["left", "right"]) if bad else [["left", "right", "vile"][i % 2]]
        texts.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    handed, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda terms, toxic, **more: handed.append(terms) or fit(terms, toxic, **more))
    model = toxicity.train(docs, marks)
    learned = {r.doc_id for r in marks.filter(~toxicity.held_out(F.col("doc_id"))).collect()}
    whole = [toxicity.Terms().of(text) for i, text in texts if i in learned]
    plain = fit(whole, np.array([label for i, label in labels if i in learned], float))
    assert len(plain.weights) > 0
    for name in ("place", "weights", "factors", "bias"):
        assert np.array_equal(getattr(model, name), getattr(plain, name))
    assert sum(map(len, handed[0])) < sum(map(len, whole)) / 4
