"""All contract columns of registered queries, worked out anew in plain Python."""

import hashlib
import os
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from scrubwell.llm import byte_bpe, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text):
    spans = []
    for found in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append((found.start(), 0, found.end(), "email"))
    for found in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in found[0].split(".")):
            spans.append((found.start(), 1, found.end(), "ip"))
    for found in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", found[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((found.start(), 2, found.end(), "card"))
    for found in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", found[0])) <= 15:
            spans.append((found.start(), 3, found.end(), "phone"))
    return sorted(spans)


def test_op5_columns(spark, documents):
    rows = queries.op5_pii(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    hits = 0
    for row in rows:
        spans = base_spans(documents[row.doc_id])
        hits += len(spans)
        told = [f"{kind}:{start}:{end}" for start, _, end, kind in spans]
        counts = [sum(s[3] == kind for s in spans) for kind in ("email", "ip", "card", "phone")]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
        assert row.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        every = row.spans.split(",") if row.spans else []
        assert set(told) <= set(every) and len(set(every)) == len(every)
        places = [tuple(map(int, span.split(":")[1:])) for span in every]
        assert [start for start, _ in places] == sorted(start for start, _ in places)
        assert all(0 <= start < end <= len(documents[row.doc_id]) for start, end in places)
    assert hits


def test_op6_columns(spark, documents):
    rows = queries.op6_toxicity(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    again = {r.doc_id: r.score for r in queries.op6_toxicity(spark, FOLDER).collect()}
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
        assert row.score == again[row.doc_id]
    same = {}
    for row in rows:
        same.setdefault(documents[row.doc_id], set()).add(row.score)
    assert all(len(scores) == 1 for scores in same.values())


def test_op7_columns(spark, documents):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = queries.op7_byte_bpe(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for row in rows:
        ids = library.encode_ordinary(documents[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(documents[row.doc_id].encode()).hexdigest()


def test_op10_columns(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = queries.op10_html_extract(spark, FOLDER).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for row in rows:
        page = pages[row.page_id]
        assert row.url == page.url and row.n_chars == len(row.text)
        lines = row.text.split("\n")
        assert lines == [" ".join(line.split()) for line in lines]
        # every word of the text stands on the page, in this order
        plain, at = re.sub(r"<[^>]*>", " ", page.html or ""), 0
        for word in re.findall(r"\w{6,}", row.text):
            at = plain.find(word, at)
            assert at >= 0
