"""Binary records: frames, ids against the tokenizer library, order, starts, damage, hard rows."""

import glob
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scrubwell.llm import binary_records as br
from scrubwell.llm import queries

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def description():
    with open(PATH, encoding="utf-8") as lines:
        return lines.read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def wild(draw):
    alphabet = "ab cdé' \n\t'sÜ12３—  　😀中\r\x1c.,|'ll 're"
    return "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 80)))


def test_ids_against_the_library(description, library):
    draw = random.Random(4)
    texts = [wild(draw) for _ in range(2000)]
    texts += ["", " ", "a<|endoftext|>b", "<|endoftext|>", "x" * 5000, "it's  we'll 'll\n\n  end "]
    encoder = br.Encoder(description)
    assert encoder.by_words
    got = [ids.tolist() for ids in encoder.encode(texts)]
    assert got == [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert encoder.encode([]) == []


def test_other_tokenizers_are_not_cut_to_words():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as lines:
        description = lines.read()
    encoder, texts = br.Encoder(description), ["Hello World", "", "déjà vu 12"]
    assert not encoder.by_words
    plain = Tokenizer.from_str(description)
    want = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert [ids.tolist() for ids in encoder.encode(texts)] == want


def test_frames_notice_damage():
    for dtype in ("<u2", "<u4"):
        content = br.serialise("17", np.array([5, 7, 65535], dtype))
        key, ids = br.deserialise(content)
        assert (key, ids.tolist()) == ("17", [5, 7, 65535])
        data = br.frame(content)
        assert br.unframe(data) == content
        for at in range(len(data)):
            broken = bytearray(data)
            broken[at] ^= 4
            with pytest.raises(br.CorruptRecord):
                br.unframe(bytes(broken))
        for cut in range(len(data)):
            with pytest.raises(br.CorruptRecord):
                br.unframe(data[:cut])
    assert br.deserialise(br.serialise(None, np.array([1], "<u2")))[0] is None
    assert br.deserialise(br.serialise("", np.array([], "<u2")))[0] == ""


def laid_out(rows, library):
    """Key, start, ids in the order of the files, as far as the rows determine it."""
    start, told = 0, []
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        told.append((key, start, ids))
        start += len(ids)
    return told


def test_hard_rows(spark, description, library, tmp_path):
    long = " ".join(f"word{i % 977} and\nline" for i in range(30_000))
    rows = [(8, None), (9, ""), (3, "one two"), (1, long), (7, " \n "), (-4, "Ünïcode 中")]
    clash = [(key, text, "p", 1, "f") for key, text in rows]
    docs = spark.createDataFrame(clash, "doc_id bigint, text string, part string, start int, file string")
    folder = str(tmp_path / "plain")
    index = br.write_records(docs, folder, description, 2)
    want = laid_out(sorted(rows), library)
    got = br.read_records(spark, folder).collect()
    assert [(r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got] == want
    assert [r.n_tokens for r in got] == [len(ids) for _, _, ids in want]
    told = index.orderBy("part", "record").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in told] == [(k, s, len(i)) for k, s, i in want]

    # every frame stands where the index says, and nothing lies between frames
    sizes = {}
    for row in told:
        with open(f"{folder}/data/{row.file}", "rb") as lines:
            lines.seek(row.offset)
            br.unframe(lines.read(row.length))
        sizes[row.file] = sizes.get(row.file, 0) + row.length
    assert {f: os.path.getsize(f"{folder}/data/{f}") for f in sizes} == sizes

    # shuffled: the same rows in another order, the same one each time
    first, again, other = (
        [(r.doc_id, r.start, bytes(r.ids)) for r in br.read_records(spark, folder, seed=s).collect()]
        for s in (1, 1, 2)
    )
    assert first == again and sorted(first) == sorted(other) == sorted((r.doc_id, r.start, bytes(r.ids)) for r in got)

    # a changed byte is an error, not a wrong id
    path = glob.glob(f"{folder}/data/*.rec")[0]
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 1
    with open(path, "wb") as lines:
        lines.write(data)
    with pytest.raises(Exception, match="damaged"):
        br.read_records(spark, folder).collect()


def test_repeated_and_missing_keys(spark, description, library, tmp_path):
    rows = [(5, "again")] * 400 + [(None, "no key")] * 300 + [(5, "other"), (None, None), (2, "last")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    folder = str(tmp_path / "repeated")
    br.write_records(docs, folder, description, 2)
    got = br.read_records(spark, folder).collect()
    assert [r.doc_id for r in got] == [None] * 301 + [2] + [5] * 401
    position = 0
    for row in got:
        assert row.start == position
        position += row.n_tokens
    decoded = sorted(library.decode(np.frombuffer(r.ids, "<u4")[:-1].tolist()) for r in got)
    assert decoded == sorted(text or "" for _, text in rows)
    assert all(np.frombuffer(r.ids, "<u4")[-1] == 2 for r in got)


def test_empty_table_and_text_keys(spark, description, tmp_path):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    folder = str(tmp_path / "none")
    assert br.write_records(none, folder, description, 2).count() == 0
    assert br.read_records(spark, folder).count() == 0
    named = spark.createDataFrame([("b", "x"), ("a", "y"), ("a|\n", "z")], "name string, body string")
    folder = str(tmp_path / "named")
    br.write_records(named, folder, description, 2, "name", "body")
    assert [r.name for r in br.read_records(spark, folder, "name").collect()] == ["a", "a|\n", "b"]


def test_wide_ids(spark, description, tmp_path):
    docs = spark.createDataFrame([(1, "one two")], "doc_id bigint, text string")
    folder = str(tmp_path / "wide")
    br.write_records(docs, folder, description, 70_000)
    row = br.read_records(spark, folder).first()
    assert np.frombuffer(row.ids, "<u4").tolist()[-1] == 70_000


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = [
        (key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for key, start, ids in laid_out(sorted((d.doc_id, d.text) for d in docs), library)
    ]
    got = queries.op12_binary_records(spark, FOLDER).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want
