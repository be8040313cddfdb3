"""Lines of JSON whose fields come, go and change their type."""

import json

import pytest
from pyspark.sql import functions as F

from scrubwell.plans.cleaner import Cleaner
from scrubwell.plans.config import NO_TABLES, CleanConfig
from scrubwell.sources import corpus, lines

LINES = [
    '{"doc_id": 1, "text": "call 10.0.0.1", "score": 3, "tags": ["x", "y"], "a.b c": {"q": 1.50}}',
    '{"doc_id": "2", "text": "two", "score": "7.5", "lang": "de", "it\'s": true}',
    '{"doc_id": "two", "text": {"body": "deep"}, "score": null}',
    "no json {",
    "[1, 2]",
    "17",
    '{"doc_id": 4, "text": "twice", "doc_id": 5}',
    "{}",
    "   ",
    '{"text": null, "rest": {"value": [1, "b"]}, "name": 5, "source_file": "own"}',
]


@pytest.fixture(scope="module")
def read(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("lines") / "a.jsonl"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return lines.read_lines(spark, str(path))


def by_text(rows):
    return sorted(rows, key=repr)


def test_known_fields_are_typed_and_the_rest_stays(read):
    got = read.select("doc_id", "text", "lang", "source", F.expr("to_json(rest)").alias("rest"), "_corrupt_record", "source_file").collect()
    assert {row.source_file for row in got} == {"a.jsonl"}
    told = [(r.doc_id, r.text, r.lang, json.loads(r.rest) if r.rest else None, r._corrupt_record) for r in got]
    assert by_text(told) == by_text([
        (1, "call 10.0.0.1", None, {"score": 3, "tags": ["x", "y"], "a.b c": {"q": 1.5}}, None),
        (2, "two", "de", {"score": "7.5", "it's": True}, None),
        # a value that the schema cannot hold is not lost; a string holds anything
        (None, '{"body":"deep"}', None, {"doc_id": "two", "score": None}, None),
        (None, None, None, None, "no json {"),
        (None, None, None, None, "[1, 2]"),
        (None, None, None, None, "17"),
        (None, None, None, None, '{"doc_id": 4, "text": "twice", "doc_id": 5}'),
        (None, None, None, {}, None),
        (None, None, None, {"rest": {"value": [1, "b"]}, "name": 5, "source_file": "own"}, None),
    ])


def test_fields_by_name_path_and_type(read):
    typed = lines.with_fields(read.filter("doc_id in (1, 2)"), {"score": "double", "tags": "array<string>", "it's": "boolean"})
    typed = typed.withColumns({"q": lines.field("$['a.b c'].q", "decimal(4,2)"), "whole": lines.field("a.b c", "variant")})
    one, two = typed.orderBy("doc_id").collect()
    assert (one.score, one.tags, str(one.q), one["it's"]) == (3.0, ["x", "y"], "1.50", None)
    assert one.whole.toPython()["q"] is not None
    assert (two.score, two.tags, two.q, two["it's"]) == (7.5, None, None, True)
    with pytest.raises(ValueError):
        lines.field("'\"", "string")


def test_reports_of_fields(read):
    told = {(r.field, r.type): r.lines for r in lines.field_report(read).collect()}
    assert told[("score", "BIGINT")] == told[("score", "STRING")] == told[("score", "VOID")] == 1
    assert told[("tags", "ARRAY<STRING>")] == 1
    per_file = lines.field_report(read, ["source_file"])
    assert per_file.columns == ["source_file", "field", "type", "lines"]
    assert per_file.count() == len(told)
    assert "score: VARIANT" in lines.merged_schema(read).first().schema


def test_cleaned_lines_keep_their_fields(spark, read, tmp_path):
    cleaner = Cleaner(CleanConfig(replace_ip=True, **NO_TABLES))
    cleaned = cleaner.transform(read).drop("findings")
    folder = str(tmp_path / "out")
    lines.write_lines(cleaned, folder, ["doc_id", "text"])
    written = {row.value for row in spark.read.text(folder).collect()}
    assert {"no json {", "[1, 2]", "17"} <= written
    objects = [json.loads(line) for line in written if line.startswith('{"') and "twice" not in line]
    one = next(o for o in objects if o["doc_id"] == 1)
    assert one == {"doc_id": 1, "text": "call [IPV4_REDACTED]", "score": 3, "tags": ["x", "y"], "a.b c": {"q": 1.5}}
    assert {"doc_id": None, "text": None, "rest": {"value": [1, "b"]}, "name": 5, "source_file": "own"} in objects
    again = lines.read_lines(spark, folder)
    assert again.filter("doc_id = 1").select(F.expr("to_json(rest)")).first()[0] == '{"a.b c":{"q":1.5},"score":3,"tags":["x","y"]}'


def test_rest_goes_through_parquet(spark, read, tmp_path):
    read.write.parquet(str(tmp_path / "variant"))
    stored = spark.read.parquet(str(tmp_path / "variant"))
    assert stored.schema["rest"].dataType.simpleString() == "variant"
    assert stored.filter("doc_id = 2").select(lines.field("score", "double")).first()[0] == 7.5


def test_lines_on_a_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n".join(LINES), encoding="utf-8")
    stream = lines.parse_lines(spark.readStream.text(str(folder)))
    told = stream.select("doc_id", lines.field("score", "double").alias("score"), "_corrupt_record")
    query = told.writeStream.format("memory").queryName("lines").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.table("lines").collect()
    assert len(rows) == len(LINES) - 1
    assert (1, 3.0) in {(r.doc_id, r.score) for r in rows}


def test_folder_without_matching_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("{}")
    with pytest.raises(FileNotFoundError):
        corpus.read_directory(spark, str(tmp_path))
    (tmp_path / "b.jsonl").write_text('{"doc_id": 3}\n')
    assert corpus.read_directory(spark, str(tmp_path)).first().doc_id == 3
