"""Operators that join, group or read and write tables."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from scrubwell.functions import distance
from scrubwell.operators import dedupe, entities, findings, language, spelling, tallies
from scrubwell.plans.cleaner import Cleaner
from scrubwell.plans.config import NO_TABLES, CleanConfig
from scrubwell.session import scratch_path, scratch_root
from scrubwell.sources import corpus


def alignment_distance(a, b):
    """Textbook optimal string alignment."""
    table = {}
    for i in range(-1, len(a)):
        for j in range(-1, len(b)):
            if i < 0 or j < 0:
                table[i, j] = max(i, j) + 1
                continue
            table[i, j] = min(
                table[i - 1, j] + 1, table[i, j - 1] + 1, table[i - 1, j - 1] + (a[i] != b[j])
            )
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                table[i, j] = min(table[i, j], table[i - 2, j - 2] + 1)
    return table[len(a) - 1, len(b) - 1]


@pytest.mark.parametrize("limit", [1, 2])
def test_distance_and_keys_equal_brute_force(spark, limit):
    rng = random.Random(limit)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(150)]
    pairs = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    a, b = F.col("a"), F.col("b")
    rows = pairs.select(
        "a",
        "b",
        distance.swap_distance(
            a, b, distance.letters_sorted(a), distance.letters_sorted(b), limit
        ).alias("d"),
        F.arrays_overlap(
            spelling.deletion_keys(a, limit), spelling.deletion_keys(b, limit)
        ).alias("meet"),
    ).collect()
    for row in rows:
        true = alignment_distance(row.a, row.b)
        assert row.d == (true if true <= limit else None), row
        assert row.meet or true > limit, row


def test_words_alike_only_in_front_share_no_key(spark):
    """Words that begin alike are many: if they met, the pairs would grow with their square."""
    tails = [a + b for a in "bcdfgh" for b in "klmnp"]
    words = spark.createDataFrame([(f"ansehen{t}er",) for t in tails], "word string")
    terms = spark.createDataFrame([(f"ansehen{t[::-1]}ung",) for t in tails], "term string")
    left = words.select("word", F.explode(spelling.deletion_keys(F.col("word"))).alias("key"))
    right = terms.select("term", F.explode(spelling.deletion_keys(F.col("term"))).alias("key"))
    assert left.join(right, "key").count() == 0


@pytest.mark.parametrize("limit", [1, 2])
def test_arrow_distance_equals_built_in(spark, limit):
    rng = random.Random(limit + 10)
    words = ["".join(rng.choice("aß𝄞") for _ in range(rng.randint(0, 7))) for _ in range(90)] + [None]
    a, b = F.col("a"), F.col("b")
    pairs = spark.createDataFrame([(x, y) for x in words for y in words], "a string, b string")
    plain = distance.swap_distance(a, b, distance.letters_sorted(a), distance.letters_sorted(b), limit)
    assert pairs.filter(~plain.eqNullSafe(distance.alignment_distance(a, b, limit))).count() == 0


def test_plain_words_settled_first_leave_the_cut_as_it_is(texts):
    from scrubwell import rules

    slow = rules.GUARDED_PIECES.replace(rules.PLAIN_PIECE + "|", "")
    assert slow != rules.GUARDED_PIECES
    rng = random.Random(5)
    parts = ["www", "WWW.", "a@b.co", "http", "://", "é", "ab", "x_y", "be:", ":", "1", " ", " ", "\n", "\u00a0", "\x1c", ".", ",", "!?", "/", "×"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    cut = [F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in (slow, rules.GUARDED_PIECES)]
    assert texts(*made).filter(cut[0] != cut[1]).count() == 0


def test_suggestions_equal_brute_force(spark):
    rng = random.Random(7)
    def word():
        return "".join(rng.choice("abcd") for _ in range(rng.randint(2, 8)))

    terms = {word(): rng.randint(1, 5) for _ in range(60)}
    unknown = sorted({word() for _ in range(200)} - set(terms))
    got = spelling.suggest_spelling(
        spark.createDataFrame([(w,) for w in unknown], "word string"),
        spark.createDataFrame(list(terms.items()), "term string, freq bigint"),
    ).collect()
    expected = {}
    for w in unknown:
        ranked = sorted((alignment_distance(w, t), -n, t) for t, n in terms.items())
        if ranked[0][0] <= 2:
            expected[w] = (ranked[0][2], ranked[0][0])
    assert {row.word: (row.term, row.distance) for row in got} == expected


def test_spelling_leaves_names_numbers_and_addresses(spark, texts):
    vocabulary = spark.createDataFrame([("hello", 9), ("world", 5)], "term string, freq bigint")
    docs = texts(
        "helo wrold.  Helo hello9 helo@wrold.com http://helo.wrold",
        "`helo`",
        "hello",
        None,
    )
    fixed = spelling.correct_spelling(docs, spelling.spelling_map(docs, vocabulary))
    assert [row.text for row in fixed.orderBy("doc_id").collect()] == [
        "hello world. Helo hello9 helo@wrold.com http://helo.wrold",
        "`helo`",
        "hello",
        None,
    ]


def test_names_longest_first_from_the_left(spark, texts):
    gazetteer = spark.createDataFrame(
        [("New York", "GPE"), ("New York Times", "ORG"), ("Times Square", "LOC"),
         ("Ann", "PERSON"), ("widget", "PRODUCT")],
        "term string, label string",
    )
    docs = texts("Ann, New York Times Square widget Anna.", "none", "", None)
    names = entities.prepare_gazetteer(gazetteer)
    out = entities.redact_entities(docs, names).orderBy("doc_id").collect()
    assert [row.text for row in out] == [
        "[NAME_REDACTED], [NAME_REDACTED] Square widget Anna.",
        "none",
        "",
        None,
    ]


def test_language(spark, texts):
    train = spark.createDataFrame(
        [("the cat and the hat", "en"), ("der Hund und die Katze", "de"), ("xx", "zz")],
        "text string, lang string",
    )
    model = language.train_language_model(train)
    docs = texts("the hat", "und der Hund", "a", None)
    found = language.route_foreign(docs, model).orderBy("doc_id").collect()
    assert [row.lang_detected for row in found] == ["en", "de", None, None]
    assert [row.needs_translation for row in found] == [False, True, False, False]
    blanked = language.blank_foreign(docs, model).orderBy("doc_id").collect()
    assert [row.text for row in blanked] == ["the hat", "", "a", None]


def test_dedupe_keeps_first_rows_whole_with_a_hot_text(spark):
    """A third of the rows share one text; every distinct text keeps its first row."""
    rows = spark.range(30_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 1, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 5000)).alias("text"),
        F.concat(F.lit("s"), F.col("id") % 7).alias("source"),
    )
    rows = rows.unionByName(rows.limit(1).withColumn("text", F.lit(None).cast("string")))
    kept = dedupe.dedupe_texts(rows)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1
    first = {}
    for row in sorted(rows.collect(), key=lambda row: row.doc_id):
        if row.text is not None:
            first.setdefault(row.text, row)
    assert sorted(kept.collect()) == sorted(first.values())


def test_tallies(texts):
    docs = texts("a b a a", "", None)
    tally = {(r.doc_id, r.token): r.positions for r in tallies.token_tally(docs, ["doc_id"]).collect()}
    assert tally == {(0, "a"): [0, 2, 3], (0, "b"): [1], (1, ""): [0]}
    gaps = tallies.repeat_gaps(docs, ["doc_id"]).orderBy("pos").collect()
    assert [(r.token, r.pos, r.gap) for r in gaps] == [("a", 2, 2), ("a", 3, 1)]
    plan = tallies.token_tally(docs, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


PLAIN = CleanConfig(**NO_TABLES)
MESSY = "<b>Call</b>  +1 (663) 555-6869 or a@b.co  call call: damn 9:30"


def test_cleaner_default(texts):
    cleaned, found = Cleaner(PLAIN).clean(texts(MESSY, "", "plain", None))
    rows = cleaned.orderBy("doc_id").collect()
    assert [row.text for row in rows] == [
        "[HTML_REDACTED]Call[HTML_REDACTED] <PHONE> or [EMAIL_REDACTED] call call: "
        "[PROFANITY_REDACTED] [TIMESTAMP_REDACTED]",
        None,
        "plain",
        None,
    ]
    tags = sorted((r.doc_id, r.tag) for r in found.collect())
    assert tags == sorted(
        [(0, t) for t in ("HTML", "HTML", "MULTISPACE", "PROFANITY", "TIMESTAMP", "EMAIL", "PHONE")]
        + [(1, "TOO SHORT")]
    )
    phone = found.filter("tag = 'PHONE'").first()
    assert (phone.original, phone.replacement, phone.pos) == ("+1 (663) 555-6869", "<PHONE>", 0)


def test_order_of_steps_follows_the_config():
    config = replace(PLAIN, replace_ip=True, max_tokens=5)
    names = [name for name, _ in Cleaner(config).steps()]
    assert names == config.active()
    assert "spell_check" not in names and "replace_entities" not in names


def test_step_without_its_table_is_an_error(texts):
    with pytest.raises(ValueError, match="translate_lang, spell_check, replace_entities"):
        Cleaner().transform(texts("a"))


def test_texts_alone_compute_no_findings(texts):
    alone = Cleaner(PLAIN).transform(texts(MESSY)).select("doc_id", "text")
    plan = alone._jdf.queryExecution().optimizedPlan().toString()
    assert "findings" not in plan and "MULTISPACE" not in plan


def test_cleaner_with_all_tables(spark, texts):
    train = spark.createDataFrame(
        [("the cat and the hat met in a house", "en"), ("der Hund und die Katze im Haus", "de")],
        "text string, lang string",
    )
    cleaner = Cleaner(
        CleanConfig(remove_lang=True),
        vocabulary=spark.createDataFrame([("house", 5)], "term string, freq bigint"),
        language_model=language.train_language_model(train),
        gazetteer=spark.createDataFrame([("Ann", "PERSON")], "term string, label string"),
        hmac_key="k",
        extra_steps=(lambda df: df.withColumn("size", F.length("text")),),
    )
    cleaned, found = cleaner.clean(texts("Ann and the cat in the hosue", "und die Katze im Haus"))
    rows = cleaned.orderBy("doc_id").collect()
    assert rows[0].text.startswith("[NAME_HASH_") and rows[0].text.endswith("the cat in the house")
    assert rows[1].text is None and rows[1].needs_translation and rows[0].size > 0
    assert {r.tag for r in found.collect()} == {"SPELLING", "NAME", "LANGUAGE_REMOVE", "TOO SHORT"}
    spelled = found.filter("tag = 'SPELLING'").first()
    assert spelled.original == "Ann and the cat in the hosue"


def test_digests_instead_of_texts(texts):
    _, found = Cleaner(PLAIN, audit_texts=False).clean(texts("go go"))
    assert len(found.filter("tag = 'RM_REPEATS'").first().original) == 64


def test_narrow_pipeline_has_one_python_step_and_no_shuffle(texts):
    plan = Cleaner(PLAIN).transform(texts(MESSY))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "BatchEvalPython" not in plan
    assert plan.count("ArrowEvalPython") == 1


def test_filters_on_cleaned_text_stay_cheap(texts):
    cleaned = Cleaner(PLAIN).transform(texts(MESSY, "")).filter("text is not null and text like '%Call%'")
    assert cleaned.count() == 1
    assert len(cleaned._jdf.queryExecution().optimizedPlan().toString()) < 200_000


def test_findings_count_equals_hits_and_reports_add_up(texts):
    docs = texts("10.0.0.1 and 10.0.0.2", "10.0.0.1", "none").withColumn("source", F.lit("s"))
    table = Cleaner(replace(PLAIN, replace_ip=True)).transform(docs)
    found = findings.explode_findings(table, ["doc_id"]).filter("tag = 'IPV4'")
    assert sorted((r.doc_id, r.original, r.pos) for r in found.collect()) == [
        (0, "10.0.0.1", 0),
        (0, "10.0.0.2", 1),
        (1, "10.0.0.1", 0),
    ]
    (row,) = findings.report_by_source(table).collect()
    assert (row.source, row.tag, row.changes, row.texts) == ("s", "IPV4", 3, 2)
    audit = findings.audit_by_document(table, ["doc_id"]).filter("doc_id = 0").first().audit
    assert audit["IPV4:[IPV4_REDACTED]"].originals == ["10.0.0.1", "10.0.0.2"]


def test_clean_distinct(texts):
    kept, found = Cleaner(PLAIN).clean_distinct(texts("a@b.co", "c@d.co", "", "x"))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3]
    assert {r.doc_id for r in found.collect()} == {0}


def test_corpus_round_trip(spark, texts, tmp_path):
    docs = texts("a\nb", "é", None)
    path = str(tmp_path / "out")
    corpus.write_clean(docs, path)
    with pytest.raises(Exception):
        corpus.write_clean(docs, path)
    schema = docs.schema
    back = corpus.read_directory(spark, path, schema, "*.json*").select("doc_id", "text")
    report = corpus.verify_write(docs, back).first()
    assert report.same_schema and report.same_content and report.rows_written == 3
    assert corpus.differences(docs, back).count() == 0
    changed = corpus.verify_write(docs, back.withColumn("text", F.lit("x"))).first()
    assert not changed.same_content
    with pytest.raises(FileNotFoundError):
        corpus.read_directory(spark, path, schema, "*.none")


def test_broken_and_compressed_lines(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "part.jsonl.gz", "wt") as file:
        file.write('{"doc_id": 1, "text": "a", "other": 5}\n{bad\n')
    (tmp_path / "notes.txt").write_text('{"doc_id": 2}')
    rows = corpus.read_directory(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r._corrupt_record) for r in rows] == [
        (None, None, "{bad"),
        (1, "a", None),
    ]
    assert rows[0].source_file == "part.jsonl.gz"


def test_run_header_hides_keys(spark):
    row = corpus.run_header(spark, CleanConfig()).first()
    assert "hmac" not in row.config and '"check_repeats": 2' in row.config


def test_scratch_folder_comes_from_the_session(spark):
    root = scratch_root(spark)
    assert spark.conf.get("spark.checkpoint.dir") == root
    assert scratch_path(spark, "x").startswith(root)


def test_tables_without_usable_keys(spark):
    """Null and repeated keys: what is found in a text is joined back by its content."""
    rows = [(None, "Say it to Anna or else now"), (1, "Say it to Anna or else now"), (1, "or else Bob")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    names = entities.prepare_gazetteer(
        spark.createDataFrame([("Anna", "PERSON"), ("Bob", "PERSON")], "term string, label string")
    )
    out = sorted(row.text for row in entities.redact_entities(docs, names).collect())
    token = "[NAME_REDACTED]"
    assert out == sorted([f"Say it to {token} or else now"] * 2 + [f"or else {token}"])
    vocabulary = spark.createDataFrame([("else", 9), ("now", 5), ("say", 1)], "term string, freq bigint")
    typos = docs.selectExpr("doc_id", "replace(text, 'else', 'elsse') AS text")
    fixed = spelling.correct_spelling(typos, spelling.spelling_map(typos, vocabulary))
    assert all("else" in row.text and "elsse" not in row.text for row in fixed.collect())
    train = spark.createDataFrame(
        [("the cat and the dog", "en"), ("der hund und die katze", "de")], "text string, lang string"
    )
    model = language.train_language_model(train)
    talk = spark.createDataFrame(
        [(None, "the dog and the cat"), (None, "the dog and the cat"), (2, "die katze"), (2, None)],
        "doc_id bigint, text string",
    )
    found = language.detect_language(talk, model).collect()
    assert sorted(str(row.lang_detected) for row in found) == ["None", "de", "en", "en"]


def test_distinct_without_keys(spark):
    docs = spark.createDataFrame([(None, "a@b.co"), (None, "c@d.co")], "doc_id bigint, text string")
    kept, found = Cleaner(PLAIN).clean_distinct(docs)
    assert kept.count() == 1 and found.count() == 1


def test_spelling_leaves_identifiers_and_foreign_texts(spark):
    vocabulary = spark.createDataFrame([(w, 9) for w in "add be bat dawn at".split()], "term string, freq bigint")
    texts = ["mac aa:bb:cc:dd:ee:ff", "1b4e28ba-abad-4aaa-8bad-0123456789ab", "see /etc/hosts", "oh damn it"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id int, text string, lang_detected string")
    foreign = docs.selectExpr("9 AS doc_id", "'cafe le chat' AS text", "'fr' AS lang_detected").limit(1)
    cleaner = Cleaner(replace(PLAIN, spell_check=True), vocabulary=vocabulary)
    out = {r.doc_id: r.text for r in cleaner.transform(docs.union(foreign)).collect()}
    assert "[MAC_REDACTED]" in out[0] and "[UUID_REDACTED]" in out[1] and "[PATH_REDACTED]" in out[2]
    assert "[PROFANITY_REDACTED]" in out[3] and out[9] == "cafe le chat"


def test_words_of_a_table_in_any_case(spark, texts):
    listed = ["damn", "Holy cow", "holy", "holy cow pat", "élan", "no_go", "b-side", " ", None, "$$", "x!"]
    words = entities.prepare_words(spark.createDataFrame([(w,) for w in listed], "term string"))
    assert {row.term for row in words.collect()} == {"damn", "holy cow", "holy", "holy cow pat", "élan", "no_go", "b-side"}
    docs = texts(
        "DAMN it, damnit; Damn.", "Holy cow! holy cows, HOLY COW PAT", "ÉLAN xélan", "a no_go no go_",
        "B-Side b side", "$$ x!", None, "", "holy", "say\nholy  cow",
    )
    out = entities.redact_words(docs, words, token="#", spans="spans").orderBy("doc_id").collect()
    assert [row.text for row in out] == [
        "# it, damnit; #.", "#! # cows, #", "# xélan", "a # no go_", "# b side", "$$ x!", None, "", "#", "say\n#  cow",
    ]
    assert [(s.pos, s.term) for s in out[1].spans] == [(0, "holy cow"), (5, "holy"), (10, "holy cow pat")]
    keyed = entities.redact_words(docs, words, hmac_key="k").orderBy("doc_id").first().text
    assert keyed.startswith("[PROFANITY_HASH_") and keyed.count("[PROFANITY_HASH_") == 2
    assert entities.redact_words(docs.limit(0), words).count() == 0
    nothing = entities.prepare_words(spark.createDataFrame([], "term string"))
    assert entities.redact_words(docs, nothing).filter("text = 'holy'").count() == 1


def test_table_and_pattern_agree_on_a_short_list(spark):
    from scrubwell import rules
    from scrubwell.functions import redact

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    listed = [row.w for row in docs.select(F.explode(F.split("text", r"\W+")).alias("w")).distinct().limit(60).collect()]
    words = entities.prepare_words(spark.createDataFrame([(w,) for w in listed], "term string"))
    rule = redact.profanity([w for w in listed if w])[0]
    by_pattern = docs.select("doc_id", rule.apply(F.col("text")).alias("text"))
    by_table = entities.redact_words(docs, words, token=rules.TOKENS["PROFANITY"])
    assert sorted(by_table.collect()) == sorted(by_pattern.collect())


def test_names_are_spelled_out_only_where_one_may_begin(spark):
    """Few places of a text reach the join."""
    docs = spark.range(50).selectExpr("id AS doc_id", "concat(repeat('one two three. ', 200), 'Ann Lee ', id) AS text")
    names = entities.prepare_gazetteer(
        spark.createDataFrame([(f"Ann Lee {n}", "PERSON") for n in range(30)], "term string, label string")
    )
    found = entities.find_entities(docs, names)
    assert found.count() == 30
