"""The registered queries: every operator over the given tables.

A query is a function of a session and a data folder.  The text tables hold no
card-free SSN, UUID, code, mis-decoded text and the like, so some queries first
write such values, derived from the keys, into every text.  These expressions
are SQL that Spark and DuckDB both run.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubwell import rules
from scrubwell.functions import lengths, normalize, predicates, redact, repeats, text
from scrubwell.functions.hashing import IDENTITY, content_identity
from scrubwell.operators import (
    dedupe,
    entities,
    findings,
    language,
    reports,
    seen,
    spelling,
    tallies,
)
from scrubwell.plans import oracles as sql
from scrubwell.plans.cleaner import Cleaner
from scrubwell.plans.config import NO_TABLES, CleanConfig
from scrubwell.session import INPUT_TASKS, scratch_path, stage
from scrubwell.sources import corpus, lines
from scrubwell.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table; dealt out evenly where the session asks for it."""
    df = corpus.read_table(spark, folder, name)
    tasks = spark.conf.get(INPUT_TASKS, None)
    return corpus.spread(df, int(tasks)) if tasks else df


def documents(spark: SparkSession, folder: str, spike: str = "text") -> DataFrame:
    df = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return df.withColumn("text", F.expr(spike)) if spike != "text" else df


def documents_sql(spike: str = "text") -> str:
    return f"SELECT doc_id, {spike} AS text FROM documents"


# --- values written into the texts, from the keys ---------------------------
_ID = "cast(doc_id as string)"
_HASH = f"md5({_ID})"


def _number(modulus: int, start: int = 0, width: int = 0) -> str:
    value = f"cast(doc_id % {modulus} + {start} as string)"
    return f"lpad({value}, {width}, '0')" if width else value


SSN = f"concat({_number(900, 100)}, '-', {_number(90, 10)}, '-', {_number(9000, 1000)})"
UUID = (
    f"concat(substr({_HASH}, 1, 8), '-', substr({_HASH}, 9, 4), '-4', substr({_HASH}, 14, 3), "
    f"'-a', substr({_HASH}, 18, 3), '-', substr({_HASH}, 21, 12))"
)
MAC = "concat(" + ", ':', ".join(f"substr({_HASH}, {at}, 2)" for at in range(1, 12, 2)) + ")"
STAMP = (
    f"concat('2024-', {_number(12, 1, 2)}, '-', {_number(28, 1, 2)}, 'T', {_number(24, 0, 2)}, "
    f"':', {_number(60, 0, 2)}, ':07Z')"
)
CLOCK = f"concat({_number(24)}, ':', {_number(60, 0, 2)})"
UNIX_PATH = f"concat('/var/log/app-', {_ID}, '/out.log')"
WINDOWS_PATH = f"concat('C:', chr(92), 'data', chr(92), 'f', {_ID}, '.txt')"
IPV6 = f"concat('2001:db8::', substr({_HASH}, 1, 4))"
CARD = f"concat('4', lpad(cast(doc_id * 7919 % 1000000007 as string), 15, '31'))"
WEB = f"concat('https://example.org/u/', {_ID}, '?q=1')"
MAIL = f"concat('user.', {_ID}, '@mail.example.com')"
PHONE = f"concat('+1 (', {_number(800, 200)}, ') 555-', {_number(10000, 0, 4)})"
AMOUNTS = f"concat('$', {_number(5000, 1)}, '.50, ', {_number(900, 100)}, ' EUR or CAD')"


def _spike(*parts: str) -> str:
    return "concat(text, " + ", ' ', ".join(["' +'", *parts, "'end'"]) + ")"


# hexadecimal digits in three parts, to deal rows to runs
RUN_DIGITS = ("('0','1','2','3','4')", "('5','6','7','8','9')", "('a','b','c','d','e','f')")

SPIKES = {
    "profanity": f"concat('Damn, ', text, ' crap and scrap, no_shit; Bastard ', {_ID})",
    "ipv6": _spike(IPV6, "'add the face at 12:34'"),
    "uuid": _spike(UUID),
    "mac": _spike(MAC),
    "timestamp": _spike(STAMP, CLOCK),
    "filepath": _spike(WINDOWS_PATH, "'|'", UNIX_PATH),
    "ssn": _spike(SSN),
    "card": _spike(CARD),
    "currency": _spike(AMOUNTS),
    "pii": _spike(WEB, MAIL, PHONE),
    "code": (
        f"CASE WHEN length(text) % 2 = 0 THEN concat('```', chr(10), 'a = ', {_ID}, chr(10), "
        "'``` and `b`  ', text) ELSE text END"
    ),
    "spaces": "concat(' ', chr(9), text, '  ', chr(160), 'x', chr(10))",
    "control": "concat(chr(1), text, chr(7), 'x', chr(133), chr(127))",
    "hidden": "concat(text, chr(173), 'x', chr(160), 'y')",
    "runs": f"concat('aaaaaaa ', text, ' bbbbb----- ', {_ID}, '1111111')",
    "marks": "replace(replace(replace(text, '\u00e9', 'e\u0301'), '\u00fc', 'u\u0308'), '\u00f1', 'n\u0303')",
    "repeats": "concat('the the cat. Go. Go. ', text, ' so so')",
}
EVERYTHING = (
    "concat('Damn, ', text, ' + ', "
    + ", ' ', ".join([IPV6, UUID, MAC, STAMP, CLOCK, UNIX_PATH, SSN, CARD, WEB, MAIL, PHONE])
    + ", ' end')"
)


def rewriting(name: str, spike: str, change, *steps: sql.Step) -> None:
    """Register a query that rewrites the text of every document."""

    @register(name, sql.chain(documents_sql(spike), *steps))
    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = documents(spark, folder, spike)
        return df.select("doc_id", change(F.col("text")).alias("text"))


def redacting(name: str, spike: str, rule_list: list[redact.Rule], *steps: sql.Step) -> None:
    def change(column):
        for rule in rule_list:
            column = rule.apply(column)
        return column

    rewriting(name, spike, change, *steps)


# --- sources and sinks ------------------------------------------------------

_LINE_SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
)


def _write_lines(df: DataFrame, name: str, **options: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).json(path)
    return path


@register(
    "scan_corpus",
    "SELECT doc_id, text, CAST(NULL AS VARCHAR) AS corrupt FROM documents UNION ALL "
    "SELECT -1, NULL, concat('{\"doc_id\": ', doc_id, ', \"text\": ') FROM documents",
)
def scan_corpus(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    good = docs.select(F.to_json(F.struct("doc_id", "text")).alias("value"))
    cut_off = docs.select(F.concat(F.lit('{"doc_id": '), "doc_id", F.lit(', "text": ')))
    path = scratch_path(spark, "lines")
    good.unionAll(cut_off).write.text(path)
    return corpus.read_jsonl(spark, path, _LINE_SCHEMA).select(
        F.coalesce("doc_id", F.lit(-1)).alias("doc_id"),
        "text",
        F.col(corpus.CORRUPT).alias("corrupt"),
    )


# --- lines whose fields come, go and change their type ----------------------

_DRIFT = {
    0: "concat(', \"score\": ', doc_id, ', \"tags\": [\"a', doc_id, '\", \"b\"]}')",
    1: "concat(', \"score\": \"', doc_id, '.5\", \"meta\": {\"k\": ', doc_id, ', \"a\": [true, null]}}')",
    2: "', \"score\": \"none\", \"tags\": \"single\"}'",
    3: "concat(', \"score\": null, \"meta\": [', doc_id, ']}')",
    4: "'}'",
}
_DRIFTING = "CASE doc_id % 5 " + " ".join(f"WHEN {n} THEN {end}" for n, end in _DRIFT.items()) + " END"


def _drifting(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as lines with other fields in every fifth one, one line in 17 broken."""
    whole = F.to_json(F.struct("doc_id", "text", "lang"))
    line = F.concat(F.expr("left(j, length(j) - 1)"), F.expr(_DRIFTING))
    broken = F.concat(F.lit("{broken "), F.col("doc_id").cast("string"))
    out = documents(spark, folder).withColumn("j", whole).select(
        F.when(F.col("doc_id") % 17 == 5, broken).otherwise(line).alias("value")
    )
    path = scratch_path(spark, "drifting")
    out.write.text(path)
    return lines.read_lines(spark, path)


@register(
    "scan_variant",
    "SELECT CASE WHEN ok THEN doc_id ELSE -1 END AS doc_id, CASE WHEN ok THEN text END AS text, "
    "CASE WHEN ok THEN lang END AS lang, CASE WHEN NOT ok THEN '{broken ' || doc_id END AS corrupt, "
    "CASE WHEN ok THEN CASE doc_id % 5 WHEN 0 THEN doc_id::DOUBLE WHEN 1 THEN doc_id + 0.5::DOUBLE END END AS score, "
    "CASE WHEN ok AND doc_id % 5 = 0 THEN 'a' || doc_id END AS first_tag, "
    "CASE WHEN ok THEN CASE doc_id % 5 WHEN 1 THEN '{\"a\":[true,null],\"k\":' || doc_id || '}' "
    "WHEN 3 THEN '[' || doc_id || ']' END END AS meta FROM (SELECT *, doc_id % 17 <> 5 AS ok FROM documents)",
)
def scan_variant(spark: SparkSession, folder: str) -> DataFrame:
    """Fields that no schema names, read with a type; lines of another type give NULL."""
    read = lines.with_fields(_drifting(spark, folder), {"score": "double", "meta": "variant"})
    return read.select(
        F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "text", "lang", F.col(corpus.CORRUPT).alias("corrupt"), "score",
        lines.field("$.tags[0]", "string").alias("first_tag"),
        F.to_json("meta").alias("meta"),
    )


@register(
    "variant_fields",
    "SELECT field, type, count(*) AS lines FROM documents JOIN (VALUES "
    "(0, 'score', 'BIGINT'), (0, 'tags', 'ARRAY<STRING>'), (1, 'score', 'STRING'), "
    "(1, 'meta', 'OBJECT<a: ARRAY<BOOLEAN>, k: BIGINT>'), (2, 'score', 'STRING'), (2, 'tags', 'STRING'), "
    "(3, 'score', 'VOID'), (3, 'meta', 'ARRAY<BIGINT>')) v(n, field, type) ON doc_id % 5 = n "
    "WHERE doc_id % 17 <> 5 GROUP BY ALL",
)
def variant_fields(spark: SparkSession, folder: str) -> DataFrame:
    return lines.field_report(_drifting(spark, folder))


@register("scan_chunks", "SELECT doc_id, text FROM documents")
def scan_chunks(spark: SparkSession, folder: str) -> DataFrame:
    lines = _write_lines(documents(spark, folder).select("doc_id", "text"), "lines")
    out, state = scratch_path(spark, "chunks"), scratch_path(spark, "chunks-state")
    stream = jobs.read_stream(spark, lines, _LINE_SCHEMA, files_per_batch=2)
    jobs.write_stream(stream, out, state).awaitTermination()
    return spark.read.schema(_LINE_SCHEMA).parquet(out)


@register(
    "scan_directory",
    "SELECT doc_id, text, false AS compressed FROM documents UNION ALL "
    "SELECT conv_id * 1000 + turn, text, true FROM conversations",
)
def scan_directory(spark: SparkSession, folder: str) -> DataFrame:
    path = _write_lines(documents(spark, folder).select("doc_id", "text"), "folder")
    talk = table(spark, folder, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text"
    )
    talk.write.mode("append").option("compression", "gzip").json(path)
    talk.select("text").write.mode("append").text(path)  # not for the reader
    rows = corpus.read_directory(spark, path, _LINE_SCHEMA, "*.json*")
    return rows.select("doc_id", "text", F.col("source_file").endswith(".gz").alias("compressed"))


@register("project_text", "SELECT doc_id, text FROM documents")
def project_text(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.project_text(corpus.read_table(spark, folder, "documents"))


@register("write_clean", sql.chain(documents_sql(), sql.ipv4))
def write_clean(spark: SparkSession, folder: str) -> DataFrame:
    (rule,) = redact.ipv4()
    path = scratch_path(spark, "clean")
    docs = documents(spark, folder).select("doc_id", rule.apply(F.col("text")).alias("text"))
    corpus.write_clean(docs, path)
    return corpus.read_jsonl(spark, path, _LINE_SCHEMA).select("doc_id", "text")


@register("snapshot_raw", "SELECT doc_id, text, lang, source FROM documents")
def snapshot_raw(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.snapshot_raw(documents(spark, folder), scratch_path(spark, "snapshot"))


@register(
    "verify_write",
    "SELECT true AS same_schema, count(*) AS rows_expected, count(*) AS rows_written, "
    "true AS same_content FROM documents",
)
def verify_write(spark: SparkSession, folder: str) -> DataFrame:
    docs = corpus.project_text(documents(spark, folder))
    written = corpus.read_jsonl(spark, _write_lines(docs, "written"), _LINE_SCHEMA)
    return corpus.verify_write(docs, written.select("doc_id", "text"))


@register(
    "write_differences",
    "SELECT doc_id, text, 'written' AS missing_from FROM documents UNION ALL "
    "SELECT doc_id, concat(text, '!'), 'expected' FROM documents",
)
def write_differences(spark: SparkSession, folder: str) -> DataFrame:
    docs = corpus.project_text(documents(spark, folder))
    return corpus.differences(docs, docs.withColumn("text", F.concat("text", F.lit("!"))))


@register(
    "concat_results",
    "SELECT doc_id, text, source FROM documents UNION ALL "
    "SELECT item_id, text, NULL FROM benchmark",
)
def concat_results(spark: SparkSession, folder: str) -> DataFrame:
    more = table(spark, folder, "benchmark").withColumnRenamed("item_id", "doc_id")
    return corpus.concat_results(documents(spark, folder).drop("lang"), more)


# --- normalisation ----------------------------------------------------------

rewriting("normalize_nfc", SPIKES["marks"], normalize.normalize_nfc, sql.nfc)
rewriting("collapse_space", SPIKES["spaces"], normalize.collapse_space, sql.collapse_space)
rewriting("collapse_space_code", SPIKES["code"], normalize.collapse_space, sql.collapse_space)
rewriting("strip_control", SPIKES["control"], normalize.strip_control, sql.strip_control)
rewriting(
    "strip_nonprintable", SPIKES["hidden"], normalize.strip_nonprintable, sql.strip_nonprintable
)
rewriting("shrink_runs", SPIKES["runs"], normalize.shrink_runs, sql.shrink_runs)
rewriting("trim_text", SPIKES["spaces"], normalize.trim_text, sql.trim_text)
rewriting("strip_code", SPIKES["code"], normalize.strip_code, sql.code_fence, sql.code_inline)


@register("strip_html", sql.chain("SELECT page_id, html AS text FROM pages", sql.strip_html))
def strip_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return pages.select("page_id", normalize.strip_html(F.col("html")).alias("text"))


def _misread(letter: str) -> str:
    """A letter as it looks when its UTF-8 bytes are read as windows-1252."""
    table_ = str.maketrans(rules.CP1252_BYTES, rules.CP1252_MARKS)
    return letter.encode("utf-8").decode("latin-1").translate(table_)


def _misread_all(column: str) -> str:
    for letter in "éèêçàùâîôûëïñóíáúüöäßÉÈÊÇÜÖÄÑÓÍÁÚ’":
        column = f"replace({column}, '{letter}', '{_misread(letter)}')"
    return column


# Undoing the damage must give back the text as it was.
@register("repair_mojibake", documents_sql())
def repair_mojibake(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, _misread_all("text"))
    return docs.select("doc_id", normalize.repair_mojibake(F.col("text")).alias("text"))


@register("has_code", f"SELECT doc_id, {sql.has_code()} AS has_code FROM ({documents_sql(SPIKES['code'])})")
def has_code(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, SPIKES["code"])
    return docs.select("doc_id", text.has_code(F.col("text")).alias("has_code"))


@register(
    "split_sentences",
    "SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS pos, unnest(s) AS sentence "
    f"FROM (SELECT doc_id, {sql.sentence_list('text')} AS s FROM documents)",
)
def split_sentences(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return docs.select("doc_id", F.posexplode(text.sentences(F.col("text"))).alias("pos", "sentence"))


@register(
    "split_tokens",
    "SELECT doc_id, len(list_filter(w, lambda x: x <> '')) AS n_tokens, "
    "array_to_string(list_filter(w, lambda x: x <> ''), '|') AS tokens, "
    "len(string_split(text, ' ')) AS n_space_tokens FROM (SELECT doc_id, text, "
    f"string_split_regex(text, {sql.lit(sql.SPACE + '+')}) AS w FROM documents)",
)
def split_tokens(spark: SparkSession, folder: str) -> DataFrame:
    words = text.tokens(F.col("text"))
    return documents(spark, folder).select(
        "doc_id",
        F.size(words).cast("bigint").alias("n_tokens"),
        F.array_join(words, "|").alias("tokens"),
        F.size(text.space_tokens(F.col("text"))).cast("bigint").alias("n_space_tokens"),
    )


_PIECES_RE2 = rf"[^{rules.ASCII_PUNCTUATION}\s]+|[{rules.ASCII_PUNCTUATION}\s]"


@register(
    "split_punct",
    "SELECT doc_id, len(p) AS n_pieces, array_to_string(p, chr(1)) AS pieces FROM "
    f"(SELECT doc_id, regexp_extract_all(text, {sql.lit(_PIECES_RE2)}) AS p FROM documents)",
)
def split_punct(spark: SparkSession, folder: str) -> DataFrame:
    parts = text.pieces(F.col("text"))
    return documents(spark, folder).select(
        "doc_id",
        F.size(parts).cast("bigint").alias("n_pieces"),
        F.array_join(parts, "\x01").alias("pieces"),
    )


# --- redaction --------------------------------------------------------------

redacting("redact_profanity", SPIKES["profanity"], redact.profanity(), sql.profanity)
redacting("redact_ipv4", "text", redact.ipv4(), sql.ipv4)
redacting("redact_ipv6", SPIKES["ipv6"], redact.ipv6(), sql.ipv6)
redacting("redact_uuid", SPIKES["uuid"], redact.uuid(), sql.uuid)
redacting("redact_mac", SPIKES["mac"], redact.mac(), sql.mac)
redacting(
    "redact_timestamp",
    SPIKES["timestamp"],
    redact.timestamp(),
    sql.timestamp_iso,
    sql.time_simple,
)
redacting(
    "redact_filepath", SPIKES["filepath"], redact.filepath(), sql.path_windows, sql.path_unix
)
redacting("redact_ssn", SPIKES["ssn"], redact.ssn(), sql.ssn)
redacting("redact_credit_card", SPIKES["card"], redact.credit_card(), sql.credit_card)
redacting("redact_email", SPIKES["pii"], redact.email(), sql.email)
redacting("redact_phone", SPIKES["pii"], redact.phone(), sql.phone())
redacting("redact_currency", SPIKES["currency"], redact.currency(), sql.currency)
redacting(
    "remove_pii",
    SPIKES["pii"],
    redact.pii_removal(),
    sql.substitute(sql.URL, ""),
    sql.substitute(sql.EMAIL, r"\1"),
    sql.phone(""),
)
redacting(
    "redact_candidate_currency",
    "text",
    redact.candidate_currency(),
    sql.phone(
        decide=f"CASE WHEN {sql.is_phone_like('c.cand')} AND NOT {sql.is_date_like('c.cand')} "
        f"AND {sql.is_currency_like('c.cand')} THEN '{rules.CANDIDATE_CURRENCY_TOKEN}' "
        "ELSE c.cand END"
    ),
)


@register(
    "redact_url",
    sql.chain("SELECT page_id, concat(url, ' ', html) AS text FROM pages", sql.url),
)
def redact_url(spark: SparkSession, folder: str) -> DataFrame:
    (rule,) = redact.url()
    joined = F.concat_ws(" ", "url", "html")
    return table(spark, folder, "pages").select("page_id", rule.apply(joined).alias("text"))


# The first match of a text decides for all of them.
def _gated(pattern: str, token: str, extra: str = "true") -> sql.Step:
    first = f"regexp_extract(text, {sql.lit(pattern)})"
    other = (
        f"({sql.is_phone_like(first)} OR {sql.is_currency_like(first)} "
        f"OR {sql.is_date_like(first)})"
    )
    return sql.rewrite(
        f"CASE WHEN {first} <> '' AND NOT {other} AND {extra} "
        f"THEN {sql.replace_all('text', pattern, token)} ELSE text END"
    )


redacting(
    "redact_mac_first_match_gate",
    SPIKES["mac"],
    redact.mac(gate="reference"),
    _gated(sql.MAC, rules.TOKENS["MAC"]),
)
redacting(
    "redact_uuid_first_match_gate",
    SPIKES["uuid"],
    redact.uuid(gate="reference"),
    _gated(sql.UUID, rules.TOKENS["UUID"]),
)

PSEUDONYM_KEY = "corpus-key"


def _hmac_sql(value: str, key: str) -> str:
    block = key.encode().ljust(64, b"\0")
    inner = bytes(byte ^ 0x36 for byte in block).hex()
    outer = bytes(byte ^ 0x5C for byte in block).hex()
    return (
        f"sha256(from_hex('{outer}') || from_hex(sha256(from_hex('{inner}') || encode({value}))))"
    )


redacting(
    "pseudonymize",
    SPIKES["ssn"],
    redact.ssn(key=PSEUDONYM_KEY) + redact.ipv4(key=PSEUDONYM_KEY),
    sql.per_match(sql.SSN, f"'[SSN_HASH_' || left({_hmac_sql('h', PSEUDONYM_KEY)}, 16) || ']'"),
    sql.per_match(sql.IPV4, f"'[IPV4_HASH_' || left({_hmac_sql('h', PSEUDONYM_KEY)}, 16) || ']'"),
)

_OFF = NO_TABLES | {
    "normalize_unicode": False,
    "remove_html_tags": False,
    "collapse_whitespace": False,
    "remove_control_chars": False,
    "remove_nonprintable": False,
    "shrink_repeated_chars": False,
    "remove_lead_trail": False,
    "fix_mojibake": False,
    "check_repeats": None,
    "min_drop_length": 0,
}
REDACTION_ONLY = CleanConfig(replace_ip=True, **_OFF)


@register("redact_all", sql.redact_all(documents_sql(EVERYTHING)))
def redact_all(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, EVERYTHING)
    return Cleaner(REDACTION_ONLY).transform(docs).select("doc_id", "text")


@register(
    "clean_corpus",
    sql.chain(
        documents_sql(EVERYTHING),
        sql.nfc,
        sql.strip_html,
        sql.collapse_space,
        sql.strip_control,
        sql.strip_nonprintable,
        sql.shrink_runs,
        sql.trim_text,
        *[step for name, _, _, step in sql.REDACT_ALL if name != "replace_ip"],
        sql.drop_repeats,
        sql.null_short(1),
        final="SELECT doc_id, text FROM {last}",
    ),
)
def clean_corpus(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, EVERYTHING)
    return Cleaner(CleanConfig(**NO_TABLES)).transform(docs).select("doc_id", "text")


@register(
    "clean_inside_code",
    sql.chain(
        documents_sql(SPIKES["code"]),
        sql.substitute(sql.SPACE + "+", " "),
        sql.trim_text,
        final="SELECT doc_id, text FROM {last}",
    ),
)
def clean_inside_code(spark: SparkSession, folder: str) -> DataFrame:
    """White space goes in texts that hold code too."""
    steps = dict.fromkeys(CleanConfig(**_OFF).active(), False)
    config = CleanConfig(**_OFF | steps | {"collapse_whitespace": True, "remove_lead_trail": True})
    cleaner = Cleaner(config, keep_code=False)
    return cleaner.transform(documents(spark, folder, SPIKES["code"])).select("doc_id", "text")


# --- predicates -------------------------------------------------------------

_CANDIDATES = {
    "iso_date": "substr(cast(o_orderdate as string), 1, 10)",
    "day_date": "concat('(', cast(o_orderkey % 28 + 1 as string), '/12/98)')",
    "eight_digits": "lpad(cast(o_orderkey as string), 8, '7')",
    "year": "substr(cast(o_orderdate as string), 1, 4)",
    "symbol": "concat('$', cast(o_custkey as string))",
    "code": "concat(cast(o_custkey as string), ' usd')",
    "thousands": "concat(cast(o_orderkey % 900 + 1 as string), ',', lpad(cast(o_custkey % 1000 as string), 3, '0'), '.000 EUR')",
    "plain": "concat(cast(o_orderkey as string), '.', cast(o_custkey as string))",
    "phone": "concat('+', cast(o_custkey as string), '-', lpad(cast(o_orderkey as string), 6, '5'))",
    "word": "o_orderpriority",
}
_CANDIDATE_ROWS_SQL = " UNION ALL ".join(
    f"SELECT o_orderkey, '{kind}' AS kind, {value} AS candidate FROM orders"
    for kind, value in _CANDIDATES.items()
)


def _candidates(spark: SparkSession, folder: str) -> DataFrame:
    made = [
        F.struct(F.lit(kind).alias("kind"), F.expr(value).alias("candidate"))
        for kind, value in _CANDIDATES.items()
    ]
    return table(spark, folder, "orders").select("o_orderkey", F.inline(F.array(*made)))


def deciding(name: str, test, test_sql: str) -> None:
    """Register a yes/no decision over candidates made from the orders."""

    @register(
        name,
        f"SELECT o_orderkey, kind, candidate, {test_sql} AS result FROM ({_CANDIDATE_ROWS_SQL})",
    )
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _candidates(spark, folder).withColumn("result", test(F.col("candidate")))


_POSSIBLE_SQL = (
    f"({sql.is_phone_like('candidate')} OR {sql.is_currency_like('candidate')} "
    f"OR {sql.is_date_like('candidate')})"
)
deciding("is_date_like", predicates.is_date_like, sql.is_date_like("candidate"))
deciding("is_currency_like", predicates.is_currency_like, sql.is_currency_like("candidate"))
deciding("is_amount", predicates.is_amount, sql.is_amount("candidate"))
deciding("is_phone_like", predicates.is_phone_like, sql.is_phone_like("candidate"))
deciding("check_possible", predicates.is_possible_other, _POSSIBLE_SQL)
deciding(
    "phone_decision",
    lambda candidate: predicates.phone_decision(candidate, "remove", currency=True),
    f"CASE WHEN NOT {sql.is_phone_like('candidate')} OR {sql.is_date_like('candidate')} "
    f"THEN 'keep' WHEN {sql.is_currency_like('candidate')} THEN 'currency' ELSE 'remove' END",
)

_CARD_SQL = (
    "concat(cast(4000 + o_custkey % 1000 as string), ' ', lpad(cast(o_orderkey as string), 4, '0'), "
    "'-', lpad(cast(o_custkey * 31 as string), 5, '0'), cast(o_orderkey * 7 as string))"
)


@register(
    "luhn_valid",
    f"SELECT o_orderkey, card, {sql.luhn_valid('card')} AS valid FROM "
    f"(SELECT o_orderkey, {_CARD_SQL} AS card FROM orders)",
)
def luhn_valid(spark: SparkSession, folder: str) -> DataFrame:
    cards = table(spark, folder, "orders").select("o_orderkey", F.expr(_CARD_SQL).alias("card"))
    return cards.withColumn("valid", predicates.is_luhn_valid(F.col("card")))


# --- length rules -----------------------------------------------------------

_TALK = "SELECT conv_id, turn, text FROM conversations"


@register("null_short", sql.chain(_TALK, sql.null_short(200)))
def null_short(spark: SparkSession, folder: str) -> DataFrame:
    talk = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return talk.withColumn("text", lengths.null_short(F.col("text"), 200))


@register(
    "drop_null", sql.chain(_TALK, sql.null_short(200), final="SELECT * FROM {last} WHERE text IS NOT NULL")
)
def drop_null(spark: SparkSession, folder: str) -> DataFrame:
    return null_short(spark, folder).filter(F.col("text").isNotNull())


rewriting(
    "truncate_chars",
    "text",
    lambda column: lengths.truncate_chars(column, 300),
    sql.rewrite(
        "CASE WHEN length(text) > 300 THEN "
        f"regexp_replace(left(text, 300), {sql.lit(sql.SPACE + '+$')}, '') ELSE text END"
    ),
)


def _truncate_sql(limit: int) -> str:
    words = f"list_filter(string_split_regex(text, {sql.lit(sql.SPACE + '+')}), lambda x: x <> '')"
    size = f"len(list_filter(string_split_regex(sentence, {sql.lit(sql.SPACE + '+')}), lambda x: x <> ''))"
    return f"""
    WITH d AS (SELECT doc_id, text, {words} AS w, {sql.sentence_list('text')} AS s FROM documents),
    e AS (SELECT doc_id, pos, sentence,
                 sum({size}) OVER (PARTITION BY doc_id ORDER BY pos) AS total
          FROM (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS pos FROM d)),
    k AS (SELECT doc_id, string_agg(sentence, ' ' ORDER BY pos) AS kept
          FROM e WHERE total <= {limit} GROUP BY doc_id)
    SELECT doc_id, CASE WHEN len(w) <= {limit} THEN text
                        WHEN kept IS NOT NULL THEN {sql.strip('kept')}
                        ELSE array_to_string(w[1:{limit}], ' ') END AS text
    FROM d LEFT JOIN k USING (doc_id)"""


@register("truncate_tokens", _truncate_sql(40))
def truncate_tokens(spark: SparkSession, folder: str) -> DataFrame:
    cut = lengths.truncate_tokens(F.col("text"), 40)
    return documents(spark, folder).select("doc_id", cut.alias("text"))


@register(
    "truncate_tokens_plain",
    f"SELECT doc_id, CASE WHEN len(w) <= 40 THEN text ELSE array_to_string(w[1:40], ' ') END AS text "
    "FROM (SELECT doc_id, text, list_filter(string_split_regex(text, "
    f"{sql.lit(sql.SPACE + '+')}), lambda x: x <> '') AS w FROM documents)",
)
def truncate_tokens_plain(spark: SparkSession, folder: str) -> DataFrame:
    cut = lengths.truncate_tokens(F.col("text"), 40, whole_sentences=False)
    return documents(spark, folder).select("doc_id", cut.alias("text"))


# --- repeats ----------------------------------------------------------------

rewriting("dedupe_words", SPIKES["repeats"], repeats.dedupe_words, sql.dedupe_words)
rewriting("dedupe_sentences", SPIKES["repeats"], repeats.dedupe_sentences, sql.dedupe_sentences)
rewriting("drop_repeats", SPIKES["repeats"], repeats.drop_repeats, sql.drop_repeats)
rewriting("drop_repeats_code", SPIKES["code"], repeats.drop_repeats, sql.drop_repeats)


@register("drop_repeats_wide", sql.drop_repeats_wide("documents", 4))
def drop_repeats_wide(spark: SparkSession, folder: str) -> DataFrame:
    thinned = repeats.drop_repeats(F.col("text"), 4)
    return documents(spark, folder).select("doc_id", thinned.alias("text"))


@register(
    "token_tally",
    "SELECT doc_id, token, string_agg(pos, ',' ORDER BY pos) AS positions FROM ("
    "SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos "
    "FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)) GROUP BY doc_id, token",
)
def token_tally(spark: SparkSession, folder: str) -> DataFrame:
    tally = tallies.token_tally(documents(spark, folder), ["doc_id"])
    return tally.withColumn("positions", F.array_join("positions", ","))


@register(
    "repeat_gaps",
    "SELECT doc_id, token, pos, gap FROM (SELECT doc_id, token, CAST(pos AS INTEGER) AS pos, "
    "CAST(pos - lag(pos) OVER (PARTITION BY doc_id, token ORDER BY pos) AS INTEGER) AS gap FROM ("
    "SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos "
    "FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents))) WHERE gap IS NOT NULL",
)
def repeat_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return tallies.repeat_gaps(documents(spark, folder), ["doc_id"])


# --- language ---------------------------------------------------------------


def _gram_sql(source: str, keys: str) -> str:
    return (
        f"SELECT {keys}, c[i] || c[i + 1] || c[i + 2] AS gram FROM (SELECT {keys}, c, "
        f"unnest(range(1, len(c) - 1)) AS i FROM (SELECT {keys}, string_split(lower(text), '') AS c "
        f"FROM {source}))"
    )


_PROFILE_SQL = f"""
    g AS MATERIALIZED (SELECT lang, gram, count(*) AS n FROM ({_gram_sql('documents', 'lang')})
                       GROUP BY lang, gram),
    v AS (SELECT count(DISTINCT gram) AS kinds FROM g),
    m AS (SELECT lang, sum(n) + any_value(kinds) AS mass FROM g, v GROUP BY lang),
    p AS MATERIALIZED (SELECT lang, gram, n,
             CAST(round(ln((n + 1) / mass) * 1000) AS BIGINT) AS logp_milli,
             CAST(round(ln(1 / mass) * 1000) AS BIGINT) AS floor_milli FROM g JOIN m USING (lang))"""


def _detect_sql(source: str, keys: str) -> str:
    on = " AND ".join(f"s.{key.strip()} = d.{key.strip()}" for key in keys.split(","))
    return f"""{_PROFILE_SQL},
    f AS (SELECT DISTINCT lang, floor_milli FROM p),
    q AS (SELECT {keys}, lang, sum(logp_milli - floor_milli) AS gain
          FROM ({_gram_sql(source, keys)}) JOIN p USING (gram) GROUP BY {keys}, lang),
    s AS (SELECT {keys}, arg_max(lang, (score, lang)) AS lang_detected FROM (
            SELECT {', '.join('d.' + key.strip() for key in keys.split(','))}, f.lang,
                   coalesce(q.gain, 0) + (length(d.text) - 2) * f.floor_milli AS score
            FROM {source} d CROSS JOIN f
            LEFT JOIN q ON {' AND '.join(f'q.{key.strip()} = d.{key.strip()}' for key in keys.split(','))}
                 AND q.lang = f.lang
            WHERE length(d.text) > 2) GROUP BY {keys}),
    found AS (SELECT d.*, s.lang_detected FROM {source} d LEFT JOIN s ON {on})"""


def _trained(spark: SparkSession, folder: str) -> language.LanguageModel:
    return language.train_language_model(documents(spark, folder))


@register(
    "train_language_profiles",
    f"WITH {_PROFILE_SQL} SELECT lang, gram, n, logp_milli FROM p",
)
def train_language_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return language.profile_table(_trained(spark, folder))


@register(
    "detect_language",
    f"WITH {_detect_sql('conversations', 'conv_id, turn')} "
    "SELECT conv_id, turn, lang_detected FROM found",
)
def detect_language(spark: SparkSession, folder: str) -> DataFrame:
    talk = table(spark, folder, "conversations")
    found = language.detect_language(talk, _trained(spark, folder))
    return found.select("conv_id", "turn", "lang_detected")


@register(
    "route_foreign",
    f"WITH {_detect_sql('documents', 'doc_id')} SELECT doc_id, lang, lang_detected, "
    "coalesce(lang_detected <> 'en', false) AS needs_translation FROM found",
)
def route_foreign(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    routed = language.route_foreign(docs, language.train_language_model(docs))
    return routed.select("doc_id", "lang", "lang_detected", "needs_translation")


@register(
    "blank_foreign",
    f"WITH {_detect_sql('conversations', 'conv_id, turn')} SELECT conv_id, turn, "
    "CASE WHEN lang_detected <> 'en' THEN '' ELSE text END AS text FROM found",
)
def blank_foreign(spark: SparkSession, folder: str) -> DataFrame:
    talk = table(spark, folder, "conversations")
    blanked = language.blank_foreign(talk, _trained(spark, folder))
    return blanked.select("conv_id", "turn", "text")


# --- spelling ---------------------------------------------------------------

MIN_COUNT = 5
_GUARDED_RE2 = (
    r"(?i:(?:(?:https?|ftp)://|www\.)[^\s<>\"]+)"
    r"|(?i:[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,})|" + rules.GUARDED_TOKEN + "|" + _PIECES_RE2
)
_LOWER_RE2 = r"^[\p{Ll}\p{Lo}\p{Lm}][\p{L}\p{M}]*$"
_ACCENTS = "éèêëàâäáçîïíìôöóòûüúùñßæœåø"
_MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|"
_PLAIN_SQL = f"regexp_replace(text, {sql.lit(f'([.?!]){sql.SPACE}+')}, '\\1 ', 'g')"
_TERMS_SQL = f"""
    voc AS MATERIALIZED (SELECT lower(piece) AS term, count(*) AS freq FROM (
        SELECT unnest(regexp_extract_all(text, {sql.lit(_GUARDED_RE2)})) AS piece
        FROM documents WHERE lang = 'en')
      WHERE regexp_matches(piece, '^\\p{{L}}[\\p{{L}}\\p{{M}}]*$')
      GROUP BY lower(piece))"""
_VOCABULARY_SQL = _TERMS_SQL.removesuffix(")") + f" HAVING count(*) >= {MIN_COUNT})"


def _bytes_sql(word: str) -> str:
    """Accented letters as ASCII marks: the distance function counts bytes."""
    return f"translate({word}, {sql.lit(_ACCENTS)}, {sql.lit(_MARKS[: len(_ACCENTS)])})"


def _deletions_sql(source: str, column: str, name: str) -> str:
    """Every word with up to two characters left out, wherever they stand."""

    def shorter(table_: str) -> str:
        return (
            "SELECT w, left(key, i - 1) || substr(key, i + 1) AS key FROM (SELECT w, key, "
            f"unnest(range(1, length(key) + 1)) AS i FROM {table_})"
        )

    return (
        f"{name}0 AS (SELECT {column} AS w, {column} AS key FROM {source}), "
        f"{name}1 AS MATERIALIZED (SELECT * FROM {name}0 UNION {shorter(name + '0')}), "
        f"{name}2 AS MATERIALIZED (SELECT * FROM {name}1 UNION {shorter(name + '1')})"
    )


# DuckDB may change what stands between two exchanged letters, which one
# alignment step cannot; such pairs are put to the stricter test.
def _swap_and_step_sql() -> str:
    swapped = "substr(word, i + 1, 1) || substr(word, i, 1)"
    front = f"left(word, i - 1) || {swapped}"
    back = f"{swapped} || substr(word, i + 2)"

    def one_step(left: str, right: str) -> str:
        return f"damerau_levenshtein({_bytes_sql(left)}, {_bytes_sql(right)}) <= 1"

    behind = one_step("substr(word, i + 2)", "substr(term, i + 2)")
    before = one_step("left(word, i - 1)", "left(term, length(term) - length(word) + i - 1)")
    return (
        "len(list_filter(range(1, length(word)), lambda i: "
        f"(starts_with(term, {front}) AND {behind}) OR "
        f"(ends_with(term, {back}) AND length(term) >= length(word) - i + 1 AND {before}))) > 0"
    )


_SWAP_AND_STEP_SQL = _swap_and_step_sql()


def _suggest_sql(source: str, keep: str = "") -> str:
    return f"""{_VOCABULARY_SQL},
    parts AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_PLAIN_SQL}, {sql.lit(_GUARDED_RE2)}) AS p
                           FROM {source}),
    unknown AS MATERIALIZED (SELECT DISTINCT piece AS word FROM (SELECT unnest(p) AS piece FROM parts)
        WHERE regexp_matches(piece, {sql.lit(_LOWER_RE2)})
          AND piece NOT IN (SELECT term FROM voc){keep}),
    {_deletions_sql('unknown', 'word', 'u')},
    {_deletions_sql('voc', 'term', 'v')},
    pairs AS MATERIALIZED (SELECT word, term,
                     damerau_levenshtein({_bytes_sql('word')}, {_bytes_sql('term')}) AS steps,
                     levenshtein({_bytes_sql('word')}, {_bytes_sql('term')}) AS plain
              FROM (SELECT DISTINCT u2.w AS word, v2.w AS term FROM u2 JOIN v2 USING (key))),
    near AS (SELECT word, term, freq, steps AS distance FROM pairs JOIN voc USING (term)
             WHERE steps <= 2 AND (plain <= 2 OR steps < 2 OR {_SWAP_AND_STEP_SQL})),
    sug AS MATERIALIZED (SELECT word, b.term AS term, CAST(b.distance AS INTEGER) AS distance FROM (
        SELECT word, min({{'distance': distance, 'rank': -freq, 'term': term}}) AS b
        FROM near GROUP BY word))"""


_SUGGEST_SQL = _suggest_sql("documents")


def _vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    english = documents(spark, folder).filter(F.col("lang") == "en")
    return spelling.build_vocabulary(english, min_count=MIN_COUNT)


@register("build_vocabulary", f"WITH {_TERMS_SQL} SELECT term, freq FROM voc")
def build_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """All terms; the queries below ask for those seen MIN_COUNT times."""
    return spelling.build_vocabulary(documents(spark, folder).filter(F.col("lang") == "en"))


@register("suggest_spelling", f"WITH {_SUGGEST_SQL} SELECT word, term, distance FROM sug")
def suggest_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_map(documents(spark, folder), _vocabulary(spark, folder))


@register(
    "spell_correct",
    f"WITH {_SUGGEST_SQL}, words AS (SELECT doc_id, unnest(p) AS piece, "
    "generate_subscripts(p, 1) AS pos FROM parts) "
    "SELECT doc_id, string_agg(coalesce(term, piece), '' ORDER BY pos) AS text "
    "FROM words LEFT JOIN sug ON piece = word GROUP BY doc_id",
)
def spell_correct(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    suggestions = spelling.spelling_map(docs, _vocabulary(spark, folder))
    return spelling.correct_spelling(docs, suggestions)


# --- names ------------------------------------------------------------------

_NAMED_SQL = (
    "SELECT d.doc_id, concat('In ', n_name, ', ', d.text, ' met ', c_name, ' of ', r_name, '.') "
    "AS text FROM documents d JOIN customer c ON c_custkey = d.doc_id % (SELECT count(*) FROM customer) "
    "JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"
)
_GAZETTEER_SQL = (
    "SELECT n_name AS term, 'GPE' AS label FROM nation UNION ALL SELECT r_name, 'LOC' FROM region "
    "UNION ALL SELECT c_name, 'PERSON' FROM customer"
)


def _gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    nations = corpus.read_table(spark, folder, "nation")
    regions = corpus.read_table(spark, folder, "region")
    people = corpus.read_table(spark, folder, "customer")
    return (
        nations.select(F.col("n_name").alias("term"), F.lit("GPE").alias("label"))
        .unionAll(regions.select("r_name", F.lit("LOC")))
        .unionAll(people.select("c_name", F.lit("PERSON")))
    )


def _named(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the names of one customer, its nation and region."""
    people = corpus.read_table(spark, folder, "customer")
    size = people.count()
    return (
        documents(spark, folder)
        .withColumn("c_custkey", F.col("doc_id") % size)
        .join(people, "c_custkey")
        .join(corpus.read_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(corpus.read_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "doc_id",
            F.expr("concat('In ', n_name, ', ', text, ' met ', c_name, ' of ', r_name, '.')").alias(
                "text"
            ),
        )
    )


def _spans_sql(source: str) -> str:
    return f"""
    d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(text, {sql.lit(_PIECES_RE2)}) AS p
                       FROM {source}),
    gaz AS MATERIALIZED (SELECT term, label, len(regexp_extract_all(term, {sql.lit(_PIECES_RE2)})) AS k
                         FROM ({_GAZETTEER_SQL})),
    place AS MATERIALIZED (SELECT doc_id, i, piece AS w1, piece || lead(piece, 1) OVER o AS w2,
               piece || lead(piece, 1) OVER o || lead(piece, 2) OVER o AS w3
               FROM (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM d)
               WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    hit AS MATERIALIZED (
        SELECT doc_id, i, k, term, label FROM place JOIN gaz ON w1 = term AND k = 1 UNION ALL
        SELECT doc_id, i, k, term, label FROM place JOIN gaz ON w2 = term AND k = 2 UNION ALL
        SELECT doc_id, i, k, term, label FROM place JOIN gaz ON w3 = term AND k = 3),
    span AS MATERIALIZED (SELECT * FROM hit h WHERE NOT EXISTS (SELECT 1 FROM hit o
            WHERE o.doc_id = h.doc_id AND (o.i < h.i AND o.i + o.k > h.i OR o.i = h.i AND o.k > h.k)))"""


def _without_names_sql(source: str) -> str:
    return (
        f"WITH {_spans_sql(source)}, piece AS (SELECT doc_id, unnest(p) AS piece, "
        "generate_subscripts(p, 1) AS i FROM d) SELECT piece.doc_id, string_agg(CASE WHEN "
        f"span.i = piece.i THEN '{rules.TOKENS['NAME']}' WHEN span.i IS NOT NULL THEN '' ELSE piece END, '' "
        "ORDER BY piece.i) AS text FROM piece LEFT JOIN span ON span.doc_id = piece.doc_id "
        "AND piece.i BETWEEN span.i AND span.i + span.k - 1 GROUP BY piece.doc_id"
    )


@register(
    "entity_spans",
    f"WITH {_spans_sql(f'({_NAMED_SQL})')} SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, "
    "CAST(k AS INTEGER) AS len, term, label FROM span",
)
def entity_spans(spark: SparkSession, folder: str) -> DataFrame:
    names = entities.prepare_gazetteer(_gazetteer(spark, folder))
    spans = entities.find_entities(_named(spark, folder), names)
    return spans.select("doc_id", F.inline("spans"))


@register("redact_entities", _without_names_sql(f"({_NAMED_SQL})"))
def redact_entities(spark: SparkSession, folder: str) -> DataFrame:
    names = entities.prepare_gazetteer(_gazetteer(spark, folder))
    return entities.redact_entities(_named(spark, folder), names)


_LISTED = f"concat({SPIKES['profanity']}, ' so BAD', cast(doc_id % 2000 as string), ' bad', ' xbad1')"
_WORD_PIECES_RE2 = r"[\p{L}\p{M}\p{Nd}_]+|[^\p{L}\p{M}\p{Nd}_]"
_WORD_LIST = ", ".join(f"('{word}')" for word in sorted(rules.PROFANITY))


@register(
    "redact_profanity_table",
    f"WITH listed AS (SELECT lower(w) AS term FROM (VALUES {_WORD_LIST}) v(w) "
    "UNION SELECT 'bad' || c_custkey FROM customer), piece AS (SELECT doc_id, unnest(p) AS piece, "
    f"generate_subscripts(p, 1) AS i FROM (SELECT doc_id, regexp_extract_all({_LISTED}, "
    f"{sql.lit(_WORD_PIECES_RE2)}) AS p FROM documents)) SELECT doc_id, string_agg(CASE WHEN term IS NULL "
    f"THEN piece ELSE '{rules.TOKENS['PROFANITY']}' END, '' ORDER BY i) AS text FROM piece "
    "LEFT JOIN listed ON lower(piece) = term GROUP BY doc_id",
)
def redact_profanity_table(spark: SparkSession, folder: str) -> DataFrame:
    """A word list that grows with the tables, too long for a pattern."""
    people = corpus.read_table(spark, folder, "customer")
    short = spark.createDataFrame([(word,) for word in sorted(rules.PROFANITY)], "term string")
    listed = short.union(people.select(F.concat(F.lit("bad"), "c_custkey")))
    words = entities.prepare_words(listed)
    redacted = entities.redact_words(documents(spark, folder, _LISTED), words)
    return redacted.select("doc_id", "text")


# --- the whole cleaner ------------------------------------------------------


def _language_step(source: str) -> str:
    return f"WITH {_detect_sql(source, 'doc_id')} SELECT * FROM found"


def _spelling_step(home: str = "true") -> sql.Step:
    """Texts for which ``home`` holds; words of the profanity list stay."""
    listed = "|".join(sorted(rules.PROFANITY))
    keep = f" AND NOT regexp_matches(piece, '(?i)\\b(?:{listed})\\b')"

    def step(source: str) -> str:
        here = f"(SELECT doc_id, text FROM {source} WHERE {home})"
        return (
            f"WITH {_suggest_sql(here, keep)}, words AS (SELECT doc_id, unnest(p) AS piece, "
            "generate_subscripts(p, 1) AS pos FROM parts), fixed AS ("
            "SELECT doc_id, string_agg(coalesce(term, piece), '' ORDER BY pos) AS text "
            "FROM words LEFT JOIN sug ON piece = word GROUP BY doc_id) "
            "SELECT o.* REPLACE (coalesce(fixed.text, o.text) AS text) "
            f"FROM {source} o LEFT JOIN fixed USING (doc_id)"
        )

    return step


def _names_step(source: str) -> str:
    return (
        f"SELECT o.* REPLACE (coalesce(n.text, o.text) AS text) FROM {source} o "
        f"LEFT JOIN ({_without_names_sql(source)}) n USING (doc_id)"
    )


def _full_sql(final: str) -> str:
    return sql.chain(
        f"SELECT doc_id, {EVERYTHING} AS text FROM ({_NAMED_SQL})",
        sql.nfc,
        _language_step,
        sql.strip_html,
        sql.collapse_space,
        sql.strip_control,
        sql.strip_nonprintable,
        sql.shrink_runs,
        sql.trim_text,
        _spelling_step("coalesce(lang_detected = 'en', true)"),
        _names_step,
        *[step for name, _, _, step in sql.REDACT_ALL if name != "replace_ip"],
        sql.drop_repeats,
        sql.null_short(1),
        final=final,
    )


def _full_input(spark: SparkSession, folder: str) -> DataFrame:
    return stage(_named(spark, folder).withColumn("text", F.expr(EVERYTHING)), "input")


def _full_cleaner(spark: SparkSession, folder: str) -> Cleaner:
    """All steps that are on by default, with the three tables they need."""
    return Cleaner(
        vocabulary=_vocabulary(spark, folder),
        language_model=_trained(spark, folder),
        gazetteer=_gazetteer(spark, folder),
    )


@register("clean_corpus_full", _full_sql("SELECT doc_id, text, lang_detected FROM {last}"))
def clean_corpus_full(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = _full_cleaner(spark, folder).transform(_full_input(spark, folder))
    return cleaned.select("doc_id", "text", "lang_detected")


@register("clean_keyless", _full_sql("SELECT text FROM {last}"))
def clean_keyless(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that hold nothing but a text."""
    lines = _write_lines(_full_input(spark, folder).select("text"), "keyless")
    docs = corpus.read_jsonl(spark, lines)
    return _full_cleaner(spark, folder).transform(docs).select("text")


@register("clean_duplicate_keys", _full_sql("SELECT doc_id % 7 AS doc_id, text FROM {last}"))
def clean_duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaner on a table whose key names many texts each."""
    docs = _full_input(spark, folder).withColumn("doc_id", F.col("doc_id") % 7)
    return _full_cleaner(spark, folder).transform(docs).select("doc_id", "text")


@register(
    "spell_then_redact",
    sql.chain(
        documents_sql(EVERYTHING),
        _spelling_step(),
        *[step for *_, step in sql.REDACT_ALL],
        final="SELECT doc_id, text FROM {last}",
    ),
)
def spell_then_redact(spark: SparkSession, folder: str) -> DataFrame:
    """Spelling in front of all rules: what a rule redacts must reach it unchanged."""
    config = replace(REDACTION_ONLY, spell_check=True)
    cleaner = Cleaner(config, vocabulary=_vocabulary(spark, folder))
    return cleaner.transform(documents(spark, folder, EVERYTHING)).select("doc_id", "text")


# --- findings and reports ---------------------------------------------------

_SPIKED_WITH_SOURCE = f"SELECT doc_id, {EVERYTHING} AS text, source FROM documents"


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return Cleaner(REDACTION_ONLY).transform(documents(spark, folder, EVERYTHING))


@register(
    "findings",
    sql.findings(
        _SPIKED_WITH_SOURCE,
        "SELECT doc_id, source, step, tag, original, replacement, pos FROM {found}",
    ),
)
def all_findings(spark: SparkSession, folder: str) -> DataFrame:
    return findings.explode_findings(_cleaned(spark, folder), ["doc_id", "source"])


@register(
    "audit_by_key",
    sql.findings(
        _SPIKED_WITH_SOURCE,
        "SELECT tag, replacement, original, count(*) AS n FROM {found} GROUP BY ALL",
    ),
)
def audit_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return findings.audit_by_key(all_findings(spark, folder))


@register(
    "audit_by_document",
    sql.findings(
        _SPIKED_WITH_SOURCE,
        "SELECT doc_id, tag || ':' || replacement AS key, tag, replacement, count(*) AS n, "
        "string_agg(original, '|' ORDER BY original) AS originals FROM {found} "
        "GROUP BY doc_id, tag, replacement",
    ),
)
def audit_by_document(spark: SparkSession, folder: str) -> DataFrame:
    audits = findings.audit_by_document(_cleaned(spark, folder), ["doc_id"])
    return audits.select("doc_id", F.explode("audit").alias("key", "entry")).select(
        "doc_id",
        "key",
        "entry.tag",
        "entry.replacement",
        F.size("entry.originals").cast("bigint").alias("n"),
        F.array_join(F.array_sort("entry.originals"), "|").alias("originals"),
    )


_REPORT_SQL = (
    "SELECT source, tag, count(*) AS changes, count(DISTINCT doc_id) AS texts "
    "FROM {found} GROUP BY source, tag"
)


@register("report_by_source", sql.findings(_SPIKED_WITH_SOURCE, _REPORT_SQL))
def report_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return findings.report_by_source(_cleaned(spark, folder))


@register("write_report", sql.findings(_SPIKED_WITH_SOURCE, _REPORT_SQL))
def write_report(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "report")
    report = report_by_source(spark, folder)
    corpus.write_report(report, path, source="source")
    schema = T.StructType([*report.schema.fields])
    return spark.read.schema(schema).json(path).select("source", "tag", "changes", "texts")


@register(
    "report_merged",
    sql.findings(
        f"SELECT doc_id, {EVERYTHING} AS text, source FROM documents",
        "SELECT source, tag, sum(n)::BIGINT AS changes, sum(texts)::BIGINT AS texts, "
        "true AS distinct_close, max(n)::BIGINT AS most_frequent FROM (SELECT source, tag, original, "
        "count(*) AS n, 0 AS texts FROM {found} GROUP BY ALL UNION ALL SELECT source, tag, NULL, 0, "
        "count(DISTINCT doc_id) FROM {found} GROUP BY ALL) GROUP BY source, tag",
    ),
)
def report_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs, each reported on its own, added up from what they stored.

    The number of different texts is a sketch's: it is held against the exact one, within four
    times its stated error.
    """
    path, originals = scratch_path(spark, "reports"), scratch_path(spark, "originals")
    cleaned = stage(_cleaned(spark, folder), "cleaned")
    for run in range(3):
        part = cleaned.filter(F.expr(f"substr(md5(cast(doc_id as string)), 1, 1) IN {RUN_DIGITS[run]}"))
        reports.store_report(reports.run_report(part, ["source"]), path, f"r{run}")
        reports.store_report(reports.original_counts(part, ["source"]), originals, f"r{run}")
    merged = reports.merged_report(
        reports.stored_reports(spark, path), ["source"], top=1, counts=reports.stored_reports(spark, originals)
    )
    # hashes of the texts are shuffled, once per tag, not the texts
    named = cleaned.filter(F.col("text").isNotNull()).withColumns(content_identity(F.col("text")))
    found = named.select("source", *IDENTITY, F.explode(F.array_distinct("findings.tag")).alias("tag"))
    exact = found.groupBy("source", "tag").agg(F.count_distinct(*IDENTITY).alias("exact"))
    off = F.abs(F.col("distinct_texts") - F.col("exact")) / F.col("exact")
    return merged.join(exact, ["source", "tag"]).select(
        "source", "tag", "changes", "texts",
        (off <= 4 * reports.distinct_error()).alias("distinct_close"),
        F.get("top_originals", F.lit(0))["count"].alias("most_frequent"),
    )


_CONFIG_SQL = sql.lit(json.dumps(asdict(REDACTION_ONLY)))


@register(
    "report_by_run",
    sql.findings(
        _SPIKED_WITH_SOURCE,
        f"SELECT {_CONFIG_SQL} AS config, true AS named, true AS in_time, tag, count(*) AS changes, "
        "count(DISTINCT doc_id) AS texts FROM {found} GROUP BY tag",
    ),
)
def report_by_run(spark: SparkSession, folder: str) -> DataFrame:
    """Who, where and when differ from run to run: they are there, and not before this call."""
    called = spark.range(1).select(F.current_timestamp()).first()[0].timestamp()
    run = corpus.run_header(spark, REDACTION_ONLY)
    report = findings.report_by_run(_cleaned(spark, folder), run)
    named = (F.length("run_user") > 0) & (F.length("platform") > 0)
    in_time = F.unix_micros("started") >= round(called * 1e6)
    return report.select(
        "config", named.alias("named"), in_time.alias("in_time"), "tag", "changes", "texts"
    )


# --- distinct texts ---------------------------------------------------------


def _all_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, benchmark items and turns under one key."""
    docs = documents(spark, folder).select(F.col("doc_id"), "text", "source")
    items = table(spark, folder, "benchmark").select(
        (F.col("item_id") + 1_000_000_000).alias("doc_id"), "text"
    )
    talk = table(spark, folder, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn") + 2_000_000_000).alias("doc_id"), "text"
    )
    return corpus.concat_results(docs, items, talk)


_ALL_TEXTS_SQL = (
    "SELECT doc_id, text, source FROM documents UNION ALL "
    "SELECT item_id + 1000000000, text, NULL FROM benchmark UNION ALL "
    "SELECT conv_id * 1000 + turn + 2000000000, text, NULL FROM conversations"
)
_FIRST_SQL = "row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"


@register(
    "dedupe_texts",
    f"SELECT doc_id, text, source FROM ({_ALL_TEXTS_SQL}) QUALIFY {_FIRST_SQL}",
)
def dedupe_texts(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.dedupe_texts(_all_texts(spark, folder))


@register(
    "dedupe_incremental",
    f"SELECT doc_id, text, CASE WHEN doc_id < 1000000000 THEN 'documents' WHEN doc_id < 2000000000 "
    f"THEN 'benchmark' ELSE 'conversations' END AS run FROM ({_ALL_TEXTS_SQL}) QUALIFY {_FIRST_SQL}",
)
def dedupe_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs one after the other; together they keep what one run over all would keep."""
    texts = _all_texts(spark, folder).select("doc_id", "text")
    known = seen.SeenTexts(spark, scratch_path(spark, "seen"))
    edges = {"documents": 0, "benchmark": 1_000_000_000, "conversations": 2_000_000_000}
    parts = [
        known.first_sights(
            texts.filter(F.col("doc_id").between(start, start + 999_999_999)), run
        ).withColumn("run", F.lit(run))
        for run, start in edges.items()
    ]
    known.forget()
    return corpus.concat_results(*parts)


_IP_FINDINGS_SQL = (
    "SELECT doc_id, 'replace_ip' AS step, 'IPV4' AS tag, h AS original, "
    f"'{rules.TOKENS['IPV4']}' AS replacement, CAST(p - 1 AS INTEGER) AS pos FROM (SELECT doc_id, "
    "unnest(hits) AS h, generate_subscripts(hits, 1) AS p FROM (SELECT doc_id, "
    f"regexp_extract_all(text, {sql.lit(sql.IPV4)}) AS hits FROM documents))"
)


@register(
    "dedupe_report",
    sql.chain(
        documents_sql(),
        sql.ipv4,
        final=f"SELECT * FROM ({_IP_FINDINGS_SQL}) WHERE doc_id IN "
        f"(SELECT doc_id FROM {{last}} QUALIFY {_FIRST_SQL})",
    ),
)
def dedupe_report(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that differ only in what was redacted count as one."""
    config = CleanConfig(
        replace_ip=True,
        **_OFF,
        **dict.fromkeys(
            (
                "replace_profanity",
                "replace_uuid",
                "replace_mac",
                "replace_timestamp",
                "replace_filepath",
                "replace_ssn",
                "replace_cc",
                "anonymize_pii",
            ),
            False,
        ),
    )
    _, kept_findings = Cleaner(config).clean_distinct(documents(spark, folder))
    return kept_findings


# --- streams ----------------------------------------------------------------


def _streamed_documents(spark: SparkSession, folder: str, spike: str) -> DataFrame:
    lines = _write_lines(documents(spark, folder, spike), "incoming")
    return jobs.read_stream(spark, lines, files_per_batch=4)


@register("stream_clean", sql.redact_all(documents_sql(EVERYTHING)))
def stream_clean(spark: SparkSession, folder: str) -> DataFrame:
    out, state = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    stream = _streamed_documents(spark, folder, EVERYTHING)
    jobs.stream_clean(stream, Cleaner(REDACTION_ONLY), out, state).awaitTermination()
    return spark.read.schema("doc_id bigint, text string").parquet(out)


@register("stream_clean_batches", sql.redact_all(documents_sql(EVERYTHING)))
def stream_clean_batches(spark: SparkSession, folder: str) -> DataFrame:
    out, state = scratch_path(spark, "batches"), scratch_path(spark, "batches-state")
    stream = _streamed_documents(spark, folder, EVERYTHING)
    jobs.stream_clean_batches(stream, Cleaner(REDACTION_ONLY), out, state).awaitTermination()
    return spark.read.schema("doc_id bigint, text string, batch int").parquet(out).drop("batch")


@register(
    "stream_dedupe",
    "SELECT min(doc_id) AS doc_id, text, sha256(text) AS text_hash FROM documents "
    "WHERE text IS NOT NULL GROUP BY text",
)
def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Texts let through once, and those whose window is still open when the files end."""
    path = _write_lines(documents(spark, folder), "incoming")

    def timed(df: DataFrame) -> DataFrame:
        return df.withColumn("arrived", F.timestamp_seconds(F.col("doc_id") + 1_700_000_000))

    stored = timed(spark.read.schema(corpus.CORPUS_SCHEMA).json(path))
    out, state = scratch_path(spark, "distinct"), scratch_path(spark, "distinct-state")
    stream = timed(jobs.read_stream(spark, path, files_per_batch=4))
    distinct = jobs.dedupe_stream(stream, "arrived", jobs.replay_delay(stored, "arrived"))
    jobs.write_stream(distinct, out, state).awaitTermination()
    columns = ["doc_id", "text"]
    passed = spark.read.schema(distinct.schema).parquet(out).select(*columns, "text_hash")
    return passed.unionByName(jobs.open_texts(spark, state, columns))


_EVENT_TEXT = (
    "concat(event_type, ' from 10.', cast(user_id % 250 as string), '.0.', "
    "cast(event_id % 250 as string), ' mail u', cast(user_id as string), '@example.com')"
)


@register(
    "stream_report",
    "SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, "
    "tag, count(*) AS changes FROM events CROSS JOIN (VALUES ('IPV4'), ('EMAIL')) AS v(tag) GROUP BY ALL",
)
def stream_report(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly counts: the windows written, and those still open when the files end."""
    rows = table(spark, folder, "events").select(
        F.col("event_id").alias("doc_id"), F.expr(_EVENT_TEXT).alias("text"), F.col("ts").cast("timestamp")
    )
    incoming = scratch_path(spark, "events")
    rows.write.parquet(incoming)
    delay = jobs.replay_delay(spark.read.schema(rows.schema).parquet(incoming), "ts")
    out, state = scratch_path(spark, "hours"), scratch_path(spark, "hours-state")
    stream = jobs.read_stream(spark, incoming, rows.schema, "parquet")
    cleaned = Cleaner(REDACTION_ONLY).transform(stream)
    report = jobs.report_stream(cleaned, "ts", delay)
    jobs.write_stream(report, out, state).awaitTermination()
    hours = spark.read.schema(report.schema).parquet(out)
    return hours.unionByName(jobs.open_windows(spark, state)).select(
        F.col("window_start").cast("timestamp_ntz"),
        F.col("window_end").cast("timestamp_ntz"),
        "tag",
        "changes",
    )
