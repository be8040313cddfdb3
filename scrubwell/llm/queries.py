"""The operators as queries over whole tables, and SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubwell.llm import (
    binary_records,
    byte_bpe,
    collocations,
    decontaminate,
    exact_dedup,
    html_extract,
    line_dedup,
    periodic_runs,
    pii,
    sharding,
    simhash,
    toxicity,
    url_filter,
)
from scrubwell.session import scratch_path
from scrubwell.sources.corpus import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 40
END_ID = 2  # closes every document of the binary files
# (verdict, host, path)
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def register(run):
    QUERIES[run.__name__] = run
    return run


@register
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, folder, "documents"))


@register
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(read_table(spark, folder, "documents"), SHARDS)


@register
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, folder, "documents"))


@register
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    told = line_dedup.drop_repeated_lines(read_table(spark, folder, "documents"))
    digest = F.sha2(F.col("kept_text").cast("binary"), 256)
    return told.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


@register
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_spans(read_table(spark, folder, "documents"))
    counts = [
        F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}")
        for kind in pii.KINDS[: pii.BASE_KINDS]
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.span_text("base").cast("binary"), 256).alias("base_sha256"),
        pii.span_text("spans").alias("spans"),
    )


@register
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (read_table(spark, folder, name) for name in ("documents", "labels"))
    return toxicity.toxicity(docs, labels)


@register
def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = read_table(spark, folder, "documents")
    return byte_bpe.tokenise(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@register
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return decontaminate.contamination(docs, read_table(spark, folder, "benchmark"))


@register
def op10_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.main_text(read_table(spark, folder, "pages"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: every tenth document by checksum gets a periodic tail, as the query fixes."""
    words = "filter(split(text, '[ \\\\x09-\\\\x0D]+'), w -> w <> '')"
    tail = F.expr(
        f"""element_at(transform(array(struct({words} AS w, crc32(cast(doc_id AS string)) div 10 AS g)),
          o -> element_at(transform(array(named_struct('w', o.w, 'g', o.g, 'n', size(o.w), 'a', o.g % size(o.w))),
            x -> array_join(transform(x.w, (word, i) -> if(i < x.a, word,
              x.w[int(x.a + (i - x.a) % (1 + (x.n - x.a) div (3 + x.g % 8)))])), ' ')), 1)), 1)"""
    )
    planted = (F.crc32(F.col("doc_id").cast("string")) % 10 == 0) & F.col("text").rlike(
        "[^ \\x09-\\x0D]"
    )
    return docs.select("doc_id", F.when(planted, tail).otherwise(F.col("text")).alias("text"))


@register
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_planted_periods(read_table(spark, folder, "documents"))
    longest = F.expr(
        "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS place, -r.period AS p)))"
    )
    listed = "array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')"
    found = periodic_runs.periodic_runs(docs).withColumn("top", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.expr("-top.place").alias("start"),
        F.col("top.length").alias("length"),
        F.expr("-top.p").alias("period"),
        F.expr("1000 * top.length div -top.p").alias("exponent_milli"),
        F.sha2(F.expr(listed).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@register
def op12_binary_records(spark: SparkSession, folder: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as lines:
        tokenizer = lines.read()
    files = scratch_path(spark, "records")
    binary_records.write_records(read_table(spark, folder, "documents"), files, tokenizer, END_ID)
    told = binary_records.read_records(spark, files)
    return told.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read_table(spark, folder, "documents"))


# --- SQL ----------------------------------------------------------------------
_UPPER, _LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower_sql(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


ORACLES["op3_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)
"""

ORACLES["op4_line_dedup"] = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), k AS (
  SELECT *, {lower_sql(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS key
  FROM l
), f AS (
  SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""

ORACLES["op8_url_filter"] = r"""
WITH s AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), u AS (
  SELECT page_id, """ + lower_sql(r"regexp_extract(rest, '^[^/?#]*', 0)") + r""" AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s
), r(verdict, rhost, rpath) AS (
  VALUES """ + ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES) + r"""
), b AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
    arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM u JOIN r ON starts_with(path, rpath) AND (host = rhost OR ends_with(host, '.' || rhost))
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN b USING (page_id)
"""

_WORDS = (
    "regexp_extract_all(" + lower_sql("coalesce(text, '')") + r", '[0-9a-z\x{80}-\x{10FFFF}]+')"
)
ORACLES["op9_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT item_id, least(10, len(w)) AS size, w,
    unnest(range(1, len(w) - least(10, len(w)) + 2)) AS pos FROM b WHERE len(w) > 0
), wins AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS win FROM bw
), sizes AS (SELECT DISTINCT size FROM wins),
dw AS (
  SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS pos
  FROM d, sizes WHERE len(w) >= size
), hits AS (
  SELECT doc_id, dw.size, pos, item_id
  FROM dw JOIN wins ON dw.size = wins.size AND win = array_to_string(list_slice(w, pos, pos + dw.size - 1), ' ')
), places AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _shard_sql() -> str:
    """Rendezvous hashing in SQL; CRC-32 is worked out byte by byte with its table."""
    mix = sharding.mix_sql
    high = mix("((doc_id >> 32) & 4294967295)")
    shards = ", ".join(f"({s}, {sharding.shard_hash(s)})" for s in range(SHARDS + 1))
    return f"""
WITH RECURSIVE bits(x, i, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT x, i + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END
  FROM bits WHERE i < 8
), codes AS (SELECT list(v ORDER BY x) AS code FROM bits WHERE i = 8),
h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS t, {high} AS high FROM documents),
d AS (
  SELECT doc_id, length(t) // 2 + 16 AS size,
    xor(4294967295, list_reduce(
      list_transform(range(0, length(t) // 2), lambda i: ('0x' || substr(t, 2 * i + 1, 2))::BIGINT),
      lambda a, b: xor(a >> 8, code[1 + (xor(a, b) & 255)]), 4294967295)) AS crc,
    {mix("xor(doc_id & 4294967295, high)")} AS record
  FROM h, codes
), bids AS (
  SELECT doc_id, size, crc, record, s, {mix("xor(record, c)")} * 64 + 63 - s AS bid
  FROM d, (VALUES {shards}) v(s, c)
), placed AS (
  SELECT doc_id, size, crc, record, arg_max(s, bid) FILTER (s < {SHARDS}) AS shard,
    arg_max(s, bid) AS grown FROM bids GROUP BY ALL
)
SELECT doc_id, size, crc AS text_crc32, 'key' AS law, shard,
  row_number() OVER (
    PARTITION BY shard ORDER BY {mix("xor(record, crc)")} % {sharding.BUCKETS}, doc_id, crc, size
  ) - 1 AS slot,
  grown AS grown_shard
FROM placed
"""


ORACLES["op2_sharding"] = _shard_sql()

_PIECES = r"string_split_regex(" + lower_sql("coalesce(text, '')") + r", '[.,;:!?\x0A-\x0D]')"
ORACLES["op13_collocations"] = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    regexp_extract_all(unnest({_PIECES}), '[^\x20\x09]+') AS w
  FROM documents
), totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang),
f AS (
  SELECT lang, phrase, k, count(*)::HUGEINT AS many FROM (
    SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase FROM (
      SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) r(k)
      WHERE len(w) >= k
    )
  ) GROUP BY ALL HAVING count(*) >= 100
), c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.many AS a, x.many AS l, y.many AS r, n, cut,
    (1000 * c.many * n) // (x.many * y.many) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, cut), ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, cut + 1, c.k), ' ')
  JOIN totals ON totals.lang = c.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), parts AS (
  SELECT lang, many, array_to_string(list_slice(w, s, s + size - 1), ' ') AS phrase FROM (
    SELECT *, unnest(range(1, k - size + 2)) AS s
    FROM (SELECT *, unnest(range(2, k)) AS size FROM c WHERE k > 2)
  )
), inside AS (SELECT lang, phrase, max(many) AS longer FROM parts GROUP BY ALL),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best b LEFT JOIN inside USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < 100 * a
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
  score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
