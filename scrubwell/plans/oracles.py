"""The same results stated in DuckDB SQL, for checking.

RE2 has no look-around and its ``\\b`` and ``\\s`` know ASCII only, so a few
rules are stated another way than in the Spark job; that also makes them an
independent check.
"""

from __future__ import annotations

from collections.abc import Callable

from scrubwell import rules

SYMBOL = f"[{rules.CURRENCY_SYMBOLS}]"
CODES = "(?:" + "|".join(rules.CURRENCY_CODES) + ")"
WORD_CHAR = r"[\p{L}\p{N}_]"
SPACE = r"[\s\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def replace_all(text: str, pattern: str, token: str) -> str:
    return f"regexp_replace({text}, {lit(pattern)}, {lit(token)}, 'g')"


def has_code(text: str = "text") -> str:
    return f"regexp_matches({text}, {lit(rules.CODE_INLINE)})"


# A step turns the name of a table into a SELECT that keeps its other columns.
Step = Callable[[str], str]


def rewrite(expression: str) -> Step:
    return lambda source: f"SELECT * REPLACE ({expression} AS text) FROM {source}"


def substitute(pattern: str, token: str) -> Step:
    return rewrite(replace_all("text", pattern, token))


def unless_code(expression: str) -> Step:
    return rewrite(f"CASE WHEN {has_code()} THEN text ELSE {expression} END")


def chain(base: str, *steps: Step, final: str = "SELECT * FROM {last}") -> str:
    """``base``, then every step in a WITH clause of its own."""
    parts = [f"t0 AS MATERIALIZED ({base})"]
    for number, step in enumerate(steps, 1):
        parts.append(f"t{number} AS MATERIALIZED ({step(f't{number - 1}')})")
    return "WITH " + ",\n".join(parts) + "\n" + final.replace("{last}", f"t{len(steps)}")


def strip(text: str) -> str:
    return f"regexp_replace({text}, {lit(f'^{SPACE}+|{SPACE}+$')}, '', 'g')"


def digits(text: str) -> str:
    return f"regexp_replace({text}, '\\D', '', 'g')"


def is_date_like(candidate: str) -> str:
    bare = f"trim({strip(candidate)}, '()[]\"''')"
    return (
        f"(regexp_matches({bare}, '^\\s*\\d{{4}}[-/]\\d{{1,2}}[-/]\\d{{1,2}}\\s*$')"
        f" OR regexp_matches({bare}, '^\\s*\\d{{1,2}}[-/]\\d{{1,2}}[-/]\\d{{2,4}}\\s*$')"
        f" OR length({digits(bare)}) = 8"
        f" OR regexp_matches({bare}, '^\\s*\\d{{4}}\\s*$'))"
    )


AMOUNT = (
    rf"^\s*{SYMBOL}?\s*-?(?:\d{{1,3}}(?:[,.\s]\d{{3}})+|\d+(?:[.,]\d+)?)"
    rf"\s*{SYMBOL}?(?:\s*{CODES})?\s*$"
)


def is_amount(candidate: str) -> str:
    return f"regexp_matches({candidate}, {lit(AMOUNT)})"


def is_currency_like(candidate: str) -> str:
    bare = strip(candidate)
    return (
        f"(regexp_matches({bare}, {lit(SYMBOL)})"
        f" OR regexp_matches({bare}, {lit(rf'(?i)\b{CODES}\b')})"
        f" OR {is_amount(bare)}"
        f" OR regexp_matches({bare}, {lit(rf'(?i)\b\d[\d,.]*\s*{CODES}\b')}))"
    )


def is_phone_like(candidate: str) -> str:
    return f"(length({digits(candidate)}) >= 7)"


def is_phone(candidate: str) -> str:
    return (
        f"({is_phone_like(candidate)} AND NOT {is_date_like(candidate)}"
        f" AND NOT {is_currency_like(candidate)})"
    )


def luhn_valid(candidate: str) -> str:
    number = digits(candidate)
    weighted = (
        f"list_transform(string_split(reverse({number}), ''), lambda d, i: "
        "CASE WHEN i % 2 = 0 THEN (CAST(d AS INTEGER) * 2) % 10 + (CAST(d AS INTEGER) * 2) // 10 "
        "ELSE CAST(d AS INTEGER) END)"
    )
    return (
        f"(CASE WHEN length({number}) BETWEEN 13 AND 19 "
        f"THEN list_sum({weighted}) % 10 = 0 ELSE false END)"
    )


def per_match(pattern: str, change: str) -> Step:
    """Replace each match ``h`` by the SQL expression ``change``."""

    def step(source: str) -> str:
        return (
            "SELECT * EXCLUDE (gaps, hits) REPLACE (array_to_string(list_transform(gaps, "
            f"lambda g, i: g || CASE WHEN i <= len(hits) THEN hits[i] ELSE '' END), '') AS text) "
            f"FROM (SELECT * REPLACE (list_transform(hits, lambda h: {change}) AS hits) FROM "
            f"(SELECT *, string_split_regex(text, {lit(pattern)}) AS gaps, "
            f"regexp_extract_all(text, {lit(pattern)}) AS hits FROM {source}))"
        )

    return step


# --- fixed values: the patterns of ``rules.py`` in the dialect of RE2, which has no look-around ---
IPV6 = r"\b[0-9a-fA-F:]{2,45}\b"
IS_IPV6 = (
    "(regexp_matches(h, '^([0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}$') OR contains(h, '::'))"
)
CREDIT_CARD = r"\b(?:\d[ -]*?){13,16}\b"
IPV4 = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
UUID = (
    r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-5][0-9a-fA-F]{3}"
    r"-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}\b"
)
MAC = r"\b(?:[0-9A-Fa-f]{2}[:-]){5}(?:[0-9A-Fa-f]{2})\b"
SSN = r"\b\d{3}-\d{2}-\d{4}\b"
TIMESTAMP = (
    r"\b\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:?\d{2})?\b"
)
TIME = r"\b\d{1,2}:\d{2}(?::\d{2})?\b"
PATH_WINDOWS = r"[A-Za-z]:\\(?:[^\\/:*?\"<>|\r\n]+\\)*[^\\/:*?\"<>|\r\n]*"
PATH_UNIX = r"(?:/[\p{L}\p{N}_\-.]+)+/?"
URL = r"(?i)(?:(?:https?|ftp)://|www\.)[^\s<>\"]+"
EMAIL = r"(?i)(^|[^/\p{L}\p{N}_.\-])([a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,})"
# Letters stand next to some words of the list in running text, so whole words
# are found by their neighbours.
PROFANITY = (
    rf"(?i)(^|[^\p{{L}}\p{{N}}_])(?:{'|'.join(sorted(rules.PROFANITY))})($|[^\p{{L}}\p{{N}}_])"
)

nfc = rewrite("nfc_normalize(text)")
strip_html = substitute(r"<[^>]+>", rules.TOKENS["HTML"])
collapse_space = unless_code(replace_all("text", SPACE + "+", " "))
strip_control = unless_code(
    replace_all("text", r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{80}-\x{9F}]", "")
)
strip_nonprintable = substitute(
    r"[\p{Cc}\p{Cf}\p{Co}\p{Zl}\p{Zp}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]", ""
)
trim_text = rewrite(strip("text"))
ipv4 = substitute(IPV4, rules.TOKENS["IPV4"])
ipv6 = per_match(IPV6, f"CASE WHEN {IS_IPV6} THEN {lit(rules.TOKENS['IPV6'])} ELSE h END")
uuid = substitute(UUID, rules.TOKENS["UUID"])
mac = substitute(MAC, rules.TOKENS["MAC"])
ssn = substitute(SSN, rules.TOKENS["SSN"])
credit_card = per_match(
    CREDIT_CARD, f"CASE WHEN {luhn_valid('h')} THEN {lit(rules.TOKENS['CC'])} ELSE h END"
)
timestamp_iso = substitute(TIMESTAMP, rules.TOKENS["TIMESTAMP"])
time_simple = substitute(TIME, rules.TOKENS["TIMESTAMP"])
path_windows = substitute(PATH_WINDOWS, rules.TOKENS["PATH"])
path_unix = substitute(PATH_UNIX, rules.TOKENS["PATH"])
url = substitute(URL, rules.TOKENS["URL"])
email = substitute(EMAIL, r"\1" + rules.TOKENS["EMAIL"])
# Two neighbours share the character between them, so the rule is run twice.
profanity = rewrite(
    replace_all(
        replace_all("text", PROFANITY, r"\1" + rules.TOKENS["PROFANITY"] + r"\2"),
        PROFANITY,
        r"\1" + rules.TOKENS["PROFANITY"] + r"\2",
    )
)
code_fence = substitute(r"```(?:[\s\S]*?)```", rules.TOKENS["CODE"])
code_inline = substitute(r"`[^`]*`", rules.TOKENS["CODE"])


def shrink_runs(source: str) -> str:
    same = " AND ".join(f"chars[i - {back}] = c" for back in range(1, 5))
    kept = f"list_filter(chars, lambda c, i: NOT (i > 4 AND c <> chr(10) AND {same}))"
    return (
        f"SELECT * EXCLUDE (chars) REPLACE (array_to_string({kept}, '') AS text) "
        f"FROM (SELECT *, string_split(text, '') AS chars FROM {source})"
    )


def phone(token: str = rules.TOKENS["PHONE"], decide: str | None = None) -> Step:
    """Cut the text into runs of phone characters and the rest.

    A run holds at most one candidate: it starts where the character before is
    no word character and ends at the last digit not followed by one.
    ``decide`` is the expression for a candidate ``c.cand``.
    """
    cut = r"\+?[\d\-.\s()]+|[^\d\-.\s()+]+|\+"
    is_run = r"regexp_matches(s, '^\+?[\d\-.\s()]+$')"
    after_word = f"regexp_matches(segs[i - 1], '{WORD_CHAR}$')"
    before_word = f"regexp_matches(segs[i + 1], '^{WORD_CHAR}')"
    start = (
        f"CASE WHEN coalesce({after_word}, false) THEN "
        "CASE WHEN starts_with(s, '+') THEN 2 "
        "ELSE length(regexp_extract(s, '^\\d*')) + 2 END ELSE 1 END"
    )
    body = (
        f"CASE WHEN coalesce({before_word}, false) "
        "THEN regexp_replace(s, '\\d+$', '') ELSE s END"
    )
    candidate = r"'^\+?[\d\-.\s()]{6,}\d'"
    decision = decide or f"CASE WHEN {is_phone('c.cand')} THEN {lit(token)} ELSE c.cand END"

    def step(source: str) -> str:
        return (
            "SELECT * EXCLUDE (cuts) REPLACE (array_to_string(list_transform(cuts, lambda c: "
            "CASE WHEN c.cand <> '' THEN substr(c.s, 1, c.at - 1) || "
            f"({decision}) || substr(c.s, c.at + length(c.cand)) ELSE c.s END), '') AS text) FROM ("
            "SELECT * EXCLUDE (segs), list_transform(segs, lambda s, i: CASE WHEN "
            f"{is_run} THEN {{'s': s, 'at': {start}, "
            f"'cand': regexp_extract(substr({body}, {start}), {candidate})}} "
            "ELSE {'s': s, 'at': 1, 'cand': ''} END) AS cuts FROM ("
            f"SELECT *, regexp_extract_all(text, {lit(cut)}) AS segs FROM {source}))"
        )

    return step


def currency(source: str) -> str:
    number = r"(?:\d{1,3}(?:[,.\s]\d{3})+(?:[.,]\d{1,2})?|\d+(?:[.,]\d+)?)"
    token = rules.TOKENS["CURRENCY"]
    text = replace_all("text", AMOUNT, token)
    text = replace_all(
        text,
        rf"{SYMBOL}\s*-?{number}(?:\s*{CODES}\b)?",
        token,
    )
    text = replace_all(
        text, rf"(^|[^\p{{L}}\p{{N}}_.,])-?{number}(?:\s*{SYMBOL}|\s*{CODES}\b)", r"\1" + token
    )
    text = replace_all(text, rf"(?i)\b{CODES}\b", token)
    text = replace_all(text, SYMBOL, token)
    return f"SELECT * REPLACE ({text} AS text) FROM {source}"


def sentence_list(text: str) -> str:
    marked = f"regexp_replace({text}, {lit(f'([.?!]){SPACE}+')}, '\\1' || chr(2), 'g')"
    return f"string_split({marked}, chr(2))"


def _rebuilt(source: str, body: str, keep: str) -> str:
    """Texts put together again from their kept sentences."""
    return (
        "SELECT d.* REPLACE (CASE WHEN "
        f"{has_code('d.text')} THEN d.text ELSE coalesce(n.text, '') END AS text) "
        f"FROM {source} d LEFT JOIN (SELECT doc_id, string_agg({body}, ' ' ORDER BY pos) AS text "
        "FROM (SELECT *, lag(sentence) OVER (PARTITION BY doc_id ORDER BY pos) AS before, "
        "CASE WHEN regexp_matches(sentence, '[.?!]$') THEN string_split(left(sentence, -1), ' ') "
        "ELSE string_split(sentence, ' ') END AS words, "
        "regexp_extract(sentence, '[.?!]$') AS closing "
        "FROM (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS pos "
        f"FROM (SELECT doc_id, {sentence_list('text')} AS s FROM {source})) "
        f"WHERE regexp_matches(sentence, '\\S')) {keep} GROUP BY doc_id) n USING (doc_id)"
    )


_DISTINCT_WORDS = (
    "array_to_string(list_filter(words, lambda w, i: i = 1 OR w <> words[i - 1]), ' ') || closing"
)
_DISTINCT_SENTENCES = "WHERE before IS NULL OR before <> sentence"


def dedupe_words(source: str) -> str:
    return _rebuilt(source, _DISTINCT_WORDS, "")


def dedupe_sentences(source: str) -> str:
    return _rebuilt(source, "sentence", _DISTINCT_SENTENCES)


def drop_repeats(source: str) -> str:
    return _rebuilt(source, _DISTINCT_WORDS, _DISTINCT_SENTENCES)


def _thinned(name: str, base: str, gap: int) -> str:
    """CTEs ``name``: lists ``w`` of ``base`` (``doc_id, nth, w``) after all deletion rounds.

    A round marks the places whose value also stands within the ``gap - 1`` places
    before, and deletes the marked places of the value that begins first.
    """
    near = f"list_contains(w[greatest(1, i - {gap - 1}):i - 1], w[i])"
    marked = f"list_filter(range(1, len(w) + 1), lambda i: {near})"
    value = "w[list_min(list_transform(m, lambda i: list_position(w, w[i])))]"
    kept = "list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT (w[i] = v AND list_contains(m, i))), lambda i: w[i])"
    return f"""{name}_rounds AS (
      SELECT doc_id, nth, w, {marked} AS m FROM {base}
      UNION ALL
      SELECT doc_id, nth, w, {marked} AS m FROM (
        SELECT doc_id, nth, {kept} AS w FROM (
          SELECT *, {value} AS v FROM {name}_rounds WHERE len(m) > 0))
    ), {name} AS (SELECT doc_id, nth, w FROM {name}_rounds WHERE len(m) = 0)"""


def drop_repeats_wide(source: str, gap: int) -> str:
    """Repeats closer than ``gap``: sentences first, then the words of each sentence."""
    body = "regexp_replace(sentence, '[.?!]$', '')"
    return f"""
    WITH RECURSIVE whole AS (
      SELECT doc_id, 0 AS nth, list_filter({sentence_list('text')}, lambda s: regexp_matches(s, '\\S')) AS w
      FROM {source}
    ), {_thinned('fewer', 'whole', gap)},
    split AS (SELECT doc_id, unnest(w) AS sentence, generate_subscripts(w, 1) AS nth FROM fewer),
    worded AS (SELECT doc_id, nth, string_split({body}, ' ') AS w FROM split),
    {_thinned('thin', 'worded', gap)},
    put AS (
      SELECT doc_id, string_agg(array_to_string(w, ' ') || regexp_extract(sentence, '[.?!]$'), ' ' ORDER BY nth) AS text
      FROM thin JOIN split USING (doc_id, nth) GROUP BY doc_id
    )
    SELECT doc_id, CASE WHEN {has_code('d.text')} THEN d.text ELSE coalesce(put.text, '') END AS text
    FROM {source} d LEFT JOIN put USING (doc_id)"""


def null_short(minimum: int) -> Step:
    return rewrite(f"CASE WHEN length(text) >= {minimum} THEN text END")


# The rules in the order of the cleaner, with the pattern of their findings.
REDACT_ALL: list[tuple[str, str, str, Step]] = [
    ("replace_profanity", "PROFANITY", "", profanity),
    ("replace_ip", "IPV4", IPV4, ipv4),
    ("replace_ip", "IPV6", IPV6, ipv6),
    ("replace_uuid", "UUID", UUID, uuid),
    ("replace_mac", "MAC", MAC, mac),
    ("replace_timestamp", "TIMESTAMP", TIMESTAMP, timestamp_iso),
    ("replace_timestamp", "TIMESTAMP", TIME, time_simple),
    ("replace_filepath", "PATH", PATH_WINDOWS, path_windows),
    ("replace_filepath", "PATH", PATH_UNIX, path_unix),
    ("replace_ssn", "SSN", SSN, ssn),
    ("replace_cc", "CC", CREDIT_CARD, credit_card),
    ("anonymize_pii", "URL", URL, url),
    ("anonymize_pii", "EMAIL", "", email),
    ("anonymize_pii", "PHONE", "", phone()),
]


def redact_all(base: str, final: str = "SELECT doc_id, text FROM {last}") -> str:
    return chain(base, *[step for *_, step in REDACT_ALL], final=final)


def findings(base: str, final: str) -> str:
    """Findings of all rules: hits are read from the text each rule receives.

    ``final`` selects from ``{found}`` with
    ``doc_id, source, step, tag, original, replacement, pos``.
    """
    parts = []
    for number, (step, tag, pattern, _) in enumerate(REDACT_ALL):
        token = lit(rules.TOKENS[tag])
        if tag == "PHONE":
            cell = "'<' || chr(3) || c.cand || chr(3) || '>'"
            marked = phone(decide=cell)
            hits = "regexp_extract_all(text, '<\\x03([^\\x03]+)\\x03>', 1)"
            source = f"({marked(f't{number}')})"
            test = is_phone("h")
        elif tag == "EMAIL":
            hits, source, test = f"regexp_extract_all(text, {lit(EMAIL)}, 2)", f"t{number}", "true"
        elif tag == "PROFANITY":
            word = rf"(?i)\b(?:{'|'.join(sorted(rules.PROFANITY))})\b"
            hits, source, test = f"regexp_extract_all(text, {lit(word)})", f"t{number}", "true"
        else:
            hits, source = f"regexp_extract_all(text, {lit(pattern)})", f"t{number}"
            test = {"CC": luhn_valid("h"), "IPV6": IS_IPV6}.get(tag, "true")
        parts.append(
            f"SELECT doc_id, source, '{step}' AS step, '{tag}' AS tag, h AS original, "
            f"{token} AS replacement, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 "
            f"AS INTEGER) AS pos FROM (SELECT doc_id, source, "
            f"unnest(hits) AS h, generate_subscripts(hits, 1) AS p FROM (SELECT doc_id, source, "
            f"{hits} AS hits FROM {source})) WHERE {test}"
        )
    found = "(" + "\nUNION ALL\n".join(parts) + ")"
    return chain(base, *[step for *_, step in REDACT_ALL], final=final.replace("{found}", found))
