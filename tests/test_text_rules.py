"""One row per rule and quirk."""

import hashlib
import hmac
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from scrubwell import rules
from scrubwell.functions import hashing, lengths, normalize, predicates, redact, repeats, text


def applied(rule_list):
    def run(column):
        for rule in rule_list:
            column = rule.apply(column)
        return column

    return run


NORMALIZE = [
    (normalize.normalize_nfc, "e\u0301", "\u00e9"),
    (normalize.normalize_nfc, None, None),
    (normalize.strip_html, "<p>a</p>", "[HTML_REDACTED]a[HTML_REDACTED]"),
    (normalize.collapse_space, "a \t\n b", "a b"),
    (normalize.collapse_space, "a\u00a0\u2003\x1cb", "a b"),
    (normalize.collapse_space, "a  `x`  b", "a  `x`  b"),
    (normalize.strip_control, "a\x00b\x85c\td", "abc\td"),
    (normalize.strip_control, "`a\x00`", "`a\x00`"),
    (normalize.strip_nonprintable, "x\u00ady z\n", "xy z"),
    (normalize.shrink_runs, "aaaaa bbbbb", "aaaa bbbb"),
    (normalize.shrink_runs, "aaaa", "aaaa"),
    (normalize.shrink_runs, "\n\n\n\n\n\n", "\n\n\n\n\n\n"),
    (normalize.trim_text, "\u00a0 a b\n", "a b"),
    (normalize.strip_code, "run `ls` now", "run [CODE_REDACTED] now"),
    (normalize.strip_code, "```a\nb``` `c`", "[CODE_REDACTED] [CODE_REDACTED]"),
    (normalize.repair_mojibake, "donâ€™t cafÃ©", "don\u2019t caf\u00e9"),
    (normalize.repair_mojibake, "`Ã©`", "`Ã©`"),
    (normalize.repair_mojibake, "é¿ Ãx stay", "é¿ Ãx stay"),
    (text.has_code, "one ` only", False),
    (text.has_code, "``` two", True),
]


@pytest.mark.parametrize("function, given, expected", NORMALIZE)
def test_normalize(change, function, given, expected):
    assert change(function, given) == [expected]


REDACT = [
    (redact.profanity(), "Damn, dams", "[PROFANITY_REDACTED], dams"),
    (redact.profanity(()), "damn", "damn"),
    (redact.ipv4(), "10.20.30.140", "[IPV4_REDACTED]"),
    (redact.ipv4(gate="reference"), "10.20.30.140", "10.20.30.140"),
    (redact.ipv6(), "add the face at 22 be fe80::1", "add the face at 22 be [IPV6_REDACTED]"),
    (redact.ipv6(), "1:2:3:4:5:6:7:8 12:34:56", "[IPV6_REDACTED] 12:34:56"),
    (
        redact.ipv6(gate="reference"),
        "add the face at 22",
        "[IPV6_REDACTED] the [IPV6_REDACTED] at [IPV6_REDACTED]",
    ),
    (redact.uuid(), "6ba7b810-9dad-11d1-80b4-00c04fd430c8", "[UUID_REDACTED]"),
    (redact.uuid(), "6ba7b810-9dad-71d1-80b4-00c04fd430c8", "6ba7b810-9dad-71d1-80b4-00c04fd430c8"),
    (redact.mac(), "00:1A:2B:3C:4D:EF", "[MAC_REDACTED]"),
    (redact.mac(gate="reference"), "00:1A:2B:3C:4D:EF", "[MAC_REDACTED]"),
    (
        redact.timestamp(),
        "at 2024-01-02T03:04:05Z or 9:30",
        "at [TIMESTAMP_REDACTED] or [TIMESTAMP_REDACTED]",
    ),
    (redact.filepath(), "see /etc/hosts", "see [PATH_REDACTED]"),
    (redact.filepath(), "C:\\a b\\c.txt", "[PATH_REDACTED]"),
    (redact.ssn(), "123-45-6789", "[SSN_REDACTED]"),
    (redact.ssn(gate="reference"), "123-45-6789", "123-45-6789"),
    (redact.credit_card(), "4111 1111 1111 1111", "[CREDIT_CARD_REDACTED]"),
    (redact.credit_card(), "4111111111111112", "4111111111111112"),
    (
        redact.credit_card(),
        "4111111111111112 x 4111111111111111",
        "4111111111111112 x [CREDIT_CARD_REDACTED]",
    ),
    (redact.url(), 'go HTTPS://a.b/c"d www.x.y', 'go [URL_REDACTED]"d [URL_REDACTED]'),
    (redact.email(), "a.b@x.io", "[EMAIL_REDACTED]"),
    (redact.email(), "/a@x.io", "/a@x.io"),
    (redact.phone(), "+1 (663) 555-6869", "<PHONE>"),
    (redact.phone(), "5551234567", "5551234567"),
    (redact.phone(), "4111111111111111", "4111111111111111"),
    (redact.phone(), "2023-10-05", "2023-10-05"),
    (redact.phone(), "555-12-345", "555-12-345"),
    (redact.phone(), "call: 555-123-4567", "call:<PHONE>"),
    (redact.phone(), "152.143.123.131", "152.143.123.131"),
    (redact.phone(), "70.23.22.57", "70.23.22.57"),
    (redact.phone(), "13.149.130.89", "<PHONE>"),
    (redact.phone(), "123-45-6789", "<PHONE>"),
    (redact.phone(), "é555123-4567", "é555123-4567"),
    (redact.pii_removal(), "a@b.co, https://x.y 555-123-4567!", ",!"),
    (redact.currency(), "10 USD", "[CURRENCY_REDACTED]"),
    (redact.currency(), "1,000", "[CURRENCY_REDACTED]"),
    (redact.currency(), "pay $1,234.50 now", "pay [CURRENCY_REDACTED] now"),
    (redact.candidate_currency(), "5551234567", "<CURRENCY>"),
]


@pytest.mark.parametrize("rule_list, given, expected", REDACT)
def test_redact(change, rule_list, given, expected):
    assert change(applied(rule_list), given) == [expected]


def test_tokens_are_not_matched_again(change):
    """No rule matches its own token, so each rule can run twice."""
    for rule_list, given, expected in REDACT:
        if rule_list and all(rule.gate == "none" for rule in rule_list):
            assert change(applied(rule_list), expected) == [expected]


def test_pseudonym_is_hmac(change):
    for key in ("k", "x" * 100):
        digest = hmac.new(key.encode(), b"a@b.co", hashlib.sha256).hexdigest()
        assert change(applied(redact.email(key=key)), "to a@b.co a@b.co") == [
            f"to [EMAIL_HASH_{digest[:16]}] [EMAIL_HASH_{digest[:16]}]"
        ]
    plain = hashlib.sha256("é".encode()).hexdigest()[:16]
    assert change(lambda c: hashing.pseudonym(c, "X", None), "é") == [f"[X_HASH_{plain}]"]


def test_gaps_and_hits_rebuild_the_text(change):
    given = ["a 10.0.0.1 b 10.0.0.2", "10.0.0.1", "none", ""]
    assert change(lambda c: text.replace_matches(c, rules.IPV4, lambda h: h), *given) == given


def test_long_paths_do_not_overflow_the_stack(change):
    path = "/a" * 100_000
    assert change(applied(redact.filepath()), path) == ["[PATH_REDACTED]"]
    windows = "C:\\" + "a\\" * 100_000
    assert change(applied(redact.filepath()), windows) == ["[PATH_REDACTED]"]


def test_nfc_guard_misses_no_character(spark):
    """Every character whose NFC form depends on more than itself is a suspect."""
    suspects = {
        row.id
        for row in spark.range(0, 0x110000)
        .filter("id not between 55296 and 57343")
        .withColumn("bytes", F.unhex(F.lpad(F.hex("id"), 8, "0")))
        .withColumn("char", F.decode("bytes", "UTF-32"))
        .filter(F.col("char").rlike(rules.NFC_SUSPECT))
        .select("id")
        .collect()
    }
    for code in range(0x110000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        alone = unicodedata.normalize("NFC", char) != char
        joins = unicodedata.combining(char) or 0x1161 <= code <= 0x11C2
        if alone or joins:
            assert code in suspects, hex(code)


@pytest.mark.parametrize(
    "candidate, date, currency, phone",
    [
        ("2023/1/5", True, False, False),
        ("(31-12-98)", True, False, True and False),
        ("20231005", True, True, True),
        ("2023", True, True, False),
        ("$5", False, True, False),
        ("12 eur", False, True, False),
        ("1.000,00", False, False, False),
        ("555-123-4567", False, False, True),
    ],
)
def test_predicates(change, candidate, date, currency, phone):
    assert change(predicates.is_date_like, candidate) == [date]
    assert change(predicates.is_currency_like, candidate) == [currency]
    assert change(predicates.is_phone_like, candidate) == [phone]
    assert change(predicates.is_possible_other, candidate) == [date or currency or phone]


def test_luhn_length(change):
    assert change(predicates.is_luhn_valid, "4111-1111-1111-1111", "0" * 12, "0" * 20) == [
        True,
        False,
        False,
    ]


@pytest.mark.parametrize(
    "limit, given, expected",
    [
        (5, "One two. Three four five. Six.", "One two. Three four five."),
        (4, "One two. Three four five. Six.", "One two."),
        (2, "one two three four.", "one two"),
        (9, "short  text", "short  text"),
    ],
)
def test_truncate_tokens(change, limit, given, expected):
    assert change(lambda c: lengths.truncate_tokens(c, limit), given) == [expected]


def test_lengths(change):
    assert change(lambda c: lengths.null_short(c, 1), "", "a", None) == [None, "a", None]
    assert change(lambda c: lengths.truncate_chars(c, 4), "abc def", "é") == ["abc", "é"]


@pytest.mark.parametrize(
    "gap, given, expected",
    [
        (2, "the the cat sat.", "the cat sat."),
        (2, "go go", "go"),
        (2, "Hi. Hi. Bye.", "Hi. Bye."),
        (2, "", ""),
        (2, "`a a`", "`a a`"),
        (3, "a x a y a", "a x y"),
        (3, "`a x a`", "`a x a`"),
        (1, "a a", "a a"),
    ],
)
def test_drop_repeats(change, gap, given, expected):
    assert change(lambda c: repeats.drop_repeats(c, gap), given) == [expected]


def brute_force_thin(words, gap):
    """The stated rule, word by word and pass by pass."""
    words = list(words)
    while True:
        for word in dict.fromkeys(words):
            at = [i for i, other in enumerate(words) if other == word]
            close = [i for j, i in enumerate(at) if j and i - at[j - 1] < gap]
            if close:
                for i in reversed(close):
                    words.pop(i)
                break
        else:
            return words


@pytest.mark.parametrize("gap", [2, 3, 4])
def test_drop_repeats_equals_brute_force(change, gap):
    rng = random.Random(gap)
    given = [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    got = change(lambda c: repeats.drop_repeats(c, gap), *given)
    assert got == [" ".join(brute_force_thin(line.split(" "), gap)) for line in given]


def test_splits(change):
    assert change(text.sentences, "A b.  C? D") == [["A b.", "C?", "D"]]
    assert change(text.tokens, " a\u00a0b ") == [["a", "b"]]
    assert change(text.space_tokens, "a  b") == [["a", "", "b"]]
    assert change(text.pieces, "Hé, it's 5") == [["Hé", ",", " ", "it", "'", "s", " ", "5"]]
    grams = change(lambda c: text.character_grams(c, 3), "ab😀d", "ab")
    assert grams == [["ab😀", "b😀d"], []]


def test_splice(spark):
    row = spark.sql(
        "select array('a',' ','b',' ','c') parts,"
        " array(named_struct('pos',0,'len',1,'token','X'), named_struct('pos',2,'len',2,'token','Y')) edits"
    )
    assert row.select(text.splice(F.col("parts"), F.col("edits")).alias("t")).first().t == "X Yc"


def test_pattern_tables_are_plain():
    assert re.fullmatch(r"[a-z]+", "".join(rules.PROFANITY))
    assert len(rules.CP1252_MARKS) == len(rules.CP1252_BYTES)
