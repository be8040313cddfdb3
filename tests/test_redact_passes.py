"""Patterns turn places down early without losing a match, and a plain rule passes over a text once."""

import random

import pytest
from pyspark.sql import functions as F

from scrubwell import rules
from scrubwell.functions import predicates, redact
from scrubwell.plans.cleaner import Cleaner
from scrubwell.plans.catalog import REDACTION_ONLY

PIECES = (
    "a F f e 9 0 1 12 345 6789 : :: - . .. / \\ @ + ( ) ! ? % _ K é ſ İ ٣ ٤٥ 😀 x@y.co http://a damn ShIt ſhit crap "
    "C:\\a\\b /usr a.b@c.de 1.2.3.4 00:11:22:33:44:55 deadbeef- 2001:db8::1 1:2:3:4:5:6:7:8 123-45-6789 "
    "2024-01-02T03:04:05Z 12:34"
).split() + [" ", "  ", "\t", "\n", "\x1c", "\x85", "\xa0", "\u2003", "\u0301", "\xad", "\x07", "\x7f", "\u200b"]
WITHOUT = {
    rules.EMAIL: r"(?Ui)(?<![/\w.\-])[a-z0-9._%+\-]++@[a-z0-9.\-]+\.[a-z]{2,}",
    rules.IPV4: r"(?U)\b(?:\d{1,3}\.){3}\d{1,3}\b",
    rules.IPV6: r"(?U)\b[0-9a-fA-F:]{2,45}\b",
    rules.UUID: r"(?U)\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-5][0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}\b",
    rules.MAC: r"(?U)\b(?:[0-9A-Fa-f]{2}[:-]){5}(?:[0-9A-Fa-f]{2})\b",
    rules.SSN: r"(?U)\b\d{3}-\d{2}-\d{4}\b",
    rules.CREDIT_CARD: r"(?U)\b(?:\d[ -]*?){13,16}\b",
    rules.PATH_UNIX: r"(?U)(?:/[\w\-.]++)++/?+",
    rules.TIME_SIMPLE: r"(?U)\b\d{1,2}:\d{2}(?::\d{2})?\b",
    rules.CONTROL: r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]",
    rules.NONPRINTABLE: r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Z}&&[^ ]]",
    rules.PHONE_CANDIDATE: r"(?U)(?<!\w)(\+?[\d\-.\s()]{6,}\d)(?!\w)",
    redact.profanity_pattern(): r"(?Ui)\b(?:" + "|".join(sorted(rules.PROFANITY)) + r")\b",
}


@pytest.fixture(scope="module")
def mixed(texts):
    rng = random.Random(5)
    made = texts(*["".join(rng.choices(PIECES, k=rng.randint(0, 25))) for _ in range(3_000)])
    return made.cache()


def test_patterns_match_the_same(mixed):
    found = [
        F.count_if(F.regexp_extract_all("text", F.lit(new), F.lit(0)) != F.regexp_extract_all("text", F.lit(old), F.lit(0)))
        for new, old in WITHOUT.items()
    ]
    assert list(mixed.agg(*found).first()) == [0] * len(found)


def test_addresses_with_a_colon_are_all_addresses(mixed):
    new, old = (
        F.filter(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), predicates.is_ipv6)
        for pattern in (rules.IPV6_COLON, WITHOUT[rules.IPV6])
    )
    assert mixed.filter(new != old).count() == 0
    assert mixed.filter(F.size(new) > 0).count() > 100


def test_first_letters_follow_the_list(change):
    rule = redact.profanity(("übel", "dumm"))
    assert change(lambda c: rule[0].apply(c), "DUMM und Übel, dummer") == ["[PROFANITY_REDACTED] und [PROFANITY_REDACTED], dummer"]


def test_plain_rules_pass_over_a_text_once(spark, texts):
    cleaned = Cleaner(REDACTION_ONLY).transform(texts("a")).select("text")
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 3  # IPv6, cards and phone numbers: what is decided match by match
