"""Redaction rules: which matches are taken and what replaces them."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubwell import rules
from scrubwell.functions.hashing import pseudonym
from scrubwell.functions.predicates import (
    is_currency_like,
    is_date_like,
    is_ipv6,
    is_luhn_valid,
    is_phone,
    is_phone_like,
    is_possible_other,
)
from scrubwell.functions.text import let, literal_replacement, matches, replace_matches


@dataclass(frozen=True)
class Rule:
    """A pattern, an optional test on each match, and the replacement.

    ``needs`` lists literals of which every match holds at least one; texts
    without them are passed over by a plain byte search.

    ``gate="reference"`` reproduces the all-or-nothing behaviour of the cleaner
    this package stands in for: a text is redacted only if its *first* match
    cannot be read as a phone number, an amount or a date, and then all its
    matches are.  ``gate="none"`` decides match by match.
    """

    tag: str
    pattern: str
    token: str | None = None
    accept: Callable[[Column], Column] | None = None
    key: str | None = None
    gate: str = "none"
    needs: tuple[str, ...] = ()

    @property
    def plain(self) -> bool:
        """Whether every match is replaced by the token: one pass over a text, its matches need not be known."""
        return not self.key and self.accept is None and self.gate == "none"

    def _held(self, text: Column) -> Column:
        return reduce(or_, [text.contains(literal) for literal in self.needs])

    def candidates(self, text: Column) -> Column:
        """All matches; NULL or empty where there are none."""
        found = matches(text, self.pattern)
        return F.when(self._held(text), found) if self.needs else found

    def _first_passes(self, candidates: Column) -> Column:
        first = F.get(candidates, F.lit(0))
        passes = ~is_possible_other(first)
        return passes & self.accept(first) if self.accept is not None else passes

    def accepted(self, candidates: Column) -> Column:
        """The matches that will be replaced, numbered from the left."""
        taken = candidates
        if self.gate == "reference":
            taken = F.when(self._first_passes(candidates), candidates)
        elif self.accept is not None:
            taken = F.filter(candidates, self.accept)
        return F.transform(
            taken, lambda hit, pos: F.struct(hit.alias("original"), pos.alias("pos"))
        )

    def replacement(self, hit: Column) -> Column:
        if self.key:
            return pseudonym(hit, self.tag, self.key)
        return F.lit(self.token)

    def _changed(self, hit: Column) -> Column:
        if self.gate == "reference" or self.accept is None:
            return self.replacement(hit)
        return F.when(self.accept(hit), self.replacement(hit)).otherwise(hit)

    def apply(self, text: Column, candidates: Column | None = None) -> Column:
        """The text with every accepted match replaced.

        ``candidates`` takes the matches where they are already a column; they
        are looked up once per text otherwise.
        """
        decides = self.accept is not None and self.gate == "none"
        if candidates is None:
            if self.plain:
                replaced = F.regexp_replace(text, self.pattern, literal_replacement(self.token))
                return F.when(self._held(text), replaced).otherwise(text) if self.needs else replaced
            return let(
                text, lambda once: let(self.candidates(once), lambda hits: self.apply(once, hits))
            )
        if self.key or decides:
            redacted = replace_matches(text, self.pattern, self._changed, candidates)
        else:
            redacted = F.regexp_replace(text, self.pattern, literal_replacement(self.token))
        chosen = F.size(candidates) > 0
        if self.gate == "reference":
            chosen = chosen & self._first_passes(candidates)
        return F.when(chosen, redacted).otherwise(text)


def profanity_pattern(words: tuple[str, ...] = rules.PROFANITY) -> str | None:
    """Any listed word as a whole word in any case; no words, no pattern."""
    listed = sorted({word for word in words if word})
    if not listed:
        return None
    first = "".join(sorted({word[0] for word in listed}))
    begins = f"(?=[{first}])" if first.isascii() and first.isalnum() else ""
    return rf"(?Ui){begins}\b(?:" + "|".join(re.escape(word) for word in listed) + r")\b"


# --- fixed values: what every match of a pattern holds ---------------------
_NEEDS = {
    rules.EMAIL: ("@",),
    rules.IPV6_COLON: (":",),
    rules.UUID: ("-",),
    rules.MAC: (":", "-"),
    rules.SSN: ("-",),
    rules.TIMESTAMP_ISO: (":",),
    rules.TIME_SIMPLE: (":",),
    rules.PATH_WINDOWS: (":\\",),
    rules.PATH_UNIX: ("/",),
    rules.HTML_TAG: ("<",),
    rules.CODE_FENCE: ("```",),
    rules.CODE_INLINE: ("`",),
}


def _rule(tag, pattern, token, accept=None, key=None, gate="none"):
    return Rule(tag, pattern, token, accept, key, gate, _NEEDS.get(pattern, ()))


def html(tokens=rules.TOKENS) -> list[Rule]:
    return [_rule("HTML", rules.HTML_TAG, tokens["HTML"])]


def code(tokens=rules.TOKENS) -> list[Rule]:
    """Fenced blocks, then inline spans."""
    return [
        _rule("CODE", rules.CODE_FENCE, tokens["CODE"]),
        _rule("CODE", rules.CODE_INLINE, tokens["CODE"]),
    ]


def profanity(words=rules.PROFANITY, tokens=rules.TOKENS, key=None) -> list[Rule]:
    pattern = profanity_pattern(tuple(words))
    return [_rule("PROFANITY", pattern, tokens["PROFANITY"], key=key)] if pattern else []


def ipv4(tokens=rules.TOKENS, key=None, gate="none") -> list[Rule]:
    return [_rule("IPV4", rules.IPV4, tokens["IPV4"], key=key, gate=gate)]


def ipv6(tokens=rules.TOKENS, key=None, gate="none") -> list[Rule]:
    if gate == "none":
        return [_rule("IPV6", rules.IPV6_COLON, tokens["IPV6"], is_ipv6, key, gate)]
    return [_rule("IPV6", rules.IPV6, tokens["IPV6"], None, key, gate)]


def uuid(tokens=rules.TOKENS, key=None, gate="none") -> list[Rule]:
    return [_rule("UUID", rules.UUID, tokens["UUID"], key=key, gate=gate)]


def mac(tokens=rules.TOKENS, key=None, gate="none") -> list[Rule]:
    return [_rule("MAC", rules.MAC, tokens["MAC"], key=key, gate=gate)]


def timestamp(tokens=rules.TOKENS, key=None) -> list[Rule]:
    token = tokens["TIMESTAMP"]
    return [
        _rule("TIMESTAMP", rules.TIMESTAMP_ISO, token, key=key),
        _rule("TIMESTAMP", rules.TIME_SIMPLE, token, key=key),
    ]


def filepath(tokens=rules.TOKENS, key=None) -> list[Rule]:
    token = tokens["PATH"]
    return [
        _rule("PATH", rules.PATH_WINDOWS, token, key=key),
        _rule("PATH", rules.PATH_UNIX, token, key=key),
    ]


def ssn(tokens=rules.TOKENS, key=None, gate="none") -> list[Rule]:
    return [_rule("SSN", rules.SSN, tokens["SSN"], key=key, gate=gate)]


def credit_card(tokens=rules.TOKENS, key=None, gate="none") -> list[Rule]:
    return [_rule("CC", rules.CREDIT_CARD, tokens["CC"], is_luhn_valid, key, gate)]


def url(tokens=rules.TOKENS, key=None) -> list[Rule]:
    return [_rule("URL", rules.URL, tokens["URL"], key=key)]


def email(tokens=rules.TOKENS, key=None) -> list[Rule]:
    return [_rule("EMAIL", rules.EMAIL, tokens["EMAIL"], key=key)]


def phone(tokens=rules.TOKENS, key=None) -> list[Rule]:
    return [_rule("PHONE", rules.PHONE_CANDIDATE, tokens["PHONE"], is_phone, key)]


def candidate_currency(key=None) -> list[Rule]:
    """Amounts that match the phone shape, for when currency is redacted too."""

    def long_amount(hit: Column) -> Column:
        return is_phone_like(hit) & ~is_date_like(hit) & is_currency_like(hit)

    token = rules.CANDIDATE_CURRENCY_TOKEN
    return [_rule("CURRENCY", rules.PHONE_CANDIDATE, token, long_amount, key)]


def currency(tokens=rules.TOKENS, key=None) -> list[Rule]:
    """A text that is one amount, amounts inside a text, then left-over codes and symbols."""
    token = tokens["CURRENCY"]
    patterns = (
        rules.CURRENCY_AMOUNT,
        rules.CURRENCY_INLINE,
        rules.CURRENCY_CODE,
        rules.CURRENCY_SYMBOL,
    )
    return [_rule("CURRENCY", pattern, token, key=key) for pattern in patterns]


def pii_removal() -> list[Rule]:
    """Web addresses, e-mail addresses and phone numbers are deleted."""
    return [
        _rule("URL_RM", rules.URL, ""),
        _rule("EMAIL_RM", rules.EMAIL, ""),
        _rule("RM_PHONE", rules.PHONE_CANDIDATE, "", is_phone),
    ]
