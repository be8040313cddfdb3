"""Yes/no decisions about one candidate string, as boolean columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubwell import rules
from scrubwell.functions.text import digits, strip


def is_date_like(candidate: Column) -> Column:
    """Year-first or day-first date, any eight digits, or a bare year."""
    bare = F.btrim(strip(candidate), F.lit(rules.DATE_BRACKETS))
    return (
        bare.rlike(rules.DATE_ISO)
        | bare.rlike(rules.DATE_DMY)
        | (F.length(digits(bare)) == 8)
        | bare.rlike(rules.DATE_YEAR)
    )


def is_amount(candidate: Column) -> Column:
    """The whole string is one amount."""
    return candidate.rlike(rules.CURRENCY_AMOUNT)


def is_currency_like(candidate: Column) -> Column:
    """Carries a currency symbol or code, or is a bare amount."""
    bare = strip(candidate)
    return (
        bare.rlike(rules.CURRENCY_SYMBOL)
        | bare.rlike(rules.CURRENCY_CODE)
        | is_amount(bare)
        | bare.rlike(rules.CURRENCY_CODED)
    )


def is_phone_like(candidate: Column) -> Column:
    """Seven or more digits, whatever stands between them."""
    return F.length(digits(candidate)) >= 7


def is_possible_other(candidate: Column) -> Column:
    """Could also be read as a phone number, an amount or a date."""
    return is_phone_like(candidate) | is_currency_like(candidate) | is_date_like(candidate)


def is_phone(candidate: Column) -> Column:
    """Long enough for a phone number and neither a date nor an amount."""
    return is_phone_like(candidate) & ~is_date_like(candidate) & ~is_currency_like(candidate)


def is_ipv6(candidate: Column) -> Column:
    """Hex-and-colon text that is a full or an abbreviated address."""
    return candidate.rlike(rules.IPV6_FULL) | candidate.contains("::")


def is_luhn_valid(candidate: Column) -> Column:
    """13 to 19 digits with a correct Luhn check digit."""
    number = digits(candidate)
    return F.length(number).between(13, 19) & F.call_function("luhn_check", number)


def phone_decision(candidate: Column, mode: str = "anonymize", currency: bool = False) -> Column:
    """What becomes of a phone candidate: ``keep``, ``phone``, ``currency`` or ``remove``."""
    outcome = {"anonymize": "phone", "remove": "remove", "keep": "keep"}[mode]
    return (
        F.when(~is_phone_like(candidate) | is_date_like(candidate), "keep")
        .when(is_currency_like(candidate), "currency" if currency else "keep")
        .otherwise(outcome)
    )
