"""Normalisation steps: one string column in, one string column out."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubwell import rules
from scrubwell.functions.text import has_code, literal_replacement, replace_matches, strip


@F.arrow_udf(T.StringType())
def _nfc(texts: pa.Array) -> pa.Array:
    forms = (t if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist())
    return pa.array(forms, pa.string())


def normalize_nfc(text: Column) -> Column:
    """NFC form.  Spark has no built-in for it, so this is an Arrow function.

    Arrow's own kernel is not used: its NFC form leaves marks uncomposed.
    Only texts holding a character that NFC may change are sent to Python; for
    all others the function sees NULL and the text stays in the JVM.
    """
    return F.coalesce(_nfc(F.when(text.rlike(rules.NFC_SUSPECT), text)), text)


def strip_html(text: Column, token: str = rules.TOKENS["HTML"]) -> Column:
    return F.regexp_replace(text, rules.HTML_TAG, literal_replacement(token))


def _unless_code(text: Column, changed: Column, keep_code: bool) -> Column:
    return F.when(has_code(text), text).otherwise(changed) if keep_code else changed


def collapse_space(text: Column, keep_code: bool = True) -> Column:
    """Runs of whitespace become one space; a text that holds code stays if ``keep_code``."""
    return _unless_code(text, F.regexp_replace(text, rules.SPACES, " "), keep_code)


def strip_control(text: Column, keep_code: bool = True) -> Column:
    """Delete control characters except tab and line ends; ``keep_code`` as above."""
    return _unless_code(text, F.regexp_replace(text, rules.CONTROL, ""), keep_code)


def strip_nonprintable(text: Column) -> Column:
    """Delete all control, format, private and separator characters but the space."""
    return F.regexp_replace(text, rules.NONPRINTABLE, "")


def shrink_runs(text: Column) -> Column:
    """Five or more of the same character become four of it."""
    return F.regexp_replace(text, rules.REPEATED_CHAR, "$1$1$1$1")


def trim_text(text: Column) -> Column:
    return strip(text)


def strip_code(text: Column, token: str = rules.TOKENS["CODE"]) -> Column:
    """Fenced blocks first, then inline spans."""
    token = literal_replacement(token)
    fenced = F.regexp_replace(text, rules.CODE_FENCE, token)
    return F.regexp_replace(fenced, rules.CODE_INLINE, token)


def _redecode(span: Column) -> Column:
    """Read a span as the windows-1252 view of UTF-8 bytes; keep it if it is not."""
    narrow = F.translate(span, rules.CP1252_MARKS, rules.CP1252_BYTES)
    one_byte = F.when(~narrow.rlike(r"[^\x{00}-\x{FF}]"), F.encode(narrow, "ISO-8859-1"))
    return F.coalesce(F.try_validate_utf8(one_byte.cast("string")), span)


def repair_mojibake(text: Column, keep_code: bool = True) -> Column:
    """Undo UTF-8 that was decoded as windows-1252; ``keep_code`` as above."""
    repaired = replace_matches(text, rules.MOJIBAKE_SPAN, _redecode)
    fixed = F.when(text.rlike(rules.MOJIBAKE_SPAN), repaired).otherwise(text)
    return _unless_code(text, fixed, keep_code)
