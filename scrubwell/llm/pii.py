"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Exact patterns give the base spans, which always stay.  Looser patterns give
candidate spans.  On every candidate six labelers (regular expressions, gazetteers
and context) vote yes, no or nothing.  Candidates with the same kind, votes and
size class are counted over the whole corpus, a table whose size the numbers of
kinds, votes and classes bound.  From the counts, expectation-maximisation
estimates how reliable each labeler is and what each candidate probably is; those
probabilities train a logistic classifier, which decides on every candidate.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubwell.session import stage

KINDS = ("email", "ip", "card", "phone", "secret", "name")
BASE_KINDS = 4
YES, NO, SILENT = 2, 0, 1
LABELERS = 6
SIZES = (9, 16, 33)  # characters that part the size classes

# The base patterns.
_MAIL_CHARS = "[A-Za-z0-9._%+-]"
_MAIL = rf"{_MAIL_CHARS}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_IP = r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# A run that fails from its first character fails from all others: the search starts
# at beginnings of runs only, and once more where the last match ended.
_MAIL_HERE, _MAIL_FIRST = re.compile(_MAIL), re.compile(f"(?<!{_MAIL_CHARS}){_MAIL}")
_IP_HERE, _IP_FIRST = re.compile(_IP), re.compile(f"(?<![0-9]){_IP}")
_DIGIT = re.compile("[0-9]")
_NO_DIGITS = re.compile("[^0-9]+")

# Gazetteers and looser patterns.
MAIL_ENDS = frozenset("com org net edu gov info io de fr es uk eu ch at it nl be pl us ca".split())
SECRET_WORDS = "token password passwd pwd secret api_key apikey api-key access_key private_key".split()
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Señor Señora Monsieur Madame Mme".split()
CUES = {
    "email": "mail e-mail contact write kontakt correo courriel",
    "ip": "ip address host server adresse",
    "card": "card credit visa karte tarjeta carte account konto",
    "phone": "phone tel call mobile fax telefon telefono ruf",
    "secret": " ".join(SECRET_WORDS) + " key login auth",
    "name": "name from by dear lieber von de signed",
}
_CUES = {kind: re.compile(rf"(?i)\b(?:{'|'.join(cues.split())})\b") for kind, cues in CUES.items()}
_SPELLED_HOST = re.compile(
    r"(?i)(?: ?[\[(]at[\])] ?| at )[A-Za-z0-9-]{1,63}"
    r"(?:(?: ?[\[(]dot[\])] ?| dot |\.)[A-Za-z0-9-]{1,63}){1,8}"
)
_LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_BARE_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[ .-][0-9]{2,5}){2,4}(?![0-9])")
_LONG_NUMBER = re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")
_SECRET = re.compile(
    rf"(?i)\b(?:{'|'.join(SECRET_WORDS)})\b[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?([^\s\"']{{6,200}})"
)
_HEX = re.compile(r"(?<![0-9A-Za-z])(?=[0-9]{0,15}[A-Fa-f])[0-9A-Fa-f]{24,128}(?![0-9A-Za-z])")
_NAME = re.compile(
    rf"\b(?:{'|'.join(TITLES)})\.? ([^\W\d_]{{2,30}}(?: [^\W\d_]{{2,30}})?)"
)

Span = tuple[int, int, int]  # kind, start, end


def _runs(first: re.Pattern, here: re.Pattern, text: str) -> Iterator[re.Match]:
    at = 0
    while True:
        found = (at and here.match(text, at)) or first.search(text, at)
        if not found:
            return
        yield found
        at = found.end()


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns that pass their checks, by start and kind."""
    spans: list[Span] = []
    if "@" in text:
        spans += [(0, *found.span()) for found in _runs(_MAIL_FIRST, _MAIL_HERE, text)]
    if _DIGIT.search(text):
        for found in _runs(_IP_FIRST, _IP_HERE, text):
            parts = [part.lstrip("0") for part in found[0].split(".")]
            if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
                spans.append((1, *found.span()))
        for found in _CARD.finditer(text):
            if 12 <= found.end() - found.start() <= 37:
                digits = _NO_DIGITS.sub("", found[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    spans.append((2, *found.span()))
        if "+" in text:
            for found in _PHONE.finditer(text):
                if 9 <= len(_NO_DIGITS.sub("", found[0])) <= 15:
                    spans.append((3, *found.span()))
    return sorted(spans, key=lambda span: (span[1], span[0]))


def _looser(text: str) -> Iterator[Span]:
    lowered = text.lower()
    if any(mark in lowered for mark in (" at ", "[at]", "(at)", "dot")):
        for found in _SPELLED_HOST.finditer(text):
            local = _LOCAL_PART.search(text[max(0, found.start() - 64) : found.start()])
            if local:
                yield 0, found.start() - len(local[0]), found.end()
    if _DIGIT.search(text):
        yield from ((3, *found.span()) for found in _BARE_PHONE.finditer(text))
        yield from ((2, *found.span()) for found in _LONG_NUMBER.finditer(text))
        yield from ((4, *found.span()) for found in _HEX.finditer(text))
    if "=" in text or ":" in text:
        yield from ((4, *found.span(1)) for found in _SECRET.finditer(text))
    if any(title in text for title in TITLES):
        yield from ((5, *found.span(1)) for found in _NAME.finditer(text))


def _vote(yes: bool, no: bool) -> int:
    return YES if yes else NO if no else SILENT


def votes(text: str, span: Span, base: bool) -> tuple[int, ...]:
    """The six labelers on one candidate."""
    kind, start, end = span
    value, before = text[start:end], text[max(0, start - 30) : start]
    digits = _NO_DIGITS.sub("", value) if kind in (2, 3, 4) else ""
    letters = sum(map(str.isalpha, value))
    gazetteer = {
        0: (value.rsplit(".", 1)[-1].lower() in MAIL_ENDS or value.lower().endswith((" com", " org", " net")), True),
        1: (value.startswith(("10.", "192.168.", "127.")), False),
        2: (digits[:1] in ("3", "4", "5", "6"), bool(digits)),
        3: (value.startswith(("+", "00")), False),
        4: (any(word in before.lower() for word in SECRET_WORDS), False),
        5: (value[:1].isupper(), value[:1].islower()),
    }[kind]
    valid = {
        0: (value.count("@") == 1 or " at " not in value, False),
        1: (base, not base),
        2: (luhn(digits), not luhn(digits)) if kind == 2 else (False, False),
        3: (9 <= len(digits) <= 15, len(digits) < 9),
        4: (bool(digits) and letters > 0, not digits),
        5: (value.istitle(), value.islower()),
    }[kind]
    cue = bool(_CUES[KINDS[kind]].search(before))
    others = any(p.search(before) for k, p in _CUES.items() if k != KINDS[kind])
    left, right = text[start - 1 : start], text[end : end + 1]
    return (
        YES if base else SILENT,
        _vote(*valid),
        _vote(*gazetteer),
        _vote(cue, others),
        _vote(False, left.isalnum() or right.isalnum() or left == "/" or right == "/"),
        _vote(len(set(value)) >= 6, len(set(value)) <= 3),
    )


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, int, int, int]]:
    """(kind, start, end, code of the votes, size class) of base and looser spans."""
    found = []
    seen = set(base)
    for span in [*base, *(span for span in dict.fromkeys(_looser(text)) if span not in seen)]:
        code = 0
        for vote in votes(text, span, span in seen):
            code = code * 3 + vote
        found.append((*span, code, sum(span[2] - span[1] >= size for size in SIZES)))
    return found


# --- model --------------------------------------------------------------------------
def decode_votes(codes: np.ndarray) -> np.ndarray:
    return np.stack([codes // 3**i % 3 for i in range(LABELERS - 1, -1, -1)], axis=1)


def expectation_maximisation(cast: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """P(true) of every vote pattern of one kind.

    Two classes, labelers independent given the class; the start trusts yes votes
    over no votes, which also names the classes.
    """
    lean = (cast == YES).sum(axis=1) - (cast == NO).sum(axis=1)
    belief = 1 / (1 + np.exp(-lean.astype(float)))
    for _ in range(rounds):
        log_odds = np.zeros(len(cast))
        for truth, weight in ((1, belief * counts), (-1, (1 - belief) * counts)):
            total = weight.sum()
            log_odds += truth * np.log((total + 1) / (counts.sum() + 2))
            for labeler in range(cast.shape[1]):
                share = np.bincount(cast[:, labeler], weights=weight, minlength=3) + 0.5
                log_odds += truth * np.log(share / share.sum())[cast[:, labeler]]
        belief = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return belief


def _features(kinds: np.ndarray, codes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    cast = decode_votes(codes)
    parts = [np.eye(len(KINDS))[kinds], np.eye(len(SIZES) + 1)[classes]]
    parts += [(cast == YES).astype(float), (cast == NO).astype(float)]
    return np.concatenate(parts, axis=1)


def train(counted: np.ndarray, steps: int = 500) -> np.ndarray:
    """Weights of the span classifier from rows (kind, code, size class, count)."""
    counted = np.asarray(counted, np.int64).reshape(-1, 4)
    kinds, codes, classes, counts = counted.T
    belief = np.zeros(len(counted))
    for kind in range(len(KINDS)):
        of = kinds == kind
        if of.any():
            belief[of] = expectation_maximisation(decode_votes(codes[of]), counts[of])
    features = _features(kinds, codes, classes)
    # every kind weighs the same, however common
    share = np.bincount(kinds, weights=counts, minlength=len(KINDS))[kinds]
    weight = counts / np.maximum(share, 1)
    weights = np.zeros(features.shape[1])
    for _ in range(steps):
        guess = 1 / (1 + np.exp(-features @ weights))
        slope = features.T @ (weight * (guess - belief)) + 1e-3 * weights
        curve = (features * (weight * guess * (1 - guess))[:, None]).T @ features
        move = np.linalg.solve(curve + 1e-2 * np.eye(len(weights)), slope)
        weights -= move
        if np.abs(move).max() < 1e-8:
            break
    return weights


STRETCH = 64  # characters


def decide(found: list[dict], weights: np.ndarray, threshold: float) -> list[Span]:
    """Base spans and the accepted candidates that overlap no span before them."""
    if not found:
        return []
    table = np.array([list(one.values()) for one in found], np.int64)
    guess = 1 / (1 + np.exp(-_features(table[:, 0], table[:, 3], table[:, 4]) @ weights))
    base = table[:, 3] // 3 ** (LABELERS - 1) == YES
    spans: list[Span] = []
    near: dict[int, list[Span]] = {}  # the spans that reach into each stretch of the text

    def take(span: Span) -> None:
        spans.append(span)
        for stretch in range(span[1] // STRETCH, span[2] // STRETCH + 1):
            near.setdefault(stretch, []).append(span)

    def free(start: int, end: int) -> bool:
        stretches = range(start // STRETCH, end // STRETCH + 1)
        return all(end <= b or start >= e for s in stretches for _, b, e in near.get(s, ()))

    for row in table[base, :3].tolist():
        take(tuple(row))
    for kind, start, end in table[~base & (guess >= threshold), :3].tolist():
        if free(start, end):
            take((kind, start, end))
    return sorted(spans, key=lambda span: (span[1], span[0]))


# --- Spark ---------------------------------------------------------------------------
FOUND = "array<struct<kind: int, start: int, stop: int, code: int, size: int>>"


def _find(text: Column) -> Column:
    @F.arrow_udf(FOUND)
    def find(texts: pa.Array) -> pa.Array:
        fields = ("kind", "start", "stop", "code", "size")
        kind = pa.list_(pa.struct([(name, pa.int32()) for name in fields]))
        rows = []
        for text in texts:
            text = text.as_py() or ""
            rows.append([dict(zip(fields, one)) for one in candidates(text, base_spans(text))])
        return pa.array(rows, kind)

    return find(text)


def find_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5
) -> DataFrame:
    """``<key>, base, spans`` for every row: arrays of (kind, start, stop) in code points.

    ``base`` holds what the exact patterns find, ``spans`` adds the accepted
    candidates.  Null and empty texts have none; repeated rows are treated alike
    (and count as often as they stand); other columns are ignored.
    """
    found = stage(docs.select(F.col(key).alias("key"), _find(F.col(text)).alias("found")), "spans")
    counted = (
        found.select(F.inline("found"))
        .groupBy("kind", "code", "size")
        .count()
        .orderBy("kind", "code", "size")
        .collect()
    )  # at most kinds x 3^labelers x size classes rows
    weights = train(np.array([tuple(row) for row in counted], np.int64))
    kind = "array<struct<kind: string, start: int, stop: int>>"

    @F.arrow_udf(kind)
    def chosen(rows: pa.Array) -> pa.Array:
        shape = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])
        )
        done = []
        for row in rows:
            spans = decide(row.as_py() or [], weights, threshold)
            done.append([{"kind": KINDS[k], "start": a, "stop": b} for k, a, b in spans])
        return pa.array(done, shape)

    names = ", ".join(f"'{kind}'" for kind in KINDS)
    base = F.expr(
        f"transform(filter(found, f -> f.code div {3 ** (LABELERS - 1)} = {YES}), f -> named_struct("
        f"'kind', array({names})[f.kind], 'start', f.start, 'stop', f.stop))"
    )
    return found.select(
        F.col("key").alias(key), base.alias("base"), chosen(F.col("found")).alias("spans")
    )


def span_text(spans: str) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.expr(
        f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.stop)), ',')"
    )


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span as ``[KIND]``; of overlapping spans the first counts."""
    parts, at = [], 0
    for kind, start, stop in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
            at = stop
    return "".join((*parts, text[at:]))
