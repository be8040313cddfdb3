"""Toxicity by a factorization machine over hashed terms.

A text is the set of its words and word beginnings, hashed.  The score is a
weight per term plus, for every two terms, the dot product of their factors: an
insult next to a mention of a group can weigh more than both alone, which no sum
of weights can express.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubwell.session import release, stage

SPACE = 1 << 18  # hashed terms
BEGINNINGS = (4, 5, 6)  # bytes of a word's beginnings
FACTORS = 8
SAMPLE = 20_000  # labelled rows that the model is fitted on, at most
THRESHOLD = 0.3
LEAST = 3  # texts that a term or pair stands in, or it tells nothing
FIT_TERMS = 4096  # terms of a text that the model is fitted on, at most
PAIR_TEXTS = 1000  # texts of either kind in which pairs are screened, at most
PAIR_TERMS = 400  # terms of a text whose pairs are screened, at most
PAIR_BITS = 22
PAIR_RATIO = 40  # log-likelihood ratio; about 1e-10 by chance, for 4 million hashes
REMEMBERED = 300_000  # words of a task whose terms are looked up
# UTF-8 of the general punctuation and of the signs of Latin-1
_SIGNS = re.compile(rb"\xe2\x80[\x80-\xbf]|\xc2[\x80-\xbf]|\xe3\x80[\x80-\x82]")
_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256))


def words_of(text: str | None) -> set[bytes]:
    """The distinct lower-cased words; digits and signs are no part of them."""
    if not text:
        return set()
    return set(_SIGNS.sub(b" ", text.lower().encode()).translate(_LETTERS).split())


class Terms:
    """Hashed terms of texts, or their rows in a model if its ``place`` is given."""

    def __init__(self, place: np.ndarray | None = None):
        self.place = place
        self.known: dict[bytes, tuple[int, ...]] = {}

    def _of_word(self, word: bytes) -> tuple[int, ...]:
        parts = [word, *(word[:size] + b"~" for size in BEGINNINGS if len(word) > size)]
        terms = [xxhash.xxh32_intdigest(part) % SPACE for part in parts]
        if self.place is None:
            return tuple(terms)
        return tuple(row for row in self.place[terms].tolist() if row >= 0)

    def of(self, text: str | None) -> np.ndarray:
        """The distinct terms, sorted; none for null and for texts without letters."""
        known, found = self.known, set()
        for word in words_of(text):
            terms = known.get(word)
            if terms is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                terms = known[word] = self._of_word(word)
            if terms:
                found.update(terms)
        return np.sort(np.fromiter(found, np.int32, len(found)))


@dataclass
class Model:
    """``place`` leads from a hashed term to its row, -1 if the term tells nothing."""

    place: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, rows: np.ndarray) -> float:
        """The probability for the rows of a text's terms."""
        mixed = self.factors[rows]
        pairs = 0.5 * float((mixed.sum(axis=0) ** 2 - (mixed**2).sum(axis=0)).sum())
        raw = self.bias + float(self.weights[rows].sum()) + pairs
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def _ratio(bad: np.ndarray, seen: np.ndarray, share: float) -> np.ndarray:
    """The log-likelihood ratio of ``bad`` among ``seen`` against a share."""

    def part(count, expected):
        return count * np.log(np.maximum(count, 1e-12) / np.maximum(expected, 1e-12))

    return 2 * (part(bad, seen * share) + part(seen - bad, seen * (1 - share)))


def _alone(seen: np.ndarray, bad: np.ndarray, share: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Which terms tell something alone, and which of them speak for toxic texts.

    A term tells something alone if its share among toxic texts departs from the rest
    (log-likelihood ratio over 10.8).
    """
    alone = (seen >= least) & (_ratio(bad, seen, share) > 10.8)
    return alone, alone & (2 * bad >= seen)


def _share(toxic: np.ndarray) -> float:
    return float(np.clip(toxic.mean() if len(toxic) else 0.5, 1e-6, 1 - 1e-6))


def _telling(texts: list[np.ndarray], toxic: np.ndarray, least: int = LEAST) -> np.ndarray:
    """The terms that the model is fitted on: those that tell something alone, and those of telling pairs.

    Fitting all terms instead costs recall on
    held-out texts; pairs are screened on their own, so that none is lost whose terms are neutral.
    """
    flat = np.concatenate([*texts, np.zeros(0, np.int32)])
    owner = np.repeat(toxic, [len(text) for text in texts])
    seen = np.bincount(flat, minlength=SPACE).astype(float)
    bad = np.bincount(flat, weights=owner, minlength=SPACE)
    alone, strong = _alone(seen, bad, _share(toxic), least)
    open_ones = [text for text, is_bad in zip(texts, toxic) if is_bad and not strong[text].any()]
    clean = [text for text, is_bad in zip(texts, toxic) if not is_bad]
    paired = _paired(_evenly(open_ones), _evenly(clean), seen, least)
    return np.union1d(np.flatnonzero(alone), paired)


def _telling_of(chosen: DataFrame, least: int = LEAST) -> np.ndarray:
    """The same for a table ``key, toxic, terms`` (unique keys), which stays where it is.

    To the driver go the counts of the terms (SPACE rows at most), a flag per text and the terms of
    the texts in which pairs are screened, PAIR_TEXTS of either kind at most.
    """
    counts = (
        chosen.select("toxic", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("seen"), F.count_if("toxic").alias("bad"))
        .toArrow()
    )
    seen, bad = np.zeros(SPACE), np.zeros(SPACE)
    term = counts["term"].to_numpy()
    seen[term], bad[term] = counts["seen"].to_numpy(), counts["bad"].to_numpy()

    def told(strong: np.ndarray) -> Column:
        return F.arrow_udf(
            lambda texts: pa.array([bool(strong[row.values.to_numpy()].any()) for row in texts], pa.bool_()), "boolean"
        )(F.col("terms"))

    toxic = chosen.agg(F.count("*").alias("rows"), F.count_if("toxic").alias("bad")).first()
    share = _share(np.repeat([1.0, 0.0], [toxic.bad, toxic.rows - toxic.bad]))
    alone, strong = _alone(seen, bad, share, least)
    flags = chosen.select("key", "toxic", told(strong).alias("explained")).toArrow().sort_by("key")
    is_bad, explained = (flags[name].to_numpy().astype(bool) for name in ("toxic", "explained"))
    open_ones, clean = _evenly(np.flatnonzero(is_bad & ~explained)), _evenly(np.flatnonzero(~is_bad))
    if len(open_ones) < least or not len(clean):
        return np.flatnonzero(alone)
    picked = flags.select(["key"]).take(np.concatenate([open_ones, clean]))
    screened = chosen.join(F.broadcast(chosen.sparkSession.createDataFrame(picked)), "key").toArrow().sort_by("key")
    texts = {True: [], False: []}
    for label, row in zip(screened["toxic"], screened["terms"]):
        texts[label.as_py()].append(row.values.to_numpy())
    return np.union1d(np.flatnonzero(alone), _paired(texts[True], texts[False], seen, least))


def _evenly(texts):
    """PAIR_TEXTS of the texts at most, evenly taken."""
    if len(texts) <= PAIR_TEXTS:
        return texts
    places = np.linspace(0, len(texts) - 1, PAIR_TEXTS).astype(int)
    return texts[places] if isinstance(texts, np.ndarray) else [texts[i] for i in places]


def _pairs_of(text: np.ndarray, seen: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a text's terms, of its PAIR_TERMS rarest that occur ``least`` times or more."""
    text = text[seen[text] >= least]
    if len(text) > PAIR_TERMS:
        text = np.sort(text[np.argsort(seen[text], kind="stable")[:PAIR_TERMS]])
    left, right = np.triu_indices(len(text), 1)
    return text[left].astype(np.int64), text[right].astype(np.int64)


def _paired(
    bad: list[np.ndarray], clean: list[np.ndarray], seen: np.ndarray, least: int
) -> np.ndarray:
    """Terms of pairs that stand together in toxic texts which no single term explains.

    Pairs are counted by hash.  A hash tells
    something if its ratio passes a bound that no chance pair of all hashes is expected to
    pass; its pairs in toxic texts give the terms.
    """

    if len(bad) < least or not clean:
        return np.empty(0, np.int64)

    def slots(left, right):
        mixed = (left * SPACE + right).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - PAIR_BITS)).astype(np.int64)

    def counted(texts):
        counts = np.zeros(1 << PAIR_BITS, np.int32)
        for text in texts:
            np.add.at(counts, np.unique(slots(*_pairs_of(text, seen, least))), 1)
        return counts

    in_bad, in_clean = counted(bad), counted(clean)
    share = len(bad) / (len(bad) + len(clean))
    both = in_bad + in_clean
    held = np.flatnonzero((in_bad >= least) & (in_bad > 2 * share * both))
    telling = np.zeros(1 << PAIR_BITS, bool)
    telling[held] = _ratio(in_bad[held].astype(float), both[held].astype(float), share) > PAIR_RATIO
    if not telling.any():
        return np.empty(0, np.int64)
    found = []
    for text in bad:
        left, right = _pairs_of(text, seen, least)
        hit = telling[slots(left, right)]
        found.append(np.union1d(left[hit], right[hit]))
    return np.unique(np.concatenate(found))


def fit(
    texts: list[np.ndarray],
    toxic: np.ndarray,
    factors: int = FACTORS,
    epochs: int = 60,
    rate: float = 0.05,
    decay: float = 1e-4,
    batch: int = 512,
    seed: int = 7,
    kept: np.ndarray | None = None,
) -> Model:
    """Fit by logistic loss, Adagrad steps and seeded shuffles; without rows the model says 0.5.

    ``kept`` names the terms to fit on, sorted, where they were found before.
    """
    toxic = np.asarray(toxic, float)
    kept = _telling(texts, toxic) if kept is None else kept
    place = np.full(SPACE, -1, np.int32)
    place[kept] = np.arange(len(kept))
    random = np.random.default_rng(seed)
    weights, vectors = np.zeros(len(kept)), random.normal(0, 0.01, (len(kept), factors))
    share = np.clip(toxic.mean() if len(toxic) else 0.5, 1e-3, 1 - 1e-3)
    model = Model(place, float(np.log(share / (1 - share))), weights, vectors)
    rows = [r[r >= 0] for r in (place[text] for text in texts)]
    sizes = np.array([len(r) for r in rows], np.int64)
    flat, starts = np.concatenate([*rows, np.zeros(0, np.int32)]), np.cumsum(sizes) - sizes
    past_b, past_w, past_v = 1e-8, np.full(len(kept), 1e-8), np.full(vectors.shape, 1e-8)
    for _ in range(epochs if len(kept) else 0):
        order = random.permutation(len(rows))
        for at in range(0, len(order), batch):
            picked = order[at : at + batch]
            size = sizes[picked]
            owner = np.repeat(np.arange(len(picked)), size)
            ends = np.cumsum(size)
            terms = flat[np.repeat(starts[picked] - (ends - size), size) + np.arange(size.sum())]
            mixed = vectors[terms]
            sums = _by_row(owner, mixed, len(picked))
            squares = _by_row(owner, mixed**2, len(picked))
            linear = np.bincount(owner, weights=weights[terms], minlength=len(picked))
            raw = model.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - toxic[picked]) / len(picked)
            past_b += error.sum() ** 2
            model.bias -= rate * error.sum() / np.sqrt(past_b)
            used, position = np.unique(terms, return_inverse=True)
            step = np.bincount(position, weights=error[owner], minlength=len(used))
            step += decay * weights[used]
            past_w[used] += step**2
            weights[used] -= rate * step / np.sqrt(past_w[used])
            steps = _by_row(position, error[owner, None] * (sums[owner] - mixed), len(used))
            steps += decay * vectors[used]
            past_v[used] += steps**2
            vectors[used] -= rate * steps / np.sqrt(past_v[used])
    return model


def _by_row(owner: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Sums of rows with the same owner."""
    return np.stack(
        [np.bincount(owner, weights=column, minlength=rows) for column in values.T], axis=1
    )


def _bounded(terms: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` of a text's terms, scattered over all of them, sorted."""
    if len(terms) <= most:
        return terms
    scattered = terms.astype(np.uint32) * np.uint32(0x9E3779B1)
    return np.sort(terms[np.argsort(scattered, kind="stable")[:most]])


def held_out(key: Column) -> Column:
    """The quarter of keys that no label may be learned from; false for null keys."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
    most: int = FIT_TERMS,
) -> Model:
    """Fit on at most ``sample`` labelled texts outside the held-out quarter.

    The rows with the smallest hashes of their key are taken, so the choice does
    not depend on how the tables are split.  Null labels and null keys do not
    count; of rows that repeat a key the one with the smallest terms is learned
    from.  The chosen keys, ``sample`` at most, are broadcast, so no text is
    shuffled; the terms of the chosen texts, ``most`` of each at most, are written to a table and only
    those that the model is fitted on go to the driver.
    Scores are always made from all terms of a text.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
        .select(F.col(key).alias("key"), (F.col(label) > 0).alias("toxic"))
        .groupBy("key")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(sample)
    )

    @F.arrow_udf("array<int>")
    def hashed(texts: pa.Array) -> pa.Array:
        terms = Terms()
        rows = [terms.of(text.as_py()) for text in texts]
        return pa.array([_bounded(row, most) for row in rows], pa.list_(pa.int32()))

    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    chosen = (
        texts.join(F.broadcast(known), "key")
        .select("key", "toxic", hashed(F.col("text")).alias("terms"))
        .groupBy("key", "toxic")
        .agg(F.min("terms").alias("terms"))
    )
    chosen = stage(chosen, "labelled")
    kept = _telling_of(chosen)
    held = np.zeros(SPACE, bool)
    held[kept] = True

    @F.arrow_udf("array<int>")
    def fitted(texts: pa.Array) -> pa.Array:
        rows = (row.values.to_numpy() for row in texts)
        return pa.array([row[held[row]] for row in rows], pa.list_(pa.int32()))

    rows = chosen.select("key", "toxic", fitted(F.col("terms")).alias("terms")).toArrow().sort_by("key")
    release(chosen)
    terms = [row.values.to_numpy() for row in rows["terms"].combine_chunks()] if len(rows) else []
    return fit(terms, rows["toxic"].to_numpy().astype(float), kept=kept)


def score(text: Column, model: Model) -> Column:
    """The probability (double) that a text is toxic; texts without known terms get the base rate."""

    @F.arrow_udf("double")
    def scored(blocks: Iterator[pa.Array]) -> Iterator[pa.Array]:
        terms = Terms(model.place)
        for texts in blocks:
            yield pa.array((model.score(terms.of(text.as_py())) for text in texts), pa.float64())

    return scored(text)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    **options,
) -> DataFrame:
    """``<key>, held_out, score, predicted`` for every row of ``docs``.

    Only the text enters a score.  Null and empty texts get a score too (the
    model's base rate), repeated rows the same one; other columns are ignored.
    Without usable labels every score is 0.5.
    """
    model = train(docs, labels, key, text, **options)
    told = docs.select(
        F.col(key), held_out(F.col(key)).alias("held_out"), score(F.col(text), model).alias("score")
    )
    return told.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    **options,
) -> DataFrame:
    """The rows of ``docs`` that score below the threshold; all columns as they are."""
    model = train(docs, labels, key, text, **options)
    return docs.filter(score(F.col(text), model) < threshold)
