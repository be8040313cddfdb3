"""Language of a text from character three-grams.

A profile table holds, per gram, one log-probability per language.  Scoring a
text joins its grams with that table and adds up; scores are whole numbers
(thousandths), so sums do not depend on the order of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubwell.functions.hashing import IDENTITY, content_identity
from scrubwell.session import stage

MOST_LANGUAGES = 250
GRAM_SIZE = 3
CHUNK = 1 << 20  # characters that are counted at once
KINDS = 1 << 18  # grams a task holds of one language before it passes them on


@dataclass(frozen=True)
class LanguageModel:
    """``profiles`` has ``gram`` and per language ``n_xx`` and ``gain_xx``.

    ``gain`` is the log-probability above that of an unseen gram, so a gram
    missing from the table adds nothing and the join can be an inner join.
    ``mass`` is the smoothed number of grams of each language.
    """

    profiles: DataFrame
    mass: dict[str, int]

    @property
    def languages(self) -> list[str]:
        return sorted(self.mass)


def _packer():
    """A function that makes a number of every gram of a text: 21 bits a character.

    Made here, so that it reaches the workers whole.
    """

    def packed(text: str | None) -> np.ndarray:
        points = np.frombuffer((text or "").encode("utf-32-le"), "<u4").astype(np.int64)
        if len(points) < GRAM_SIZE:
            return np.empty(0, np.int64)
        return points[:-2] << 42 | points[1:-1] << 21 | points[2:]

    return packed


def _gram_number(gram: Column) -> Column:
    """The number of a gram, as the packer makes it."""
    first, second, third = (F.ascii(F.substring(gram, at, 1)).cast("bigint") for at in (1, 2, 3))
    return F.shiftleft(first, 42).bitwiseOR(F.shiftleft(second, 21)).bitwiseOR(third)


def _counted(text: Column) -> Column:
    """The distinct grams of each text, as numbers, and how often it has them."""
    packed = _packer()
    kind = pa.struct([("gram", pa.int64()), ("n", pa.int64())])

    @F.arrow_udf("array<struct<gram:bigint,n:bigint>>")
    def count(texts: pa.Array) -> pa.Array:
        found = [np.unique(packed(text.as_py()), return_counts=True) for text in texts]
        ends = np.cumsum([0, *(len(grams) for grams, _ in found)])
        columns = [
            pa.array(np.concatenate([np.empty(0, np.int64), *(pair[side] for pair in found)]))
            for side in (0, 1)
        ]
        pairs = pa.StructArray.from_arrays(columns, fields=list(kind))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)

    return count(F.lower(text))


def _tallied(texts: DataFrame) -> DataFrame:
    """``place, gram, n`` of ``place, text`` (in lower case): counts of a task, to be added up by gram.

    A task counts so many characters at once and holds so many grams of a language: neither the length of
    a text nor the number of texts matters.
    """
    packed, chunk, most = _packer(), CHUNK, KINDS

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        counts = np.zeros(len(grams), np.int64)
        np.add.at(counts, where, np.concatenate([n for _, n in parts]))
        return grams, counts

    def rows(place: int, grams: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        points = np.stack([grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF], axis=1)
        spelled = points.astype("<u4").tobytes().decode("utf-32-le")
        told = [spelled[at : at + 3] for at in range(0, len(spelled), 3)]
        columns = [pa.array([place] * len(told), pa.int64()), pa.array(told, pa.string()), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, ["place", "gram", "n"])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[int, list[np.ndarray]] = {}
        sizes: dict[int, int] = {}

        def count(place: int) -> None:
            new = np.unique(np.concatenate(waiting.pop(place)), return_counts=True)
            sizes[place] = 0
            held[place] = merged([held[place], new]) if place in held else new

        for batch in batches:
            for place, text in zip(*batch.columns):
                place, whole = place.as_py(), text.as_py() or ""
                for at in range(0, len(whole), chunk):
                    # two characters more: the grams that begin in this chunk
                    grams = packed(whole[at : at + chunk + 2])
                    waiting.setdefault(place, []).append(grams)
                    sizes[place] = sizes.get(place, 0) + len(grams)
                    if sizes[place] >= chunk:
                        count(place)
                        if len(held[place][0]) >= most:
                            yield rows(place, *held.pop(place))
        for place in list(waiting):
            count(place)
        for place, (grams, counts) in held.items():
            yield rows(place, grams, counts)

    return texts.mapInArrow(tally, "place bigint, gram string, n bigint")


def _milli_log(value: Column) -> Column:
    return F.round(F.log(value) * 1000).cast("bigint")


def train_language_model(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    languages: tuple[str, ...] | None = None,
) -> LanguageModel:
    """Count grams per language and smooth the counts by one.

    ``languages`` are all labels of the training table unless given; a table with more than
    MOST_LANGUAGES of them is an error, as a model has two columns for each.

    Grams are counted in the tasks that read the texts, many at once, so a language holding most of the rows
    sends no more than one row per gram and task.  Only the totals, one row,
    come back to the driver.
    """
    if languages is None:
        labels = df.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang")).distinct()
        found = labels.limit(MOST_LANGUAGES + 1).collect()
        if len(found) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} labels in {lang}; name the languages to train")
        languages = tuple(sorted(row.lang for row in found))
    place = F.array_position(F.array(*[F.lit(name) for name in languages]), F.col(lang))
    grams = _tallied(
        df.filter(F.col(lang).isin(*languages)).select(place.alias("place"), F.lower(F.col(text)).alias("text"))
    )
    counts = stage(
        grams.groupBy("gram").agg(
            *[
                F.coalesce(F.sum(F.when(F.col("place") == at, F.col("n"))), F.lit(0)).alias(f"n_{name}")
                for at, name in enumerate(languages, 1)
            ]
        ),
        "language-counts",
    )
    totals = counts.agg(
        F.count("*").alias("kinds"), *[F.sum(f"n_{name}").alias(name) for name in languages]
    ).first()
    gains, masses = {}, {}
    for name in languages:
        mass = (totals[name] or 0) + totals["kinds"]
        gains[f"gain_{name}"] = _milli_log((F.col(f"n_{name}") + 1) / F.lit(mass)) - _milli_log(
            F.lit(1) / F.lit(mass)
        )
        masses[name] = mass
    return LanguageModel(counts.withColumns(gains), masses)


def profile_table(model: LanguageModel) -> DataFrame:
    """The model as ``lang, gram, n, logp_milli``, seen grams only."""
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("lang"),
                F.col(f"n_{name}").alias("n"),
                _milli_log((F.col(f"n_{name}") + 1) / F.lit(model.mass[name])).alias("logp_milli"),
            )
            for name in model.languages
        ]
    )
    return (
        model.profiles.select("gram", F.explode(entries).alias("entry"))
        .select("entry.lang", "gram", "entry.n", "entry.logp_milli")
        .filter(F.col("n") > 0)
    )


def detect_language(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_detected``; NULL where a text is too short to hold a gram.

    Texts are told apart by their content, so the table needs no key.  A text joins
    each of its distinct grams once, as a number, with its count.  Only two hashes travel with them, and their sums combine before the shuffle to one
    narrow row per distinct text; the sums of a repeated text are divided again.  The profile table is read from files, so the
    planner broadcasts it when those are small and joins by shuffle otherwise.
    """
    df = df.withColumns(content_identity(F.col(text)))
    gain = [f"gain_{name}" for name in model.languages]
    gains = (
        df.select(*IDENTITY, F.posexplode(_counted(F.col(text))).alias("pos", "has"))
        .select(*IDENTITY, "pos", "has.gram", "has.n")
        .join(model.profiles.select(_gram_number(F.col("gram")).alias("gram"), *gain), "gram", "left")
        .groupBy(*IDENTITY)
        .agg(
            F.count_if(F.col("pos") == 0).alias("_rows"),
            *[F.sum(F.col(name) * F.col("n")).alias(name) for name in gain],
        )
        .select(*IDENTITY, *[F.expr(f"`{n}` div _rows AS `_{n[5:]}`") for n in gain])
    )
    size = F.greatest(F.length(F.lower(F.col(text))) - (GRAM_SIZE - 1), F.lit(0))
    scores = F.array(
        *[
            F.struct(
                (
                    F.coalesce(F.col(f"_{name}"), F.lit(0))
                    + size * _milli_log(F.lit(1) / F.lit(model.mass[name]))
                ).alias("score"),
                F.lit(name).alias("lang"),
            )
            for name in model.languages
        ]
    )
    best = F.when(size > 0, F.array_max(scores)["lang"])
    return (
        df.join(gains, IDENTITY, "left")
        .withColumn("lang_detected", best)
        .drop(*IDENTITY, *[f"_{name}" for name in model.languages])
    )


def route_foreign(
    df: DataFrame,
    model: LanguageModel,
    text: str = "text",
    home: str = "en",
) -> DataFrame:
    """Mark the texts a translator would have to handle."""
    found = detect_language(df, model, text)
    foreign = F.coalesce(F.col("lang_detected") != home, F.lit(False))
    return found.withColumn("needs_translation", foreign)


def blank_foreign(
    df: DataFrame,
    model: LanguageModel,
    text: str = "text",
    home: str = "en",
) -> DataFrame:
    """Empty every text that is not in the home language."""
    routed = route_foreign(df, model, text, home)
    return routed.withColumn(text, F.when(F.col("needs_translation"), "").otherwise(F.col(text)))
