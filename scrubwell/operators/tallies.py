"""Where each token of a text occurs, and how far apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubwell.functions.text import let, space_tokens


def _placed(text: Column) -> Column:
    """``struct(token, pos)`` of one text, sorted, so equal tokens stand together."""
    return F.array_sort(
        F.transform(
            space_tokens(text), lambda token, pos: F.struct(token.alias("token"), pos.alias("pos"))
        )
    )


def token_tally(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys, token, positions`` without a shuffle: each text is sorted in its own row."""

    def groups(placed: Column) -> Column:
        size = F.size(placed)
        places = F.transform(placed, lambda _, at: at)
        starts = F.filter(
            places,
            lambda at: (at == 0)
            | (F.get(placed, at)["token"] != F.get(placed, at - 1)["token"]),
        )
        return let(
            starts,
            lambda begin: F.transform(
                begin,
                lambda first, nth: F.struct(
                    F.get(placed, first)["token"].alias("token"),
                    F.transform(
                        F.slice(
                            placed,
                            first + 1,
                            F.coalesce(F.get(begin, nth + 1), size) - first,
                        ),
                        lambda item: item["pos"],
                    ).alias("positions"),
                ),
            ),
        )

    return df.select(*keys, F.inline(let(_placed(F.col(text)), groups)))


def repeat_gaps(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys, token, pos, gap``: the distance to the previous same token."""

    def gaps(placed: Column) -> Column:
        stepped = F.transform(
            placed,
            lambda item, at: F.struct(
                item["token"].alias("token"),
                item["pos"].alias("pos"),
                F.when(
                    F.get(placed, at - 1)["token"] == item["token"],
                    item["pos"] - F.get(placed, at - 1)["pos"],
                ).alias("gap"),
            ),
        )
        return F.filter(stepped, lambda item: item["gap"].isNotNull())

    return df.select(*keys, F.inline(let(_placed(F.col(text)), gaps)))
