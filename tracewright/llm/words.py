"""Words of a text as SQL expressions: maximal runs of characters other than the six ASCII white spaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"
WHITE_RUN = "[\\x20\\x09-\\x0D]+"


def text_of(text: Column) -> Column:
    """The text, or an empty one where it is null."""
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words in order; empty for null, empty and blank texts."""
    trimmed = F.btrim(text_of(text), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_RUN))


def count_chars(text: Column, chars: str) -> Column:
    """How many code points of the text are one of `chars`."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def sealed(df: DataFrame, columns: list[str]) -> DataFrame:
    """The frame with these columns computed once, whatever is filtered on them later.

    A filter on a computed column is pushed below its projection with the whole expression put in
    place of the column, also inside of lambda functions, where it would run once per element. Filters
    on what a generator returns stay above it.
    """
    rest = [c for c in df.columns if c not in columns]
    packed = df.select(*[F.col(f"`{c}`") for c in rest], F.explode(F.array(F.struct(*columns))).alias("_sealed"))
    return packed.select(*[F.col(f"`{c}`") for c in rest], *[F.col(f"_sealed.{c}").alias(c) for c in columns])
