"""Text keys: normalisation, hashes, language flag, numbers in ids."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that compose with nothing and are their own composed form: Latin with its
# extensions, basic Cyrillic, dashes and quotes, CJK ideographs. Text made of these alone is
# already in NFC and never leaves the JVM.
_ALREADY_COMPOSED = (
    r"^[\x{0000}-\x{02FF}\x{0400}-\x{0482}\x{048A}-\x{04FF}\x{1E00}-\x{1EFF}"
    r"\x{2010}-\x{2027}\x{20A0}-\x{20BF}\x{4E00}-\x{9FFF}]*$"
)


@F.pandas_udf(T.StringType())
def _compose(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None else unicodedata.normalize("NFC", t))


def nfc(text: Column) -> Column:
    """Canonical composition. Only text outside the safe blocks is sent to Python."""
    settled = text.rlike(_ALREADY_COMPOSED)
    return F.when(settled, text).otherwise(_compose(F.when(~settled, text)))


def normalize_text(text: Column) -> Column:
    """Lower case, composed, without punctuation, single spaces."""
    words = F.regexp_replace(nfc(F.lower(text)), r"(?U)[^\p{L}\p{N}_\s]", "")
    return F.trim(F.regexp_replace(words, r"(?U)\s+", " "))


def short_hash(text: Column) -> Column:
    """First 64 bits of SHA-256, as 16 hex digits."""
    return F.substring(F.sha2(text, 256), 1, 16)


def hash_fraction(key: Column) -> Column:
    """A uniform number in [0, 1) that depends on the key alone."""
    digits = F.conv(F.substring(F.sha2(key, 256), 1, 13), 16, 10).cast("double")
    return digits / F.lit(float(16**13))


def hash_choice(key: Column, options: list[str]) -> Column:
    """One of the options, picked by the key's hash."""
    number = F.conv(F.substring(F.sha2(key, 256), 1, 15), 16, 10).cast("bigint")
    index = F.pmod(number, F.lit(len(options))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(o) for o in options]), index)


def trace_structure(gold_trace: Column) -> Column:
    """The tool sequence of a trace, arguments ignored."""
    return F.array_join(F.transform(gold_trace, lambda s: F.coalesce(s.tool, F.lit(""))), "|")


def trace_structure_hash(gold_trace: Column) -> Column:
    return short_hash(trace_structure(gold_trace))


def language_of(text: Column) -> Column:
    """`en` when more than nine tenths of the characters are ASCII, else `vi`."""
    ascii_chars = F.length(F.regexp_replace(text, r"[^\x00-\x7F]", ""))
    return F.when(ascii_chars / F.greatest(F.length(text), F.lit(1)) > 0.9, "en").otherwise("vi")


def scenario_number(scenario_id: Column) -> Column:
    """The integer after the last underscore, else 0."""
    return F.coalesce(F.substring_index(scenario_id, "_", -1).try_cast("int"), F.lit(0))


def percent_of(value: Column, whole: Column) -> Column:
    return value * 100 / F.greatest(whole, F.lit(1))


def padded(prefix: str, number: Column, width: int) -> Column:
    """`prefix` followed by the number with leading zeros; longer numbers stay whole."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))
