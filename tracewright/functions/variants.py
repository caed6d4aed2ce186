"""Model output and open arguments as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fence markers looked for in a response.
FENCE = "```"
TAGGED_FENCE = "```json"


def strict_json(text: Column) -> Column:
    """VARIANT of a text that is exactly one JSON document, else null.

    The parser accepts trailing text, so the document is wrapped into a list that must hold
    exactly one element.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    items = F.try_variant_get(wrapped, "$", "array<variant>")
    return F.when(F.size(items) == 1, items[0])


def parse_response(text: Column) -> Column:
    """The whole text, else the part in the first tagged (or else plain) closed fence."""
    body = F.trim(text, F.lit(" \t\n\r\x0b\x0c"))
    tagged = F.regexp_extract(body, f"(?s){TAGGED_FENCE}(.*?){FENCE}", 1)
    plain = F.regexp_extract(body, f"(?s){FENCE}(.*?){FENCE}", 1)
    fenced = F.when(F.contains(body, F.lit(TAGGED_FENCE)), strict_json(tagged)).otherwise(
        strict_json(plain)
    )
    return F.coalesce(strict_json(body), fenced)


def field(value: Column, path: str, as_type: str) -> Column:
    """A field of a VARIANT, null when missing or not of the type."""
    return F.try_variant_get(value, path, as_type)


def is_string(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def string_field(value: Column, path: str) -> Column:
    """A field only if it really is a string (no cast from numbers)."""
    inner = F.try_variant_get(value, path, "variant")
    return F.when(is_string(inner), F.try_variant_get(inner, "$", "string"))


def string_value(value: Column) -> Column:
    return F.when(is_string(value), F.try_variant_get(value, "$", "string"))
