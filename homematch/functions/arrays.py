"""Feature-list expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def mentions(features: Column, word: str) -> Column:
    """Whether any feature holds a word, in any case."""
    return F.coalesce(F.exists(features, lambda item: F.lower(item).contains(word)), F.lit(False))


def list_or_empty(features: Column) -> Column:
    """Feature list, empty where missing."""
    return F.coalesce(features, F.array().cast("array<string>"))


def parsed_list(text: Column, single_quoted: bool = False) -> Column:
    """List of strings in a JSON text, null where it is malformed."""
    source = F.translate(text, "'", '"') if single_quoted else text
    return F.from_json(source, "array<string>", {"allowSingleQuotes": "false"})
