"""Features from strings. All native expressions, all over the whole string."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def honorific(name: Column) -> Column:
    """Letters before the first dot that follows letters: "Kelly, Mr. James" -> "Mr"."""
    return F.regexp_extract(name, r"([A-Za-z]+)\.", 1)


def honorific_by_split(name: Column) -> Column:
    """The same by cutting at the dot and the comma; keeps the blank after the comma."""
    return F.substring_index(F.substring_index(name, ".", 1), ",", -1)


def lookup(value: Column, codes: Mapping[str, int]) -> Column:
    """Code of a string from a literal map; null where the map has no entry."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(codes.items())])[value]


def text_shape(text: Column) -> dict[str, Column]:
    """Length, word count, share of distinct words, share of ASCII letters.

    Words are runs without white space; a text without words has none, and a share of 0.
    """
    words = F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    letters = F.length(F.regexp_replace(text, "[^A-Za-z]", ""))
    length = F.length(text)
    return {
        "text_chars": length.cast("double"),
        "text_words": F.size(words).cast("double"),
        "distinct_word_share": F.when(F.size(words) > 0, F.size(F.array_distinct(words)) / F.size(words))
                                .when(length >= 0, F.lit(0.0)),
        "letter_share": F.when(length > 0, letters / length).otherwise(F.lit(0.0)),
    }
