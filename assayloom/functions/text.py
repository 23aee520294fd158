"""Cleaning of text and small helpers around regular expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayloom import fixed_values as fixed

# Unicode White_Space.  ``trim`` without a list strips U+0020 only.
WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

_PUNCTUATION = "[" + re.escape(fixed.STRAY_PUNCTUATION) + "]+"
LEADING_PUNCTUATION = rf"^{_PUNCTUATION}(\p{{L}}+)\z"
TRAILING_PUNCTUATION = rf"^(\p{{L}}+){_PUNCTUATION}\z"


def unicode_pattern(pattern: str) -> str:
    """Classes such as ``\\d`` and ``\\s`` cover all of Unicode, not only ASCII."""
    return "(?U)" + pattern


def matches(text: Column, pattern: str) -> Column:
    return text.rlike(unicode_pattern(pattern))


def capture(text: Column, pattern: str, group: int = 0) -> Column:
    """The matched text, or null when there is no match."""
    return F.nullif(F.regexp_extract(text, unicode_pattern(pattern), group), F.lit(""))


def replace(text: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(text, unicode_pattern(pattern), by)


def as_number(text: Column) -> Column:
    return text.try_cast("double")


def first_label(text: Column, table, form: str = "{}") -> Column:
    """Label of the first pattern of the ordered table that is found in the text."""
    chain = None
    for pattern, label in table:
        found = matches(text, form.format(pattern))
        chain = F.when(found, F.lit(label)) if chain is None else chain.when(found, F.lit(label))
    return F.lit(None).cast("string") if chain is None else chain


WORD = r"\b(?:{})\b"


def _edges_in(text: Column, characters: str) -> Column:
    return F.left(text, F.lit(1)).isin(list(characters)) | F.right(text, F.lit(1)).isin(list(characters))


def strip(raw: Column) -> Column:
    """Text without white space at its ends; most values have none and are not searched."""
    text = raw.cast("string")
    return F.when(_edges_in(text, WHITE_SPACE), F.btrim(text, F.lit(WHITE_SPACE))).otherwise(text)


def tidy(text: Column) -> Column:
    """Trimmed text without full stops after a number or punctuation around a word.

    The three replacements can only apply when the first or last character is
    one of the punctuation marks, so all other values skip them.
    """
    cleaned = replace(text, fixed.NUMERIC_TRAILING_DOT, "$1")
    cleaned = replace(cleaned, LEADING_PUNCTUATION, "$1")
    cleaned = replace(cleaned, TRAILING_PUNCTUATION, "$1")
    return F.when(_edges_in(text, fixed.STRAY_PUNCTUATION), cleaned).otherwise(text)


def clean_result(raw: Column) -> Column:
    return tidy(strip(raw))


def clean_unit(raw: Column) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(strip(raw), F.lit(""))


def unit_key(unit: Column) -> Column:
    """Matching key of a unit spelling: no white space, lower case."""
    return F.lower(replace(unit, r"\s+"))


def without_gloss(text: Column) -> Column:
    """Text without an explanation in parentheses."""
    return replace(text, fixed.GLOSS)
