"""Typed columns of a value that can be split.

All functions expect the cleaned text and its shape, or the words of it (see
:func:`words`).  They give null for shapes they do not apply to; the caller
blanks them for values that are not split.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayloom import fixed_values as fixed
from assayloom.functions.shape import ends_with_percent
from assayloom.functions.text import WORD, as_number, capture, first_label, matches, replace, without_gloss
from assayloom.rules import COMPARISONS, OPERATORS, TextRules

_RANGE = rf"^({fixed.NUMBER_SIMPLE})\s*{fixed.RANGE_SEPARATOR}\s*({fixed.NUMBER_SIMPLE})"


WORD_SHAPES = [*fixed.QUALITATIVE_SHAPES, "severity_grade", "verbal_operator_numeric"]


def words(text: Column, shape: Column) -> Column:
    """Lower-case text without a gloss, for shapes that are read by words.

    Many label patterns look at it, so make it a column of its own first.
    """
    return F.when(shape.isin(WORD_SHAPES), F.lower(without_gloss(text)))


def leading_operator(text: Column) -> Column:
    """Comparison token in front of a number, in its normal spelling."""
    token = capture(text, f"^(?:{OPERATORS})")
    chain = None
    for spelling, normal in fixed.OPERATOR_SPELLINGS:
        hit = matches(token, spelling)
        chain = F.when(hit, F.lit(normal)) if chain is None else chain.when(hit, F.lit(normal))
    return chain.otherwise(token)


def verbal_operator(plain: Column, rules: TextRules) -> Column:
    return first_label(plain, [(w, op) for w, op, _ in rules.verbal_operators], WORD)


def verbal_label(plain: Column, rules: TextRules) -> Column:
    return first_label(plain, [(w, label) for w, _, label in rules.verbal_operators], WORD)


def operator(text: Column, plain: Column, shape: Column, rules: TextRules) -> Column:
    return (
        F.when(shape == "operator_numeric", leading_operator(text))
        .when(shape.isin(fixed.ORDINAL_SHAPES), F.lit("+"))
        .when(shape == "verbal_operator_numeric", verbal_operator(plain, rules))
        .when(shape == "qualifier_comparison", capture(plain, f"(?:{COMPARISONS})"))
    )


def measured_number(text: Column, rules: TextRules) -> Column:
    """The number of a value that is one number with or without an operator."""
    lead = "(?:%s)" % "|".join([OPERATORS, *(word for word, _, _ in rules.verbal_operators)])
    bare = replace(text, rf"(?i)^{lead}\s*|,|\s*%\z")
    return as_number(bare)


def first_number(plain: Column) -> Column:
    return as_number(capture(plain, fixed.NUMBER_SIMPLE))


def number(text: Column, plain: Column, shape: Column, rules: TextRules) -> Column:
    return (
        F.when(shape == "plain_numeric", as_number(replace(text, r",|\s*%\z")))
        .when(shape.isin("operator_numeric", "verbal_operator_numeric"), measured_number(text, rules))
        .when(shape.isin(fixed.ORDINAL_SHAPES), as_number(capture(text, r"(\d+)\+", 1)))
        .when(shape.isin("qualifier_numeric", "qualifier_comparison"), first_number(plain))
    )


def range_low(text: Column, shape: Column) -> Column:
    return F.when(shape == "numeric_range", as_number(capture(text, _RANGE, 1)))


def range_high(text: Column, shape: Column) -> Column:
    return F.when(shape == "numeric_range", as_number(capture(text, _RANGE, 2)))


def unit(text: Column, shape: Column, recorded: Column) -> Column:
    """Words and ordinals have no unit; a trailing ``%`` is the unit."""
    has_no_unit = shape.isin(fixed.QUALITATIVE_SHAPES + ["ordinal_plus"])
    return F.when(~has_no_unit, F.when(ends_with_percent(text), F.lit(fixed.PERCENT_UNIT)).otherwise(recorded))


def value(plain: Column, shape: Column, rules: TextRules) -> Column:
    return F.when(shape == "qualifier_detection", first_label(plain, rules.detection_labels())).when(
        shape.isin(fixed.QUALITATIVE_SHAPES), first_label(plain, rules.qualifier_values)
    )


def qualifier(plain: Column, shape: Column, rules: TextRules) -> Column:
    modifiers = rules.modifier_ranges + rules.modifiers
    return (
        F.when(shape == "severity_grade", first_label(plain, rules.severity_grades, WORD))
        .when(shape.isin("qualifier_numeric", "qualifier_detection"), first_label(plain, modifiers, WORD))
        .when(shape == "verbal_operator_numeric", verbal_label(plain, rules))
    )
