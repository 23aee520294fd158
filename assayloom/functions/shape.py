"""Shape of a result text and what to do with it."""

from __future__ import annotations

import string
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayloom import fixed_values as fixed
from assayloom.functions.text import matches
from assayloom.rules import TextRules


#: What a text is made of, one bit each.  Letters other than ``e`` stand apart, an ``e`` may be part of a number.
DIGIT, LETTER, WORD_LETTER, DOT, NEW_LINE, BEYOND_ASCII, DASH, LAST_PLUS, FIRST_SIGN, FIRST_STAR = (1 << i for i in range(10))

_FROM = string.digits + "eE" + "".join(c for c in string.ascii_letters if c not in "eE")
_TO = "0" * 10 + "ee" + "a" * 50


def signature(text: Column, longest: int) -> Column:
    """The bits of a text, from one pass over its first ``longest`` characters that turns each into its class.

    It tells which patterns can match at all, so most are not tried.
    """
    classes = F.translate(F.left(text, F.lit(longest)), _FROM, _TO)
    has = lambda sign: F.contains(classes, F.lit(sign))
    bits = {
        DIGIT: has("0"), LETTER: has("a") | has("e"), WORD_LETTER: has("a"), DOT: has("."), NEW_LINE: has("\n") | has("\r"),
        BEYOND_ASCII: F.octet_length(classes) != F.length(classes), DASH: has("-"), LAST_PLUS: F.endswith(text, F.lit("+")),
        FIRST_SIGN: F.left(text, F.lit(1)).isin("<", ">", "="), FIRST_STAR: F.startswith(text, F.lit("*")),
    }
    return reduce(add, [F.when(test, bit).otherwise(0) for bit, test in bits.items()])


def _gates(rules: TextRules, bits: Column) -> dict[str, Column]:
    """For each shape a test of the bits that its texts pass; texts beyond ASCII pass all."""
    def all_of(mask: int) -> Column:
        return bits.bitwiseAND(F.lit(mask)) == mask

    def none_of(mask: int) -> Column:
        return bits.bitwiseAND(F.lit(mask)) == 0

    gates = {
        "not_reported_sentinel": all_of(FIRST_STAR | DIGIT),
        "plain_numeric": all_of(DIGIT) & none_of(WORD_LETTER | FIRST_SIGN),
        "operator_numeric": all_of(DIGIT | FIRST_SIGN) & none_of(WORD_LETTER),
        "numeric_range": all_of(DIGIT | DASH) & none_of(LETTER),
        "ordinal_plus": all_of(DIGIT | LAST_PLUS) & none_of(LETTER),
        "mixed_text_numeric": all_of(DIGIT),
        "short_text": all_of(LETTER),
    }
    if rules.line_break == fixed.LINE_BREAK:
        gates["line_break"] = all_of(DOT | LETTER) | ~none_of(NEW_LINE)
    with_digit = {"verbal_operator_numeric", "qualifier_comparison"}
    for shape in rules.lettered() | with_digit | {"qualifier_ordinal"}:
        needs = LETTER if shape in rules.lettered() else 0
        needs |= DIGIT if shape in with_digit else DIGIT | LAST_PLUS if shape == "qualifier_ordinal" else 0
        gates[shape] = all_of(needs)
    return {shape: gate | ~none_of(BEYOND_ASCII) for shape, gate in gates.items()}


def shape(text: Column, rules: TextRules, bits: Column | None = None) -> Column:
    """One of the shapes; the order of the tests is the specification.

    With the ``bits`` of :func:`signature` a pattern is only tried on texts that can match it.
    """
    gates = {} if bits is None else _gates(rules, bits)

    def found(label: str, pattern: str) -> Column:
        return gates[label] & matches(text, pattern) if label in gates else matches(text, pattern)

    tests = [
        ("missing", text.isNull() | (text == "")),
        ("null_literal", found("null_literal", rf"(?i)^(?:{rules.null_words})\z")),
        ("not_reported_sentinel", found("not_reported_sentinel", rf"^{fixed.NOT_REPORTED}\z")),
        ("narrative_text", (F.length(text) > rules.narrative_length) | found("line_break", rules.line_break)),
    ]
    tests += [(label, found(label, pattern)) for label, pattern in rules.shape_patterns().items()]
    label, test = tests[0]
    chain = F.when(test, F.lit(label))
    for label, test in tests[1:]:
        chain = chain.when(test, F.lit(label))
    return chain.otherwise(F.lit("punctuation_or_junk"))


def ends_with_percent(text: Column) -> Column:
    return F.coalesce(F.endswith(text, F.lit(fixed.PERCENT_UNIT)), F.lit(False))


def percent_fits(text: Column, unit: Column) -> Column:
    """False when the value ends in ``%`` but another unit was recorded."""
    return ~ends_with_percent(text) | unit.isNull() | (unit == fixed.PERCENT_UNIT)


def split_action(shape_: Column, fits: Column) -> Column:
    return (
        F.when(shape_.isin(fixed.MISSING_SHAPES), F.lit("missing"))
        .when(shape_.isin(fixed.REVIEW_SHAPES) | ~fits, F.lit("review"))
        .otherwise(F.lit("split"))
    )
