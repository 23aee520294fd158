"""Rule sets: the word tables and the patterns built from them.

A :class:`TextRules` is plain immutable data.  To add a word, make a copy with
``dataclasses.replace`` and pass it to the functions that take ``rules``.

Patterns are written for text that went through
:func:`assayloom.functions.text.clean_result`, so there is no white space at
either end.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from assayloom import fixed_values as fixed


#: Signs that compare, as alternatives.
OPERATORS, COMPARISONS = "|".join(fixed.OPERATOR_TOKENS), "|".join(fixed.COMPARISON_TOKENS)


def alternatives(table) -> str:
    """One group of all patterns of a table, in its order."""
    patterns = [pattern for pattern, *_ in table]
    return f"(?:{'|'.join(patterns)})"


def always_has_letter(pattern: str) -> bool:
    """Whether every text that matches has a letter: each alternative has one that is not optional.

    Careful, not complete: classes and escapes count as no letter, nor do groups
    that capture or look around, and a pattern that is not understood has none.
    """
    if re.search(r"\\[^sSdDwWbB.\-+*?()|/^$]|\[[^]]*[\[(]", pattern):
        return False
    found, branches, at = False, [], 0
    while at < len(pattern):
        sign, has, after = pattern[at], False, at + 1
        if sign == "\\":
            after = at + 2
        elif sign == "[":
            after = pattern.index("]", at + 2) + 1
        elif sign == "(":
            after, depth = at + 1, 1
            while depth:
                depth += {"(": 1, ")": -1}.get(pattern[after], 0) if pattern[after - 1] != "\\" else 0
                after += 1
            inner = pattern[at + 1 : after - 1]
            has = inner.startswith("?:") and always_has_letter(inner[2:])
        elif sign == "|":
            branches.append(found)
            found = False
        else:
            has = sign.isascii() and sign.isalpha()
        optional = after < len(pattern) and pattern[after] in "?*{"
        found = found or (has and not optional)
        at = after
    return all([*branches, found])


@dataclass(frozen=True)
class TextRules:
    """Everything that decides how a result text is read."""

    narrative_length: int = fixed.NARRATIVE_LENGTH
    line_break: str = fixed.LINE_BREAK
    null_words: str = fixed.NULL_WORDS
    verbal_operators: tuple = tuple(fixed.VERBAL_OPERATORS)
    qualifier_values: tuple = tuple(fixed.QUALIFIER_VALUES)
    modifier_ranges: tuple = tuple(fixed.MODIFIER_RANGES)
    modifiers: tuple = tuple(fixed.MODIFIERS)
    detection_values: tuple = tuple(fixed.DETECTION_VALUES)
    severity_grades: tuple = tuple(fixed.SEVERITY_GRADES)
    vocabulary: tuple = tuple(fixed.NEAR_MISS_VOCABULARY)
    max_distance: int = fixed.NEAR_MISS_MAX_DISTANCE

    def shape_patterns(self) -> dict[str, str]:
        """Shape -> pattern, in the order in which they are tried."""
        parts = {
            "number": f"(?:{fixed.NUMBER_CORE}|{fixed.NUMBER_LEADING_DOT})",
            "simple": fixed.NUMBER_SIMPLE,
            "separator": fixed.RANGE_SEPARATOR,
            "standalone": fixed.STANDALONE_NUMBER,
            "gloss": f"(?:{fixed.GLOSS})?",
            "sign": f"(?:{OPERATORS})",
            "compare": f"(?:{COMPARISONS})",
            "verbal": alternatives(self.verbal_operators),
            "quality": alternatives(self.qualifier_values),
            "modifier": alternatives(self.modifiers),
            "any_modifier": alternatives(self.modifier_ranges + self.modifiers),
            "detection": alternatives(self.detection_values),
            "severity": alternatives(self.severity_grades),
        }
        return {shape: template.format(**parts) for shape, template in fixed.SHAPE_PATTERNS}

    def lettered(self) -> set[str]:
        """Shapes that only a text with a letter can have, as the word tables stand."""
        words = {
            "null_literal": [(self.null_words,)],
            "verbal_operator_numeric": self.verbal_operators,
            "qualifier_numeric": self.qualifier_values,
            "qualifier_ordinal": self.qualifier_values,
            "qualifier_comparison": self.qualifier_values,
            "qualifier_detection": self.detection_values,
            "severity_grade": self.severity_grades,
        }
        return {shape for shape, table in words.items() if table and all(always_has_letter(row[0]) for row in table)}

    def detection_labels(self) -> list[tuple[str, str]]:
        """Detection phrase -> label, for lower-case text without a gloss."""
        lead = rf"^(?:{alternatives(self.modifiers)}\s+)?"
        return [(rf"{lead}(?:{word})\.?\z", label) for word, label in self.detection_values]


@dataclass(frozen=True)
class LabColumns:
    """Names of the columns of a lab table that have a role.

    ``name`` and ``link`` may be ``None``: no test name, no order link.
    ``position`` is the row number inside the source file, when there is one.
    """

    code: str = "CODE_TEST"
    result: str = "RESULT_VAL"
    unit: str = "UNIT"
    name: str | None = "SHORT_TEST"
    link: str | None = "OBS_ID"
    file: str = "file"
    position: str | None = None


@dataclass(frozen=True)
class ScopeRules:
    """Which rows are out of scope."""

    prefixes: tuple = tuple(fixed.EXCLUDED_CODE_PREFIXES)
    exclude_linked: bool = True
    label: str = fixed.EXCLUDED_SHAPE


@dataclass(frozen=True)
class RuleSet:
    text: TextRules = field(default_factory=TextRules)
    scope: ScopeRules = field(default_factory=ScopeRules)
    columns: LabColumns = field(default_factory=LabColumns)
