"""Shape, action, typed columns and standard columns of each value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom import fixed_values as fixed
from assayloom.functions import shape as shapes
from assayloom.functions import typed
from assayloom.operators.keys import CODE, EXCLUDED_BY, KEYS, NAME, NEW_COLUMNS, RESULT, UNIT, source
from assayloom.operators.units import CANONICAL, UnitRules, canonical_unit, standardise
from assayloom.rules import LabColumns, TextRules

WORDS = "_lab_words"
BITS = "_lab_bits_of_text"


def value_counts(rows: DataFrame, columns: LabColumns) -> DataFrame:
    """Rows per file and distinct (result, unit, code, name).

    ``rows`` carry the cleaned keys and the reason of exclusion.  All excluded
    rows of a file fall into one group per reason, so the same pass also counts
    them.  A frequent value is added up inside each map task before the shuffle.
    """
    inside = F.col(EXCLUDED_BY).isNull()
    keys = [F.when(inside, F.col(key)).alias(key) for key in KEYS]
    return (
        rows.select(source(columns.file).alias("file"), EXCLUDED_BY, *keys)
        .groupBy("file", EXCLUDED_BY, *KEYS)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def classify(df: DataFrame, rules: TextRules) -> DataFrame:
    """Add shape, action and the seven typed columns.

    Expects the cleaned result and the canonical unit.  Each step is its own
    projection, so the chain of patterns runs once per value.
    """
    text, unit = F.col(RESULT), F.col(CANONICAL)
    shape = F.col("shape")
    # texts that are longer are narrative, whatever follows
    df = df.withColumn(BITS, shapes.signature(text, rules.narrative_length + 1))
    df = df.withColumn("shape", shapes.shape(text, rules, F.col(BITS))).drop(BITS)
    df = df.withColumn("split_action", shapes.split_action(shape, shapes.percent_fits(text, unit)))
    df = df.withColumn(WORDS, typed.words(text, shape))
    plain = F.col(WORDS)
    columns = {
        "operator": typed.operator(text, plain, shape, rules),
        "number": typed.number(text, plain, shape, rules),
        "range_low": typed.range_low(text, shape),
        "range_high": typed.range_high(text, shape),
        "unit": typed.unit(text, shape, unit),
        "value": typed.value(plain, shape, rules),
        "qualifier": typed.qualifier(plain, shape, rules),
    }
    split = F.col("split_action") == "split"
    return df.withColumns({name: F.when(split, column) for name, column in columns.items()}).drop(WORDS)


def decide(df: DataFrame, rules: TextRules, units: UnitRules) -> DataFrame:
    """Add all 14 columns to a table that has the cleaned keys."""
    df = canonical_unit(df, units.spellings, UNIT, CANONICAL, "spellings" in units.large)
    df = classify(df, rules).drop(CANONICAL)
    return standardise(df, units.conversions, "conversions" in units.large)


def label_excluded(df: DataFrame, label: str = fixed.EXCLUDED_SHAPE) -> DataFrame:
    """Excluded rows get the label as shape and null in the other 13 columns."""
    inside = F.col(EXCLUDED_BY).isNull()
    columns = {name: F.when(inside, F.col(name)) for name in NEW_COLUMNS}
    columns["shape"] = F.when(inside, F.col("shape")).otherwise(F.lit(label))
    return df.withColumns(columns)


def decision_columns(df: DataFrame) -> DataFrame:
    """Public names: ``result``, ``unit_recorded``, ``code``, ``name``."""
    return df.select(
        "file",
        F.col(EXCLUDED_BY).alias("excluded_by"),
        F.col(RESULT).alias("result"),
        F.col(UNIT).alias("unit_recorded"),
        F.col(CODE).alias("code"),
        F.col(NAME).alias("name"),
        "n_rows",
        *NEW_COLUMNS,
    )

