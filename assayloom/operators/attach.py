"""Decisions on every source row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.operators.decide import decide, label_excluded
from assayloom.operators.keys import CODE, EXCLUDED_BY, KEYS, NEW_COLUMNS, RESULT, UNIT, source
from assayloom.operators.units import UnitRules
from assayloom.rules import TextRules

JOIN_KEYS = {"result": RESULT, "unit_recorded": UNIT, "code": CODE}
ROW_KEY = "_lab_row_key"
NO_VALUE = "\x00"


def lookup_table(decisions: DataFrame) -> DataFrame:
    """The 14 columns of each distinct (result, unit, code) of the decisions.

    They depend on these three alone, so ``distinct`` leaves one row per key.
    """
    inside = decisions.filter(F.col("excluded_by").isNull())
    return inside.select(*JOIN_KEYS, *NEW_COLUMNS).distinct()


def value_key(result: Column, unit: Column, code: Column) -> Column:
    """One number for the three keys; a missing one is not the same as an empty one."""
    return F.xxhash64(*[F.coalesce(c, F.lit(NO_VALUE)) for c in (result, unit, code)])


def attach(rows: DataFrame, lookup: DataFrame, label: str) -> DataFrame:
    """Join the lookup to rows with cleaned keys.

    The join compares one 64-bit number a row.  Rows that agree in it are then
    compared by their texts, null-safe: a missing value and an empty one are two
    different keys, no row is doubled, and equal numbers of different texts do
    no harm.  Excluded rows are not looked up.  The caller sees to the size of
    the lookup.
    """
    there = {key: f"_lab_lookup_{public}" for public, key in JOIN_KEYS.items()}
    right = lookup.withColumnsRenamed({public: there[key] for public, key in JOIN_KEYS.items()})
    right = right.withColumn("_lab_lookup_key", value_key(*[F.col(c) for c in there.values()]))
    inside = F.col(EXCLUDED_BY).isNull()
    left = rows.withColumn(ROW_KEY, F.when(inside, value_key(*[F.col(c) for c in there])))
    on = F.col(ROW_KEY) == F.col("_lab_lookup_key")
    for key, other in there.items():
        # written out, so that the texts do not become part of the hashed key
        on = on & F.coalesce(F.col(key) == F.col(other), F.col(key).isNull() & F.col(other).isNull())
    joined = left.join(right, on, "left").drop(*there.values(), "_lab_lookup_key", ROW_KEY)
    return joined.withColumn("shape", F.when(inside, F.col("shape")).otherwise(F.lit(label)))


def decide_in_place(rows: DataFrame, rules: TextRules, units: UnitRules, label: str) -> DataFrame:
    """The same columns without a lookup: each row is judged where it is.

    Moves no row, so it holds for any number of distinct values and any skew.
    """
    return label_excluded(decide(rows, rules, units), label)


def output_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Source columns (all, or the ones to keep) and the 14 new columns."""
    internal = {*KEYS, EXCLUDED_BY}
    kept = list(keep) or [c for c in df.columns if c not in internal and c not in NEW_COLUMNS]
    return df.select(*[source(c) for c in kept], *NEW_COLUMNS)
