"""Checks of the rule tables.  Each gives one row per problem."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom import fixed_values as fixed
from assayloom.functions.text import unit_key


def synonym_problems(synonyms: DataFrame) -> DataFrame:
    """Spellings with one key must agree on the unit to use."""
    return (
        synonyms.groupBy(unit_key(F.col("unit_as_recorded")).alias("unit_key"))
        .agg(F.count_distinct("unit_to_use").alias("n_targets"),
             F.min("unit_to_use").alias("first_target"), F.max("unit_to_use").alias("last_target"))
        .filter(F.col("n_targets") > 1)
        .select("unit_key", "n_targets", "first_target", "last_target")
    )


def duplicate_pairs(conversions: DataFrame) -> DataFrame:
    return conversions.groupBy("code", "unit_source").count().filter(F.col("count") > 1).drop("count")


def spelling_clashes(conversions: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Units of conversions that share a key but differ in spelling, and no synonym decides; the first one listed wins.

    ``unit_key``, ``first_spelling``, ``last_spelling`` (in byte order), ``n_spellings``.
    """
    units = conversions.select(F.col("unit_source").alias("unit")).union(conversions.select("unit_target"))
    keyed = units.filter(F.col("unit") != "").withColumn("unit_key", unit_key(F.col("unit")))
    explicit = synonyms.select(unit_key(F.col("unit_as_recorded")).alias("unit_key")).distinct()
    return (
        keyed.join(explicit, "unit_key", "left_anti")
        .groupBy("unit_key")
        .agg(F.min("unit").alias("first_spelling"), F.max("unit").alias("last_spelling"),
             F.count_distinct("unit").alias("n_spellings"))
        .filter(F.col("n_spellings") > 1)
    )


def conversion_audit(conversions: DataFrame, synonyms: DataFrame) -> DataFrame:
    """The problems that refuse a registry, and the clashes of spellings that only ask for a synonym row."""
    clashes = spelling_clashes(conversions, synonyms).select(
        F.lit(None).cast("string").alias("code"), F.col("first_spelling").alias("unit_source"),
        F.col("last_spelling").alias("unit_target"), F.lit("spellings of one unit differ").alias("problem"))
    return conversion_problems(conversions, synonyms).unionByName(clashes)


def conversion_problems(conversions: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Rows ``code, unit_source, unit_target, problem``: what keeps a conversion from being safe."""
    agreed = synonyms.select(unit_key(F.col("unit_as_recorded")).alias("unit_key"), F.col("unit_to_use")).distinct()

    def agreed_spelling(column: str) -> DataFrame:
        return agreed.withColumnsRenamed({"unit_key": f"{column}_key", "unit_to_use": f"{column}_agreed"})

    rows = conversions
    for column in ("unit_source", "unit_target"):
        side = agreed_spelling(column)
        rows = rows.join(side, unit_key(F.col(column)) == F.col(f"{column}_key"), "left")

    def off(column: str):
        return (F.col(column) != "") & (F.col(f"{column}_agreed") != F.col(column))

    method = F.col("method")
    known = method.isin(fixed.CONVERSION_METHODS)
    found = F.array_compact(
        F.array(
            F.when(off("unit_source"), F.lit("source unit is not in the agreed spelling")),
            F.when(off("unit_target"), F.lit("target unit is not in the agreed spelling")),
            F.when(~known, F.lit("unknown method")),
            F.when(method.isin(fixed.METHODS_WITH_FACTOR) & F.col("factor").isNull(), F.lit("factor is missing")),
            F.when(method.isin(fixed.METHODS_WITH_MOLAR_MASS) & F.col("molar_mass").isNull(),
                   F.lit("molar mass is missing")),
        )
    )
    row_problems = rows.select("code", "unit_source", "unit_target", F.explode(found).alias("problem"))
    duplicates = duplicate_pairs(conversions).select(
        "code", "unit_source", F.lit(None).cast("string").alias("unit_target"), F.lit("duplicate pair").alias("problem")
    )
    return row_problems.unionByName(duplicates)


def refuse(problems: DataFrame, what: str) -> None:
    """Raise when there is a problem; names all of them, rule tables are small."""
    found = problems.collect()
    if found:
        raise ValueError(f"{what} refused, {len(found)} problems:\n  " + "\n  ".join(str(row.asDict()) for row in found))
