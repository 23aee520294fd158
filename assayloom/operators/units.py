"""Unit spellings, the canonical unit, and registered conversions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom import fixed_values as fixed
from assayloom.functions.text import unit_key
from assayloom.operators import audits
from assayloom.operators.keys import CODE, source
from assayloom.sources import rule_tables

CANONICAL = "_lab_canonical"

#: Rule tables up to this many rows are sent to every executor.
RULE_ROWS = 100_000
#: A key with more than this share of the rows is frequent; the rules of such keys are sent even if the table is large.
HOT_SHARE = 1e-3
#: Groups over which rows without a rule to look for are spread.
NOWHERE = 1 << 20


def known_spellings(synonyms: DataFrame, conversions: DataFrame) -> DataFrame:
    """One spelling per unit key.

    A synonym row decides first.  After that, each unit to use and each unit of
    a conversion is known under its own spelling, the first one listed wins.
    An empty spelling means "not a unit".
    """
    synonym_rows = synonyms.select(
        unit_key(F.col("unit_as_recorded")).alias("unit_key"),
        F.col("unit_to_use").alias("spelling"),
        F.lit(0).alias("rank"),
        "pos",
    )

    def named(table: DataFrame, column: str, rank: int) -> DataFrame:
        rows = table.filter(F.col(column) != "")
        return rows.select(unit_key(F.col(column)).alias("unit_key"), F.col(column).alias("spelling"),
                           F.lit(rank).alias("rank"), "pos")

    every = (
        synonym_rows.unionByName(named(synonyms, "unit_to_use", 1))
        .unionByName(named(conversions, "unit_source", 2))
        .unionByName(named(conversions, "unit_target", 3))
    )
    return every.groupBy("unit_key").agg(F.min_by("spelling", F.struct("rank", "pos")).alias("spelling"))


def multiplier(method: Column, factor: Column, molar_mass: Column) -> Column:
    """What a number is multiplied with.  Molar mass is in g/mol."""
    return (
        F.when(method.isin("1", "9"), factor)
        .when(method == "4", factor * molar_mass)
        .when(method == "5", F.try_divide(factor, molar_mass))
        .otherwise(F.lit(1.0))
    )


def with_multiplier(conversions: DataFrame) -> DataFrame:
    return conversions.withColumn("multiplier", multiplier(F.col("method"), F.col("factor"), F.col("molar_mass")))


@dataclass(frozen=True)
class UnitRules:
    """Rule tables ready for the joins: ``unit_key, spelling`` and ``code, unit_source, …, multiplier``.

    ``large`` names the tables that are too large to send.
    """

    spellings: DataFrame
    conversions: DataFrame
    large: frozenset[str] = frozenset()

    @classmethod
    def load(cls, synonyms: DataFrame, conversions: DataFrame, check: bool = True) -> UnitRules:
        """Refuse bad rows in the rule tables, and keep small tables at hand for a broadcast."""
        if check:
            audits.refuse(audits.synonym_problems(synonyms), "unit synonyms")
            audits.refuse(audits.conversion_problems(conversions, synonyms), "unit conversions")
        registry = with_multiplier(conversions).select("code", "unit_source", "unit_target", "multiplier")
        tables = {"spellings": known_spellings(synonyms, conversions), "conversions": registry}
        pinned = {name: _pin(table) for name, table in tables.items()}
        large = frozenset(name for name, table in pinned.items() if table is None)
        return cls(**{name: tables[name] if name in large else table for name, table in pinned.items()}, large=large)

    @classmethod
    def default(cls, spark: SparkSession) -> UnitRules:
        """The shipped tables, checked and loaded once for each session."""
        known = _defaults.get(spark.sparkContext.applicationId)
        if known is None or known.spellings.sparkSession is not spark:
            known = cls.load(rule_tables.synonym_table(spark), rule_tables.conversion_table(spark))
            _defaults[spark.sparkContext.applicationId] = known
        return known


_defaults: dict[str, UnitRules] = {}


def _pin(rules: DataFrame) -> DataFrame | None:
    """A rule table of a checked size as a local relation with a broadcast hint; nothing for a larger one."""
    rows = rules.limit(RULE_ROWS + 1).toArrow()
    if rows.num_rows > RULE_ROWS:
        return None
    return F.broadcast(rules.sparkSession.createDataFrame(rows))


def hot_keys(rows: DataFrame, key: Column) -> list[str]:
    """Keys that own more than a share of all rows, by a sketch of bounded size; at most ``1 / HOT_SHARE``."""
    keys = rows.select(key.alias("k")).filter(F.col("k").isNotNull())
    most = int(1 / HOT_SHARE)
    found = keys.agg(F.expr(f"approx_top_k(k, {most}, {16 * most})").alias("top"), F.count("k").alias("n")).first()
    return [row["item"] for row in found["top"] or [] if row["count"] > found["n"] * HOT_SHARE]


def join_rules(rows: DataFrame, key: Column, rules: DataFrame, rule_key: str, columns: list[str]) -> DataFrame:
    """Left join to a rule table that is too large to send; ``rule_key`` is unique in it.

    The rules of keys that own many rows are few and are sent.  All other rows meet
    their rules in a shuffle by key.  Rows that already have a rule, or can not have
    one, are spread over all tasks, so no task gets the rows of a frequent key.
    """
    hot = hot_keys(rows, key)
    frequent = rules.filter(F.col(rule_key).isin(hot))
    sent = F.broadcast(frequent.select(F.col(rule_key).alias("_lab_hot_key"), *[F.col(c).alias(f"_lab_hot_{c}") for c in columns]))
    found = rows.withColumn("_lab_key", key).join(sent, F.col("_lab_key") == F.col("_lab_hot_key"), "left")
    settled = F.col("_lab_key").isNull() | F.col("_lab_key").isin(hot)
    hashed = [source(f.name) for f in rows.schema if not re.search("map<|variant", f.dataType.simpleString())]
    nowhere = F.concat(F.lit("\0"), F.pmod(F.xxhash64(F.lit(0), *hashed), F.lit(NOWHERE)).cast("string"))
    found = found.withColumn("_lab_way", F.when(settled, nowhere).otherwise(F.col("_lab_key")))
    others = rules.select(F.col(rule_key).alias("_lab_cold_key"), *[F.col(c).alias(f"_lab_cold_{c}") for c in columns])
    met = found.join(others, F.col("_lab_way") == F.col("_lab_cold_key"), "left")
    # a frequent key without a rule has none in either table
    out = {c: F.when(F.col("_lab_hot_key").isNotNull(), F.col(f"_lab_hot_{c}")).otherwise(F.col(f"_lab_cold_{c}")) for c in columns}
    return met.select(*[source(c) for c in rows.columns], *[value.alias(c) for c, value in out.items()])


def canonical_unit(df: DataFrame, spellings: DataFrame, unit: str, out: str, large: bool = False) -> DataFrame:
    """Add the agreed spelling of a unit; an unknown one stays as it is."""
    key = "_lab_unit_key"
    known = spellings.withColumnsRenamed({"unit_key": key, "spelling": "_lab_spelling"})
    if large:
        joined = join_rules(df, unit_key(F.col(unit)), known, key, ["_lab_spelling"])
    else:
        joined = df.join(known, unit_key(F.col(unit)) == F.col(key), "left").drop(key)
    spelling = F.nullif(F.coalesce("_lab_spelling", F.col(unit)), F.lit(""))
    return joined.withColumn(out, spelling).drop("_lab_spelling")


def is_numeric_split() -> Column:
    return F.col("shape").isin(fixed.NUMERIC_SHAPES) & (F.col("split_action") == "split")


def _pair(code: Column, unit: Column) -> Column:
    """One text for a code and a unit, null if one is missing; the length keeps pairs apart."""
    return F.concat(F.length(code).cast("string"), F.lit(":"), code, unit)


def standardise(df: DataFrame, conversions: DataFrame, large: bool = False) -> DataFrame:
    """Add converted copies of the numbers; pairs without a conversion are copied."""
    table = conversions.select(
        F.col("code").alias("_lab_reg_code"),
        F.col("unit_source").alias("_lab_reg_unit"),
        F.col("unit_target").alias("_lab_reg_target"),
        F.col("multiplier").alias("_lab_reg_multiplier"),
    )
    if large:
        paired = table.withColumn("_lab_reg_pair", _pair(F.col("_lab_reg_code"), F.col("_lab_reg_unit")))
        joined = join_rules(df, _pair(F.col(CODE), F.col("unit")), paired, "_lab_reg_pair", table.columns)
    else:
        on = (F.col(CODE) == F.col("_lab_reg_code")) & (F.col("unit") == F.col("_lab_reg_unit"))
        joined = df.join(table, on, "left")
    numeric = is_numeric_split()
    convert = numeric & F.col("_lab_reg_code").isNotNull()

    def converted(name: str) -> Column:
        return F.when(convert, F.col(name) * F.col("_lab_reg_multiplier")).otherwise(F.col(name))

    columns = [
        converted("number"),
        converted("range_low"),
        converted("range_high"),
        F.when(convert, F.col("_lab_reg_target")).otherwise(F.col("unit")),
        F.when(convert, F.lit("convert")).when(numeric, F.lit("not_registered")),
    ]
    return joined.withColumns(dict(zip(fixed.STANDARD_COLUMNS, columns))).drop(*table.columns)

