"""Unit spellings and conversions, from files or from the fixed values."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom import fixed_values as fixed
from assayloom.functions.text import as_number, strip

SYNONYM_SCHEMA = pa.schema(
    [("unit_as_recorded", pa.string()), ("unit_to_use", pa.string()), ("pos", pa.int64())]
)
CONVERSION_SCHEMA = pa.schema(
    [
        ("code", pa.string()), ("unit_source", pa.string()), ("unit_target", pa.string()),
        ("method", pa.string()), ("factor", pa.float64()), ("molar_mass", pa.float64()), ("pos", pa.int64()),
    ]
)


def _table(spark: SparkSession, rows, schema: pa.Schema) -> DataFrame:
    """A short rule list with the position of each row.  From Arrow it becomes a local relation."""
    names = schema.names
    records = [dict(zip(names, (*row, i))) for i, row in enumerate(rows)]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=schema))


def synonym_table(spark: SparkSession, rows=fixed.UNIT_SYNONYMS) -> DataFrame:
    """``(unit as recorded, unit to use)`` rows."""
    return _table(spark, rows, SYNONYM_SCHEMA)


def conversion_table(spark: SparkSession, rows=fixed.UNIT_CONVERSIONS) -> DataFrame:
    """``(code, unit source, unit target, method, factor, molar mass)`` rows."""
    return _table(spark, rows, CONVERSION_SCHEMA)


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return table.withColumn("pos", F.monotonically_increasing_id())


def clean_synonyms(table: DataFrame) -> DataFrame:
    """Trimmed rows with a spelling; no unit to use means "not a unit"."""
    text = {c: F.coalesce(strip(F.col(c)), F.lit("")) for c in ("unit_as_recorded", "unit_to_use")}
    return table.withColumns(text).filter(F.col("unit_as_recorded") != "")


def clean_conversions(table: DataFrame) -> DataFrame:
    """Trimmed text; a factor or molar mass that is not a number becomes null."""
    text = {c: F.coalesce(strip(F.col(c)), F.lit("")) for c in ("code", "unit_source", "unit_target", "method")}
    numbers = {c: as_number(F.col(c).cast("string")) for c in ("factor", "molar_mass")}
    return table.withColumns(text | numbers)


def read_synonyms(spark: SparkSession, path: str) -> DataFrame:
    """CSV with ``unit_as_recorded,unit_to_use,note``."""
    return clean_synonyms(_read_csv(spark, path))


def read_conversions(spark: SparkSession, path: str) -> DataFrame:
    """CSV with ``code,unit_source,unit_target,method,factor,molar_mass`` and notes."""
    return clean_conversions(_read_csv(spark, path))
