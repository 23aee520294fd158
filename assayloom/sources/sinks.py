"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assayloom.operators.keys import source

FILE_COLUMN = "file"
#: White space at the ends of a text is part of it.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_harmonized(
    rows: DataFrame,
    path: str,
    position: str | None = None,
    clustered: bool = False,
    compression: str | None = None,
    file_column: str = FILE_COLUMN,
) -> None:
    """One folder per source file with all its rows.

    Rows are written by the task that read them, without a shuffle and in the
    order of the scan; a position column states the place of each row in its
    source file.  ``clustered`` lays the files out in that order: a range
    shuffle on (file, position), which spreads a large source file over many
    tasks.
    """
    order = [file_column, position] if position else [file_column]
    if clustered and not position:
        raise ValueError("the source order needs a position column")
    if clustered:
        rows = rows.repartitionByRange(*order)
    side_by_side = int(rows.sparkSession.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0
    if clustered or not side_by_side:
        rows = rows.sortWithinPartitions(*order)  # the writer would sort by file anyway
    writer = rows.write.partitionBy(file_column)
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)


def read_harmonized(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Written rows with the columns of the table that was written."""
    # the column of the folders comes last when they are read
    return spark.read.schema(schema).option("basePath", path).parquet(path).select([source(c) for c in schema.names])


def written_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(FILE_COLUMN).agg(F.count(F.lit(1)).alias("rows_written"))


def write_decisions(decisions: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Decisions of each file, the most frequent first."""
    keys = [F.asc_nulls_first(c) for c in ("result", "unit_recorded", "code", "name")]
    ordered = decisions.orderBy(FILE_COLUMN, F.desc("n_rows"), *keys)
    writer = ordered.write.partitionBy(FILE_COLUMN)
    if fmt == "csv":
        writer.options(**CSV).csv(path)
    else:
        writer.parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """CSV with a header, in the order of the report."""
    report.write.options(**CSV).csv(path)


def read_csv_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that was written as CSV, with missing and empty texts apart."""
    apart = {"multiLine": True, "nullValue": "\0", "emptyValue": "", "basePath": path}
    return spark.read.schema(schema).options(**CSV, **apart).csv(path)
