"""Harmonized rows that become visible only when their content is proven.

The rows are written to a staged folder, which readers do not see, and read back
once.  Two digests are compared for each file: the source columns against the
source rows, and each value with its 14 columns against the decisions, counted by
their rows.  The second one is made from the decisions alone, not from the plan
that wrote the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.functions.text import clean_result, clean_unit
from assayloom.operators.digest import content_digest, hash_sums, row_hash, whole_sum
from assayloom.operators.keys import NEW_COLUMNS, source
from assayloom.plans.together import side_by_side
from assayloom.sources import sinks
from assayloom.sources.store import discard, path_exists, publish, staged_path


if TYPE_CHECKING:
    from assayloom.plans.run import Harmonization


class ContentMismatch(RuntimeError):
    """Written rows are not the source rows with their decisions."""


def _judged(label: str, value: Sequence[Column]) -> Column:
    """Hash of the 14 columns of a row, with its value unless it was excluded."""
    inside = F.col("shape") != label
    return row_hash([*(F.when(inside, key) for key in value), *[F.col(name) for name in NEW_COLUMNS]])


def decided_digest(decisions: DataFrame, label: str, with_value: bool = True) -> DataFrame:
    """``file``, ``n_rows``, ``digest`` that written rows must have by the decisions."""
    value = [F.col(c) for c in ("result", "unit_recorded", "code")] if with_value else []
    hashed = decisions.select("file", "n_rows", _judged(label, value).alias("_hash"))
    sums = hashed.groupBy("file").agg(F.sum("n_rows").alias("n"), *hash_sums(F.col("_hash"), F.col("n_rows")))
    return sums.select("file", F.col("n").alias("n_rows"), whole_sum())


def written_digests(job: Harmonization, written: DataFrame, columns: Sequence[str], with_value: bool = True) -> DataFrame:
    """``file``, ``n_rows``, ``source``, ``decided``: both digests of written rows, in one pass."""
    roles = job.columns
    value = []
    if with_value:
        value = [clean_result(source(roles.result)), clean_unit(source(roles.unit)), source(roles.code).cast("string")]
    kinds = [written.schema[c].dataType for c in columns]
    hashed = written.select(
        source(roles.file).alias("file"), row_hash([source(c) for c in columns], kinds).alias("_source"),
        _judged(job.rules.scope.label, value).alias("_decided"))
    sums = hashed.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"), *hash_sums(F.col("_source"), name="source"), *hash_sums(F.col("_decided"), name="decided"))
    return sums.select("file", "n_rows", whole_sum("source"), whole_sum("decided"))


def _has_value(job: Harmonization, columns: Sequence[str]) -> bool:
    return {job.columns.result, job.columns.unit, job.columns.code} <= set(columns)


def expected_digests(job: Harmonization, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Digests of the source columns and of the decisions, for each file."""
    before = content_digest(job.source, [source(c) for c in columns], source(job.columns.file))
    return before, decided_digest(job.decisions, job.rules.scope.label, _has_value(job, columns))


def agreement(before: DataFrame, decided: DataFrame, after: DataFrame) -> DataFrame:
    """``file``, ``total_rows``, ``rows_written`` and whether rows, source columns and decisions agree, for each file."""
    both = before.withColumnsRenamed({"n_rows": "total_rows", "digest": "_source"}).join(
        decided.withColumnsRenamed({"n_rows": "_decided_rows", "digest": "_decided"}), "file", "full").join(
        after.withColumnRenamed("n_rows", "rows_written"), "file", "full")
    total, out = F.coalesce("total_rows", F.lit(0)), F.coalesce("rows_written", F.lit(0))
    agrees = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    return both.select(
        "file", total.alias("total_rows"), out.alias("rows_written"), (total == out).alias("row_count_match"),
        agrees("source", "_source").alias("source_match"),
        (agrees("decided", "_decided") & agrees("rows_written", "_decided_rows")).alias("decisions_match"))


def content_check(job: Harmonization, written: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The :func:`agreement` of written rows with the job.

    ``columns`` are the source columns that were written, the file is one of them.
    Without the columns of the value, the decisions are compared file by file and
    not value by value.  A file that is on one side only agrees in nothing.
    """
    return agreement(*expected_digests(job, columns), written_digests(job, written, columns, _has_value(job, columns)))


def write_checked(job: Harmonization, path: str, keep: Sequence[str] = (), clustered: bool = False,
                  compression: str | None = None) -> DataFrame:
    """Write all rows, prove their content and make them visible at ``path``; gives the check of each file.

    Raises :class:`ContentMismatch` and leaves the rows in the staged folder, with its
    name in the message, when a file does not agree.  ``path`` must not exist.
    """
    spark = job.source.sparkSession
    if path_exists(spark, path):
        raise FileExistsError(path)
    staged = staged_path(path)
    rows = job.harmonized(job.output_keep(keep))
    columns = [c for c in rows.columns if c not in NEW_COLUMNS]
    before, decided = expected_digests(job, columns)
    # what is expected is counted while the rows are written; a row for each file comes back
    done = side_by_side({
        "write": lambda: sinks.write_harmonized(rows, staged, job.columns.position, clustered, compression, job.columns.file),
        "before": before.toArrow,
        "decided": decided.toArrow,
    })
    after = written_digests(job, sinks.read_harmonized(spark, staged, rows.schema), columns, _has_value(job, columns)).toArrow()
    found = agreement(*[spark.createDataFrame(table) for table in (done["before"], done["decided"], after)])
    found = spark.createDataFrame(found.orderBy("file").toArrow())
    wrong = found.filter(~(F.col("row_count_match") & F.col("source_match") & F.col("decisions_match"))).collect()
    if wrong:
        raise ContentMismatch(f"{len(wrong)} files differ, rows are kept in {staged}:\n  " + "\n  ".join(str(r.asDict()) for r in wrong))
    publish(spark, staged, path)
    return found


def discard_staged(job: Harmonization, path: str) -> None:
    """Remove what a failed write left in its staged folder."""
    discard(job.source.sparkSession, staged_path(path))
