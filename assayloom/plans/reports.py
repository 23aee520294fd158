"""Reports.  Each reads the saved decisions (one row per file and distinct value).

``decisions`` also holds one row per file and reason for the excluded rows;
``excluded_by`` is null for everything that was judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom import fixed_values as fixed
from assayloom.operators.units import is_numeric_split

#: Up to this many rows per group Spark keeps only the best rows of each map task before the shuffle.
MAP_SIDE_TOP = 1000
TOP_BUCKETS = 256
#: Texts with so many first characters in common are joined together first.
PART_CHARS = 6


def in_scope(decisions: DataFrame) -> DataFrame:
    return decisions.filter(F.col("excluded_by").isNull())


def rows_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n_rows"))), F.lit(0))


def percent(part: Column, total: Column, digits: int) -> Column:
    return F.round(F.try_divide(F.lit(100.0) * part, total), digits)


def entries(rows: DataFrame, keys: list[Column], cells: dict[str, str]) -> DataFrame:
    """Long form of text cells: the keys, ``cell``, ``text``, ``n_rows`` for each different text of a column.

    ``cells`` names a column for each cell.  An empty text counts as none.
    """
    every = F.array(*[F.struct(F.lit(cell).alias("cell"), F.nullif(F.col(c), F.lit("")).alias("text")) for cell, c in cells.items()])
    names = rows.select(*keys).columns
    long = rows.select(*keys, "n_rows", F.explode(every).alias("_entry")).select(*names, "_entry.cell", "_entry.text", "n_rows")
    return long.groupBy(*names, "cell", "text").agg(F.sum("n_rows").alias("n_rows"))


def joined(rows: DataFrame, keys: list[Column], cells: dict[str, str], separators: dict[str, str] | None = None) -> DataFrame:
    """For each key ``n_rows``, the different texts of each cell in byte order as one text, and their number ``n_<cell>``.

    Texts are made different by a shuffle of their own.  Those with the same
    beginning are sorted and joined together, then such parts are put in order, so no
    task sorts all rows or all texts of a key.
    """
    separators = {cell: fixed.NAME_SEPARATOR for cell in cells} | (separators or {})
    names = rows.select(*keys).columns
    found = entries(rows, keys, cells).groupBy(*names, "cell", F.left("text", F.lit(PART_CHARS)).alias("_part")).agg(
        F.sum("n_rows").alias("n_rows"), F.count("text").alias("_n"), F.array_sort(F.collect_list("text")).alias("_texts"))
    cell = F.col("cell")
    text = None
    for name, separator in separators.items():
        of = F.array_join("_texts", separator)
        text = F.when(cell == name, of) if text is None else text.when(cell == name, of)
    found = found.withColumn("_text", text)
    first = next(iter(cells))
    out = [F.sum(F.when(cell == first, F.col("n_rows"))).alias("n_rows")]
    for name, separator in separators.items():
        parts = F.array_sort(F.collect_list(F.when((cell == name) & (F.col("_n") > 0), F.struct("_part", "_text"))))
        out.append(F.array_join(F.transform(parts, lambda part: part["_text"]), separator).alias(name))
        out.append(F.sum(F.when(cell == name, F.col("_n"))).alias(f"n_{name}"))
    return found.groupBy(*names).agg(*out)


# --- decisions and counts ------------------------------------------------------


def decisions_table(decisions: DataFrame) -> DataFrame:
    return in_scope(decisions).drop("excluded_by")


def action_counts(decisions: DataFrame) -> DataFrame:
    return in_scope(decisions).groupBy("file", "split_action").agg(F.sum("n_rows").alias("n_rows"))


def shape_counts(decisions: DataFrame) -> DataFrame:
    counts = in_scope(decisions).groupBy("file", "shape").agg(F.sum("n_rows").alias("n_rows"))
    return counts.orderBy("file", F.desc("n_rows"), "shape")


def excluded_counts(decisions: DataFrame) -> DataFrame:
    """Excluded rows per file, and those excluded by their order alone."""
    return decisions.groupBy("file").agg(
        rows_where(F.col("excluded_by").isNotNull()).alias("excluded_rows"),
        rows_where(F.col("excluded_by") == "link").alias("excluded_linked_rows"),
    )


def nothing_extracted() -> Column:
    empty = F.coalesce("number", "range_low").isNull() & F.coalesce("value", "qualifier").isNull()
    return (F.col("split_action") == "split") & empty


def parse_failures(decisions: DataFrame) -> DataFrame:
    return in_scope(decisions).groupBy("file").agg(rows_where(nothing_extracted()).alias("parse_failures"))


def conversion_status_counts(decisions: DataFrame) -> DataFrame:
    rows = in_scope(decisions).filter(F.col("conversion_status").isNotNull())
    return rows.groupBy("file", "conversion_status").agg(F.sum("n_rows").alias("n_rows")).orderBy(
        "file", "conversion_status"
    )


def _summary(decisions: DataFrame, extra: list[Column]) -> DataFrame:
    """Counts of each file, from the few groups of (reason of exclusion, action, shape); codes are counted beside."""
    inside = F.col("excluded_by").isNull()
    groups = decisions.groupBy("file", "excluded_by", "split_action", "shape").agg(
        F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("_values"), rows_where(nothing_extracted()).alias("_failures"))
    totals = groups.groupBy("file").agg(
        F.sum("n_rows").alias("total_rows"),
        rows_where(~inside).alias("excluded_rows"),
        rows_where(F.col("excluded_by") == "link").alias("excluded_linked_rows"),
        rows_where(inside).alias("in_scope_rows"),
        *[rows_where(inside & (F.col("split_action") == a)).alias(f"{a}_rows") for a in ("split", "missing", "review")],
        F.coalesce(F.sum(F.when(inside, F.col("_values"))), F.lit(0)).alias("distinct_values"),
        F.coalesce(F.sum(F.when(inside, F.col("_failures"))), F.lit(0)).alias("parse_failures"),
        *extra,
    )
    # no code is one code
    codes = in_scope(decisions).filter(F.col("split_action") == "review").select("file", "code").distinct()
    codes = codes.groupBy("file").agg(F.count(F.lit(1)).alias("codes_in_review"))
    names = [c for c in totals.columns if c != "parse_failures"]
    at = names.index("distinct_values") + 1
    both = totals.join(codes, "file", "left").fillna(0, ["codes_in_review"])
    return both.select(*names[:at], "codes_in_review", "parse_failures", *names[at:])


def file_summary(decisions: DataFrame) -> DataFrame:
    """All counts of a file in one aggregation."""
    return _summary(decisions, [])


def distribution_comparison(decisions: DataFrame, written: DataFrame | None = None, files: DataFrame | None = None) -> DataFrame:
    """One row per file: shares of actions and shapes in percent of all rows.

    ``written`` has ``file, rows_written`` when harmonized rows were written.
    ``files`` may name all files of the run (``file``): one without rows then has
    its own row, with counts of zero and no shares.
    """
    inside = F.col("excluded_by").isNull()
    shapes = [rows_where(inside & (F.col("shape") == s)).alias(f"_{s}") for s in fixed.SHAPES]
    facts = _summary(decisions, shapes)
    if files is not None:
        counts = [c for c in facts.columns if c != "file"]
        facts = files.select("file").join(facts, "file", "left").fillna(0, counts)
    total = F.col("total_rows")
    shares = facts.select(
        "file",
        "total_rows",
        "excluded_rows",
        "excluded_linked_rows",
        *[percent(F.col(f"{a}_rows"), total, 2).alias(f"{a}_pct") for a in ("split", "missing", "review")],
        "codes_in_review",
        "parse_failures",
        F.lit(None).cast("long").alias("rows_written"),
        F.lit(None).cast("boolean").alias("row_count_match"),
        *[percent(F.col(f"_{s}"), total, 3).alias(f"shape_{s}_pct") for s in sorted(fixed.SHAPES)],
    )
    return (shares if written is None else with_written(shares, written)).orderBy("file")


def with_written(distribution: DataFrame, written: DataFrame) -> DataFrame:
    """Fill in the written rows (``file, rows_written``); a file without any has lost them all."""
    columns = distribution.columns
    both = distribution.drop("rows_written", "row_count_match").join(written.select("file", "rows_written"), "file", "left")
    both = both.fillna(0, ["rows_written"])
    return both.withColumn("row_count_match", F.col("rows_written") == F.col("total_rows")).select(columns)


def review_spread(distribution: DataFrame) -> DataFrame:
    low, high = F.min("review_pct"), F.max("review_pct")
    return distribution.agg(
        low.alias("min_review_pct"), high.alias("max_review_pct"), F.round(high - low, 2).alias("spread")
    )


def row_count_check(source_counts: DataFrame, written_counts: DataFrame) -> DataFrame:
    """Source rows against written rows of each file (``file, total_rows`` and ``file, rows_written``)."""
    both = source_counts.join(written_counts, "file", "full")
    total, out = F.coalesce("total_rows", F.lit(0)), F.coalesce("rows_written", F.lit(0))
    return both.select("file", total.alias("total_rows"), out.alias("rows_written"),
                       (total == out).alias("row_count_match"))


# --- review ----------------------------------------------------------------------


def top_per_file(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """The first ``k`` rows of each file.  ``order`` must leave no ties.

    A small ``k`` is cut inside each map task before the shuffle.  A larger one
    is first cut within hash buckets of a file, so that no task sorts a whole
    file; the best of a file are among the best of its buckets.
    """
    rank = F.row_number().over(Window.partitionBy("file").orderBy(*order))
    if k > MAP_SIDE_TOP:
        keys = [c for c in ("result", "unit_recorded", "code", "name") if c in df.columns]
        df = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(TOP_BUCKETS)))
        within = F.row_number().over(Window.partitionBy("file", "_bucket").orderBy(*order))
        df = df.withColumn("_rank", within).filter(F.col("_rank") <= k).drop("_rank", "_bucket")
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def review_top(decisions: DataFrame, k: int = fixed.REVIEW_TOP_N) -> DataFrame:
    """Most frequent values in review per file; ties go by the keys."""
    review = decisions_table(decisions).filter(F.col("split_action") == "review")
    order = [F.desc("n_rows"), *[F.asc_nulls_first(c) for c in ("result", "unit_recorded", "code", "name")]]
    return top_per_file(review, k, order)


# --- units -----------------------------------------------------------------------


def _numeric(decisions: DataFrame) -> DataFrame:
    return in_scope(decisions).filter(is_numeric_split())


def unit_pairs(decisions: DataFrame) -> DataFrame:
    """Numeric (code, unit) pairs of each file."""
    keys = [F.col(c) for c in ("file", "code", "unit", "conversion_status")]
    return joined(_numeric(decisions), keys, {"test_names": "name"}).drop("n_test_names")


def conversions_used(decisions: DataFrame) -> DataFrame:
    """Conversions applied in each file."""
    used = _numeric(decisions).filter(F.col("conversion_status") == "convert")
    keys = [F.col("file"), F.col("code"), F.col("unit").alias("unit_source"), F.col("unit_std").alias("unit_target")]
    return joined(used, keys, {"test_names": "name"}).drop("n_test_names")


def unregistered_per_file(decisions: DataFrame) -> DataFrame:
    pairs = _numeric(decisions).groupBy("file", "code", "unit", "conversion_status").agg(
        F.sum("n_rows").alias("n_rows"))
    open_ = F.col("conversion_status") == "not_registered"
    return pairs.groupBy("file").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count(F.when(open_, 1)).alias("unregistered_pairs"),
        rows_where(open_).alias("unregistered_rows"),
    )


def _over_files(decisions: DataFrame, keys: list[Column]) -> DataFrame:
    """The keys, ``test_names``, ``n_rows``, ``n_files``, ``files``."""
    return joined(decisions, keys, {"test_names": "name", "files": "file"}, {"files": fixed.FILE_SEPARATOR}).drop("n_test_names")


def multi_unit_codes(decisions: DataFrame) -> DataFrame:
    """Codes with more than one unit over all files; no unit is not a second unit."""
    pairs = _numeric(decisions).filter(F.col("unit").isNotNull()).select("code", "unit").distinct()
    return pairs.groupBy("code").agg(F.count(F.lit(1)).alias("n_units")).filter(F.col("n_units") > 1)


def units_not_registered(decisions: DataFrame, conversions: DataFrame) -> DataFrame:
    """Open pairs: codes with several units, without a conversion, and not the unit that others convert to."""
    targets = conversions.select("code", F.col("unit_target").alias("unit")).distinct()
    open_pairs = _numeric(decisions).filter(F.col("conversion_status") == "not_registered")
    per_pair = _over_files(open_pairs, [F.col("code"), F.col("unit")])
    return (
        per_pair.join(multi_unit_codes(decisions).select("code"), "code", "left_semi")
        .withColumn("unit", F.coalesce("unit", F.lit(fixed.BLANK_UNIT)))
        .join(targets, ["code", "unit"], "left_anti")
        .select("code", "unit", "test_names", "n_rows", "n_files", "files")
        .orderBy("code", F.desc("n_rows"), "unit")
    )


def conversions_applied(decisions: DataFrame) -> DataFrame:
    """Each applied conversion over all files."""
    used = _numeric(decisions).filter(F.col("conversion_status") == "convert")
    keys = [F.col("code"), F.col("unit").alias("unit_source"), F.col("unit_std").alias("unit_target")]
    return (
        _over_files(used, keys)
        .select("code", "unit_source", "unit_target", "test_names", "n_rows", "n_files", "files")
        .orderBy("code", F.desc("n_rows"), "unit_source", "unit_target")
    )


#: Cell of the dictionary -> column of the decisions.
DICTIONARY = {"test_names": "name", "units_recorded": "unit_recorded", "units_used": "unit"}


def dictionary_entries(decisions: DataFrame) -> DataFrame:
    """``code``, ``cell``, ``text``, ``n_rows``: each name and unit of a code over all files, one to a row."""
    return entries(in_scope(decisions), [F.col("code")], DICTIONARY).filter(F.col("text").isNotNull())


def code_dictionary(decisions: DataFrame) -> DataFrame:
    """Names and units of each code over all files."""
    found = joined(in_scope(decisions), [F.col("code")], DICTIONARY | {"files": "file"})
    return found.select("code", *DICTIONARY, "n_rows", "n_files").orderBy("code")
