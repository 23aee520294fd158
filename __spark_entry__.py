"""Registered queries and their SQL.

Queries over the lab view share one :class:`~assayloom.Harmonization` per
session and scale: the linked orders, the decisions and the harmonized rows are
written once to the shared folder, reports read the written tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from assayloom import Harmonization, LabColumns, RuleSet, ScopeRules, harmonize_folder, open_lab, read_lab
from assayloom import fixed_values as fixed
from assayloom.functions.shape import ends_with_percent
from assayloom.functions.text import WORD, clean_result, clean_unit, first_label, unit_key, without_gloss
from assayloom.operators import audits, keys, scope, units
from assayloom.plans import reports
from assayloom.plans.checked import write_checked
from assayloom.plans.periods import Periods
from assayloom.sources import rule_tables, sinks
from assayloom.sources.store import discard, list_folder, new_path, publish
from labview import LAB_VIEW, WIDE_VIEW, lab_rows

try:
    import corpus_pipeline
    from assayloom.llm import queries as llm
    from assayloom.llm import sql as llm_sql
except ImportError:  # the library also works without that package, or without what it needs
    corpus_pipeline = None

_studies: dict[tuple[str, str, str], Study] = {}


class Study(Harmonization):
    """A lab view at one scale."""

    def __init__(self, spark: SparkSession, sf_dir: str, view: str = LAB_VIEW, **limits: int):
        self.spark, self.sf_dir = spark, sf_dir
        self.rows = lab_rows(spark, sf_dir, view)
        super().__init__(self.rows, **limits)
        self._written: DataFrame | None = None

    @cached_property
    def folder(self) -> str:
        """The view as a folder of lab files, one for each period."""
        parts, folder = new_path(self.spark, "lab-parts"), new_path(self.spark, "lab")
        self.rows.repartition("file").write.partitionBy("file").parquet(parts)
        self.rows.sparkSession.createDataFrame([], "none int").write.parquet(folder)  # makes the folder
        for period in list_folder(self.spark, parts):
            if period.startswith("file="):
                inside = [name for name in list_folder(self.spark, f"{parts}/{period}") if name.startswith("part-")]
                publish(self.spark, f"{parts}/{period}/{inside[0]}", f"{folder}/{period[5:]}.lab.parquet")
        discard(self.spark, parts)
        return folder

    @cached_property
    def run(self) -> str:
        """A whole run over that folder, from files to files."""
        output = new_path(self.spark, "run")
        harmonize_folder(self.spark, self.folder, output, pattern=LAB_FILES)
        return output

    @property
    def written(self) -> DataFrame:
        """Rows per file of the harmonized output, read back after writing."""
        if self._written is None:
            path = new_path(self.spark, "harmonized")
            rows = self.harmonized()
            sinks.write_harmonized(rows, path)
            back = self.spark.read.schema(rows.schema).option("basePath", path).parquet(path)
            self._written = sinks.written_counts(back)
        return self._written


def study(spark: SparkSession, sf_dir: str, view: str = LAB_VIEW) -> Study:
    where = (spark.sparkContext.applicationId, sf_dir, view)
    if where not in _studies:
        _studies[where] = Study(spark, sf_dir, view)
    return _studies[where]


Query = Callable[[SparkSession, str], DataFrame]
LAB_FILES = "*.lab.parquet"


def over_study(build: Callable[[Study], DataFrame], view: str = LAB_VIEW) -> Query:
    return lambda spark, sf_dir: build(study(spark, sf_dir, view))


def over_decisions(build: Callable[[DataFrame], DataFrame], view: str = LAB_VIEW) -> Query:
    return over_study(lambda s: build(s.decisions), view)


ROW = ["file", "OBS_ID", "LINE_NO"]


def keyed(s: Study, *columns: str) -> DataFrame:
    """Rows with their cleaned keys under public names."""
    public = {
        keys.RESULT: "result", keys.UNIT: "unit_recorded", keys.CODE: "code",
        keys.NAME: "name", keys.EXCLUDED_BY: "excluded_by",
    }
    rows = s.keyed_rows().drop("unit_recorded").withColumnsRenamed(public)
    return rows.select(*ROW, *columns)


def scope_by_link_shuffled(s: Study) -> DataFrame:
    """The link rule as it runs when the orders are too many for a broadcast."""
    flagged = scope.flag_scope(s.source, s.columns, ScopeRules(), s.linked, broadcast=False)
    rows = flagged.select(*ROW, F.col("CODE_TEST").alias("code"), F.col(keys.EXCLUDED_BY).alias("excluded_by"))
    return rows.filter(F.col("excluded_by").isNotNull())


def scope_by_link_filtered(s: Study) -> DataFrame:
    """The link rule as it runs with a filter of the orders, which moves no row."""
    return keyed(Study(s.spark, s.sf_dir, broadcast_rows=0), "code", "excluded_by").filter(F.col("excluded_by").isNotNull())


def scope_by_prefix(s: Study) -> DataFrame:
    excluded = F.coalesce(scope.prefix_test(s.columns, ScopeRules()), F.lit(False))
    return s.source.select(*ROW, F.col("CODE_TEST").alias("code"), excluded.alias("excluded"))


def units_recorded(s: Study) -> DataFrame:
    """Rows per recorded unit; small, and the base of the rule table reports."""
    unit = clean_unit(F.col("UNIT")).alias("unit_recorded")
    return s.rows.select(unit).groupBy("unit_recorded").agg(F.count(F.lit(1)).alias("n_rows"))


def unit_keys(s: Study) -> DataFrame:
    return units_recorded(s).withColumn("unit_key", unit_key(F.col("unit_recorded")))


def usage(rules: DataFrame, used: DataFrame, on: list[str]) -> DataFrame:
    """Rule rows with the number of lab rows they apply to."""
    counts = used.groupBy(*on).agg(F.sum("n_rows").alias("n_rows"))
    return rules.join(counts, on, "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


def unit_synonym_dim(s: Study) -> DataFrame:
    table = rule_tables.synonym_table(s.spark).withColumn("unit_key", unit_key(F.col("unit_as_recorded")))
    return usage(table, unit_keys(s), ["unit_key"]).select("unit_as_recorded", "unit_to_use", "n_rows")


def known_spellings(s: Study) -> DataFrame:
    known = units.known_spellings(rule_tables.synonym_table(s.spark), rule_tables.conversion_table(s.spark))
    return usage(known, unit_keys(s), ["unit_key"]).select("unit_key", "spelling", "n_rows")


def conversion_dim(s: Study) -> DataFrame:
    table = rule_tables.conversion_table(s.spark).drop("pos")
    numeric = s.decisions.filter(F.col("conversion_status").isNotNull())
    return usage(table, numeric.withColumn("unit_source", F.col("unit")), ["code", "unit_source"])


def conversion_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every method over all order lines, with factor and molar mass from the line."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    methods = F.array(*[F.lit(m) for m in fixed.CONVERSION_METHODS])
    method = F.element_at(methods, F.col("l_linenumber") % 5 + 1)
    return lines.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        method.alias("method"),
        F.col("l_extendedprice").alias("number"),
        (F.col("l_extendedprice") * units.multiplier(method, F.col("l_discount"), F.col("l_quantity"))).alias("number_std"),
    )


def grouped(decisions: DataFrame, *columns: str) -> DataFrame:
    return reports.in_scope(decisions).groupBy(*columns).agg(F.sum("n_rows").alias("n_rows"))


def typed(shapes: list[str], *columns: str) -> Query:
    def build(decisions: DataFrame) -> DataFrame:
        rows = decisions.filter(F.col("shape").isin(shapes))
        return grouped(rows, "result", "unit_recorded", "shape", "split_action", *columns)

    return over_decisions(build)


def percent_guard(s: Study) -> DataFrame:
    rows = reports.in_scope(s.decisions).filter(ends_with_percent(F.col("result")))
    rows = units.canonical_unit(rows, s.units.spellings, "unit_recorded", "canonical")
    return grouped(rows, "result", "unit_recorded", "canonical", "shape", "split_action")


def label_qualifier(s: Study) -> DataFrame:
    rules = s.rules.text
    values = reports.in_scope(s.decisions).groupBy("result").agg(F.sum("n_rows").alias("n_rows"))
    plain = values.withColumn("_plain", F.lower(without_gloss(F.col("result"))))
    modifiers = rules.modifier_ranges + rules.modifiers
    return plain.select(
        "result",
        first_label(F.col("_plain"), rules.qualifier_values).alias("value_label"),
        first_label(F.col("_plain"), modifiers, WORD).alias("modifier_label"),
        "n_rows",
    )


def canonical_unit(s: Study) -> DataFrame:
    rows = units.canonical_unit(reports.in_scope(s.decisions).drop("unit"), s.units.spellings, "unit_recorded", "unit")
    return grouped(rows.withColumn("excluded_by", F.lit(None)), "unit_recorded", "unit")


def convert_units(decisions: DataFrame) -> DataFrame:
    rows = decisions.filter(F.col("conversion_status").isNotNull())
    return grouped(
        rows, "code", "result", "unit", "number", "range_low", "range_high",
        "number_std", "range_low_std", "range_high_std", "unit_std", "conversion_status",
    )


def excluded_label(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("file", "shape").agg(F.sum("n_rows").alias("n_rows"))


def distribution(s: Study) -> DataFrame:
    return reports.distribution_comparison(s.decisions, s.written)


def row_count_check(s: Study) -> DataFrame:
    source = s.source.groupBy("file").agg(F.count(F.lit(1)).alias("total_rows"))
    return reports.row_count_check(source, s.written)


def near_miss_indexed(s: Study) -> DataFrame:
    """The near misses with the vocabulary as a table that is joined."""
    words = s.spark.createDataFrame([(w,) for w in s.rules.text.vocabulary], "word string")
    return s.near_misses(words)


def audit_synonyms(s: Study) -> DataFrame:
    """Were each recorded unit its own agreed spelling, which would clash?"""
    seen = units_recorded(s).filter(F.col("unit_recorded").isNotNull())
    proposed = seen.select(F.col("unit_recorded").alias("unit_as_recorded"), F.col("unit_recorded").alias("unit_to_use"))
    return audits.synonym_problems(proposed)


def audit_registry(s: Study) -> DataFrame:
    """Problems of a registry proposed from the data, with figures taken from the row counts."""
    numeric = s.decisions.filter(
        F.col("conversion_status").isNotNull() & F.col("code").isNotNull() & F.col("unit_recorded").isNotNull()
    )
    pairs = numeric.groupBy("code", "unit_recorded", "name").agg(F.sum("n_rows").alias("n"))
    n = F.col("n")
    proposed = pairs.select(
        "code",
        F.col("unit_recorded").alias("unit_source"),
        F.when(n % 2 == 0, F.lit("mg/dL")).otherwise(F.lit("MG%")).alias("unit_target"),
        (n % 11).cast("string").alias("method"),
        F.when(n % 3 != 0, n.cast("double")).alias("factor"),
        F.when(n % 5 != 0, n.cast("double")).alias("molar_mass"),
    )
    return audits.conversion_audit(proposed, rule_tables.synonym_table(s.spark))


def document_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents read as a lab file: the language is the code, the source the unit; whole texts, in several languages."""
    roles = LabColumns(code="lang", result="text", unit="source", name=None, link=None)
    rows, roles = read_lab(spark, sf_dir, ["documents.parquet"], columns=roles)
    n_chars = F.length(clean_result(F.col("text"))).cast("long").alias("n_chars")
    return Harmonization(rows, RuleSet(columns=roles)).harmonized_in_place().select(
        "file", "doc_id", n_chars, "shape", "split_action", "unit")


def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files with different columns, listed by name; their texts counted by shape."""
    roles = LabColumns(code="text", result="text", unit="text", name=None, link=None)
    files = ["documents.parquet", "benchmark.parquet", "conversations.parquet"]
    rows, roles = read_lab(spark, sf_dir, files, columns=roles)
    shapes = Harmonization(rows, RuleSet(columns=roles)).harmonized_in_place()
    n_chars = F.sum(F.length(clean_result(F.col("text")))).alias("n_chars")
    return shapes.groupBy("file", "shape").agg(F.count(F.lit(1)).alias("n_rows"), n_chars)


# --- through files -------------------------------------------------------------


def period(name: str = "file"):
    """Name of a lab file without its ending."""
    return F.regexp_replace(name, r"\.lab\.parquet$", "").alias("file")


def folder_rows(s: Study) -> DataFrame:
    rows = open_lab(s.spark, s.folder, pattern=LAB_FILES).rows
    return rows.select(period(), "OBS_ID", "LINE_NO", "CODE_TEST", "SHORT_TEST", "RESULT_VAL", "UNIT")


def folder_harmonized(s: Study) -> DataFrame:
    """The harmonized rows as a whole run left them in its output folder."""
    rows = s.spark.read.option("basePath", f"{s.run}/harmonized").parquet(f"{s.run}/harmonized").drop("source_row")
    return rows.withColumn("file", period())


def folder_distribution(s: Study) -> DataFrame:
    """The report that the whole run wrote."""
    schema = reports.distribution_comparison(s.decisions).schema
    return sinks.read_csv_table(s.spark, f"{s.run}/distribution_comparison", schema).withColumn("file", period())


def written_content(s: Study) -> DataFrame:
    return write_checked(s, new_path(s.spark, "checked"))


def periods_update(s: Study) -> DataFrame:
    """Decisions after two updates: all files but the last, then the whole folder."""
    files = sorted(name for name in list_folder(s.spark, s.folder) if name.endswith(".lab.parquet"))
    store = Periods(s.spark, new_path(s.spark, "periods"))
    store.update(s.folder, files[:-1], LAB_FILES)
    update = store.update(s.folder, pattern=LAB_FILES)
    return reports.decisions_table(update.decisions).withColumn("file", period())


def decisions_file(s: Study) -> DataFrame:
    table, path = reports.decisions_table(s.decisions), new_path(s.spark, "decisions-csv")
    sinks.write_decisions(table, path, "csv")
    return sinks.read_csv_table(s.spark, path, table.schema)


def report_file(s: Study) -> DataFrame:
    report, path = reports.code_dictionary(s.decisions), new_path(s.spark, "report-csv")
    sinks.write_report(report, path)
    return sinks.read_csv_table(s.spark, path, report.schema)


def synonyms_file(s: Study) -> DataFrame:
    """Spellings proposed from the recorded units, through a CSV file and its reader."""
    units_ = s.rows.filter(F.col("UNIT").isNotNull()).groupBy("UNIT").agg(F.count(F.lit(1)).alias("n"))
    proposed = units_.select(
        F.col("UNIT").alias("unit_as_recorded"), F.when(F.col("n") % 3 != 0, F.upper("UNIT")).alias("unit_to_use"),
        F.lit('a "note", with signs').alias("note"))
    path = new_path(s.spark, "synonyms-csv")
    sinks.write_report(proposed, path)
    return rule_tables.read_synonyms(s.spark, path).select("unit_as_recorded", "unit_to_use")


def conversions_file(s: Study) -> DataFrame:
    """Conversions proposed from the recorded units, through a CSV file and its reader; a factor may be no number."""
    known = s.rows.filter(F.col("CODE_TEST").isNotNull() & F.col("UNIT").isNotNull())
    pairs, n = known.groupBy("CODE_TEST", "UNIT").agg(F.count(F.lit(1)).alias("n")), F.col("n")
    proposed = pairs.select(
        F.col("CODE_TEST").alias("code"), F.col("UNIT").alias("unit_source"), F.lit(" mg/dL ").alias("unit_target"),
        (n % 5).cast("string").alias("method"), F.when(n % 3 != 0, (n / 8.0).cast("string")).otherwise("unknown").alias("factor"),
        F.when(n % 7 != 0, n).alias("molar_mass"), F.lit("x").alias("note"))
    path = new_path(s.spark, "conversions-csv")
    sinks.write_report(proposed, path)
    return rule_tables.read_conversions(s.spark, path).select("code", "unit_source", "unit_target", "method", "factor", "molar_mass")


def queries() -> dict[str, Query]:
    return lab_queries() | (llm.queries() | {"pipeline": corpus_pipeline.run} if corpus_pipeline else {})


def lab_queries() -> dict[str, Query]:
    return {
        "lab_scan": over_study(lambda s: keyed(s, "result", "unit_recorded", "code", "name", "excluded_by")),
        "normalize_result": over_study(
            lambda s: s.rows.select(*ROW, F.col("RESULT_VAL").alias("result_raw"),
                                    clean_result(F.col("RESULT_VAL")).alias("result"))),
        "normalize_unit": over_study(
            lambda s: s.rows.select(*ROW, F.col("UNIT").alias("unit_raw"),
                                    clean_unit(F.col("UNIT")).alias("unit_recorded"))),
        "unit_key": over_study(unit_keys),
        "scope_by_prefix": over_study(scope_by_prefix),
        "linked_orders": over_study(lambda s: s.linked.withColumnRenamed(scope.LINK, "link")),
        "scope_by_link": over_study(
            lambda s: keyed(s, "code", "excluded_by").filter(F.col("excluded_by").isNotNull())),
        "scope_by_link_shuffled": over_study(scope_by_link_shuffled),
        "scope_by_link_filtered": over_study(scope_by_link_filtered),
        "excluded_counts": over_decisions(reports.excluded_counts),
        "distinct_values": over_decisions(
            lambda d: reports.in_scope(d).select("file", "result", "unit_recorded", "code", "name", "n_rows")),
        "shape_classify": over_decisions(lambda d: grouped(d, "result", "shape")),
        "split_action": over_decisions(lambda d: grouped(d, "result", "unit_recorded", "shape", "split_action")),
        "percent_guard": over_study(percent_guard),
        "label_qualifier": over_study(label_qualifier),
        "typed_operator": typed(["operator_numeric"], "operator"),
        "typed_verbal": typed(["verbal_operator_numeric"], "operator", "number", "qualifier"),
        "typed_ordinal": typed(fixed.ORDINAL_SHAPES, "operator", "number"),
        "typed_comparison": typed(["qualifier_comparison"], "operator", "number", "value"),
        "typed_number": typed(["plain_numeric", "operator_numeric", "verbal_operator_numeric"], "number"),
        "typed_range": typed(["numeric_range"], "range_low", "range_high"),
        "typed_qualifier": typed(["qualifier_numeric", "qualifier_detection"], "number", "value", "qualifier"),
        "typed_value": typed(fixed.QUALITATIVE_SHAPES, "value"),
        "typed_severity": typed(["severity_grade"], "qualifier"),
        "typed_unit": typed(fixed.SHAPES, "unit"),
        "canonical_unit": over_study(canonical_unit),
        "unit_synonym_dim": over_study(unit_synonym_dim),
        "known_spellings": over_study(known_spellings),
        "conversion_dim": over_study(conversion_dim),
        "conversion_methods": conversion_methods,
        "convert_units": over_decisions(convert_units),
        "decisions": over_decisions(reports.decisions_table),
        "harmonized_rows": over_study(lambda s: s.harmonized()),
        "harmonized_in_place": over_study(lambda s: s.harmonized_in_place()),
        "action_counts": over_decisions(reports.action_counts),
        "shape_counts": over_decisions(reports.shape_counts),
        "excluded_label": over_decisions(excluded_label),
        "parse_failures": over_decisions(reports.parse_failures),
        "file_summary": over_decisions(reports.file_summary),
        "conversion_status_counts": over_decisions(reports.conversion_status_counts),
        "distribution_comparison": over_study(distribution),
        "review_spread": over_study(lambda s: reports.review_spread(distribution(s))),
        "row_count_check": over_study(row_count_check),
        "review_top": over_decisions(reports.review_top),
        "near_miss": over_study(lambda s: s.near_misses()),
        "near_miss_indexed": over_study(near_miss_indexed),
        "unit_pairs": over_decisions(reports.unit_pairs),
        "conversions_used": over_decisions(reports.conversions_used),
        "unregistered_per_file": over_decisions(reports.unregistered_per_file),
        "multi_unit_codes": over_decisions(reports.multi_unit_codes),
        "units_not_registered": over_study(lambda s: s.units_not_registered()),
        "conversions_applied": over_decisions(reports.conversions_applied),
        "code_dictionary": over_decisions(reports.code_dictionary),
        "audit_synonyms": over_study(audit_synonyms),
        "audit_registry": over_study(audit_registry),
        "document_shapes": document_shapes,
        "text_files": text_files,
        "code_dictionary_long": over_decisions(reports.dictionary_entries),
        "folder_rows": over_study(folder_rows),
        "folder_harmonized": over_study(folder_harmonized),
        "folder_distribution": over_study(folder_distribution),
        "written_content": over_study(written_content),
        "periods_update": over_study(periods_update),
        "decisions_file": over_study(decisions_file),
        "report_file": over_study(report_file),
        "synonyms_file": over_study(synonyms_file),
        "conversions_file": over_study(conversions_file),
        "wide_decisions": over_decisions(reports.decisions_table, WIDE_VIEW),
        "wide_harmonized": over_study(lambda s: s.harmonized(), WIDE_VIEW),
        "wide_parse_failures": over_decisions(reports.parse_failures, WIDE_VIEW),
        "wide_conversions_applied": over_decisions(reports.conversions_applied, WIDE_VIEW),
    }


def oracle_sql() -> dict[str, str]:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline and corpus_pipeline.ORACLE_SQL else {}
    return oracles.oracle_sql() | (llm_sql.oracle_sql() if corpus_pipeline else {}) | pipeline


def entry(spark: SparkSession) -> DataFrame:
    """Rows per shape and file."""
    return queries()["shape_counts"](spark, "/root/testdata/sf0.001")
