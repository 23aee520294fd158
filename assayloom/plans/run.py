"""One harmonization of a lab table, from rows to decisions, reports and files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom import fixed_values as fixed
from assayloom.operators.attach import JOIN_KEYS, attach, decide_in_place, lookup_table, output_columns
from assayloom.operators.decide import decide, decision_columns, label_excluded, value_counts
from assayloom.operators.keys import protect_source, with_keys
from assayloom.operators.near_miss import near_misses, near_misses_among
from assayloom.operators.scope import OrderFilter, flag_scope, linked_orders, order_words, wrong_hits
from assayloom.operators.units import UnitRules
from assayloom.plans import reports
from assayloom.plans.checked import write_checked
from assayloom.plans.together import side_by_side
from assayloom.rules import LabColumns, RuleSet, ScopeRules, TextRules
from assayloom.session import prepare
from assayloom.sources import sinks
from assayloom.sources.lab import check_columns, open_lab
from assayloom.sources.rule_tables import conversion_table, read_conversions, read_synonyms, synonym_table
from assayloom.sources.store import BROADCAST_BYTES, BROADCAST_ROWS, discard, fits_broadcast, new_path, save_measured, save_table


#: Columns of the decisions that are not part of the lookup.
NOT_LOOKED_UP = ("file", "excluded_by", "name")


class Harmonization:
    """Decisions and reports of one lab table.

    Two tables are written to the shared folder when first needed: the orders
    that exclude other rows, and the decisions.  Every report reads the saved
    decisions, so each source row is scanned, cleaned and counted once and each
    distinct value is judged once.  ``linked`` may give the orders (one column,
    as of :func:`linked_orders`) when the rows are only some of the files.  ``close`` removes the saved tables; a job is
    also a context manager that closes itself.
    """

    def __init__(
        self,
        rows: DataFrame,
        rules: RuleSet = RuleSet(),
        units: UnitRules | None = None,
        broadcast_rows: int = BROADCAST_ROWS,
        broadcast_bytes: int = BROADCAST_BYTES,
        linked: DataFrame | None = None,
    ):
        check_columns(rows, rules.columns)
        prepare(rows.sparkSession)
        self.rules = rules
        self.source, self.columns = protect_source(rows, rules.columns)
        self.units = units or UnitRules.default(rows.sparkSession)
        self.limits = (broadcast_rows, broadcast_bytes)
        self.others_limits = (BROADCAST_ROWS, BROADCAST_BYTES)
        self._saved: list[str] = []
        self._known_linked = linked

    def __enter__(self) -> Harmonization:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Remove the tables that this job saved; nothing that reads them works any more."""
        while self._saved:
            discard(self.source.sparkSession, self._saved.pop())

    def _save(self, df: DataFrame, name: str) -> DataFrame:
        self._saved.append(new_path(df.sparkSession, name))
        return save_table(df, name, self._saved[-1])

    def _fits(self, size: tuple[int, int]) -> bool:
        """Whether a table of so many rows and bytes may be sent to every executor."""
        return all(measured <= limit for measured, limit in zip(size, self.limits))

    @cached_property
    def linked(self) -> DataFrame | None:
        """Orders with an excluded row; ``None`` when the link rule is off."""
        if not (self.rules.scope.exclude_linked and self.columns.link):
            return None
        orders = self._known_linked
        if orders is None:
            orders = linked_orders(self.source, self.columns, self.rules.scope)
        self._saved.append(new_path(orders.sparkSession, "linked-orders"))
        saved, self._linked_size = save_measured(orders, self._saved[-1])
        return saved

    @cached_property
    def _broadcast_linked(self) -> bool:
        return self.linked is not None and self._fits(self._linked_size)

    @cached_property
    def order_filter(self) -> OrderFilter | None:
        """Orders that are too many to send: a filter of bounded size and, if they are few, the other orders that pass it."""
        if self.linked is None or self._broadcast_linked:
            return None
        words = self._save(order_words(self.linked, self.linked.count()), "order-words")
        others = self._save(wrong_hits(self.source, self.columns, self.linked, words), "other-orders")
        return OrderFilter(words, others if fits_broadcast(others, *self.others_limits) else None)

    def keyed_rows(self) -> DataFrame:
        """Source rows with cleaned keys and the reason of exclusion."""
        flagged = flag_scope(self.source, self.columns, self.rules.scope, self.linked, self._broadcast_linked, self.order_filter)
        return with_keys(flagged, self.columns)

    def value_counts(self) -> DataFrame:
        return value_counts(self.keyed_rows(), self.columns)

    def decide(self, df: DataFrame) -> DataFrame:
        return decide(df, self.rules.text, self.units)

    @cached_property
    def decisions(self) -> DataFrame:
        """Saved decisions, with one more row per file and reason for the excluded rows."""
        decided = decision_columns(label_excluded(self.decide(self.value_counts()), self.rules.scope.label))
        self._saved.append(new_path(decided.sparkSession, "decisions"))
        saved, self._lookup_size = save_measured(decided, self._saved[-1], [c for c in decided.columns if c not in NOT_LOOKED_UP])
        return saved

    @cached_property
    def lookup(self) -> DataFrame | None:
        """Lookup for the join to the rows, or ``None`` when it is too large to send to every executor.

        It is never larger than the decisions it is taken from; only when these
        are too large, it is saved and measured itself.
        """
        table = lookup_table(self.decisions)
        if self._fits(self._lookup_size):
            return table
        about = self.decisions.agg(F.approx_count_distinct(F.struct(*JOIN_KEYS))).first()[0]
        if about > self.limits[0]:
            return None
        table = self._save(table, "lookup")
        return table if fits_broadcast(table, *self.limits) else None

    def output_keep(self, keep: Sequence[str] = ()) -> list[str]:
        """Source columns of the output: all, or the ones to keep with file and position."""
        if not keep:
            return []
        return [*keep, *[c for c in (self.columns.file, self.columns.position) if c and c not in keep]]

    def harmonized(self, keep: Sequence[str] = ()) -> DataFrame:
        """Every source row with the 14 columns.

        As a rule the distinct values are few against the rows; then their
        decisions go to every executor and are looked up.  Otherwise each row is
        judged in place.  Neither way moves a row.
        """
        if self.lookup is None:
            return self.harmonized_in_place(keep)
        out = attach(self.keyed_rows(), F.broadcast(self.lookup), self.rules.scope.label)
        return output_columns(out, keep)

    def harmonized_in_place(self, keep: Sequence[str] = ()) -> DataFrame:
        """The same rows without a lookup; also right when no decisions are wanted."""
        out = decide_in_place(self.keyed_rows(), self.rules.text, self.units, self.rules.scope.label)
        return output_columns(out, keep)

    # --- reports -------------------------------------------------------------

    def near_misses(self, vocabulary: DataFrame | None = None) -> DataFrame:
        """Near misses of the words of the rules, or of a table of words (``word``) of any size."""
        if vocabulary is not None:
            return near_misses_among(self.decisions, vocabulary, self.rules.text.max_distance)
        return near_misses(self.decisions, self.rules.text)

    def units_not_registered(self) -> DataFrame:
        return reports.units_not_registered(self.decisions, self.units.conversions)


def write_run(
    job: Harmonization,
    output: str,
    write_rows: bool = True,
    keep: Sequence[str] = (),
    compression: str | None = None,
    clustered: bool = False,
    top_n: int = fixed.REVIEW_TOP_N,
    decisions_format: str = "csv",
    files: DataFrame | None = None,
) -> DataFrame:
    """Write harmonized rows, decisions, review lists and run reports below ``output``.

    The rows become visible when their content is proven, see
    :func:`assayloom.plans.checked.write_checked`.  ``files`` (``file``) may name the
    files of the run, so that one without rows is reported too.  Gives back the
    distribution per file with the check of the written rows.
    """
    spark = job.source.sparkSession
    output = output.rstrip("/")
    decisions = job.decisions

    def rows() -> DataFrame | None:
        return write_checked(job, f"{output}/harmonized", keep, clustered, compression) if write_rows else None

    def near() -> None:
        sinks.write_report(job.near_misses().orderBy("file", F.desc("n_rows"), "value"), f"{output}/review/near_vocab")

    done = side_by_side({
        "rows": rows,
        "decisions": lambda: sinks.write_decisions(reports.decisions_table(decisions), f"{output}/decisions", decisions_format),
        "review_top": lambda: sinks.write_decisions(reports.review_top(decisions, top_n), f"{output}/review/review_top", "csv"),
        "near_vocab": near,
        "code_dictionary": lambda: sinks.write_report(reports.code_dictionary(decisions), f"{output}/code_dictionary"),
        "units_not_registered": lambda: sinks.write_report(job.units_not_registered(), f"{output}/units_not_registered"),
        "conversions_applied": lambda: sinks.write_report(reports.conversions_applied(decisions), f"{output}/conversions_applied"),
        # a row for each file
        "distribution": lambda: reports.distribution_comparison(decisions, files=files).toArrow(),
    })
    distribution = spark.createDataFrame(done["distribution"])
    if done["rows"] is not None:
        distribution = reports.with_written(distribution, done["rows"])
    distribution = spark.createDataFrame(distribution.orderBy("file").toArrow())
    sinks.write_report(distribution, f"{output}/distribution_comparison")
    return distribution


def harmonize_folder(
    spark: SparkSession,
    folder: str,
    output: str,
    files: Sequence[str] = (),
    pattern: str = "*.parquet*",
    columns: LabColumns = LabColumns(),
    text: TextRules = TextRules(),
    scope: ScopeRules = ScopeRules(),
    synonyms_csv: str | None = None,
    conversions_csv: str | None = None,
    **options,
) -> DataFrame:
    """Read lab files, harmonize them and write everything; see :func:`write_run` for the options."""
    synonyms = read_synonyms(spark, synonyms_csv) if synonyms_csv else synonym_table(spark)
    conversions = read_conversions(spark, conversions_csv) if conversions_csv else conversion_table(spark)
    units = UnitRules.load(synonyms, conversions)
    table = open_lab(spark, folder, files, pattern, columns)
    with Harmonization(table.rows, RuleSet(text, scope, table.columns), units) as job:
        return write_run(job, output, files=table.files, **options)
