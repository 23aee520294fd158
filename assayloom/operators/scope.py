"""Rows that are out of scope: by code prefix, or by a shared order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.operators.keys import EXCLUDED_BY, source
from assayloom.rules import LabColumns, ScopeRules

LINK = "_lab_link"
SALT = "_lab_salt"
SALTS = 64
#: Words of 64 bits of the filter of orders: about one for each order, and never more than 64 MB of them.
LEAST_WORDS, MOST_WORDS = 1 << 10, 1 << 21
BITS_PER_ORDER = 3


def prefix_test(columns: LabColumns, rules: ScopeRules) -> Column:
    """True for a code with an excluded prefix, null for a null code.

    Left without ``coalesce`` on purpose: as a filter it reaches the scan.
    """
    code = source(columns.code).cast("string")
    return reduce(or_, [F.startswith(code, F.lit(p)) for p in rules.prefixes], F.lit(False))


def linked_orders(rows: DataFrame, columns: LabColumns, rules: ScopeRules = ScopeRules(), by: Sequence[str] = ()) -> DataFrame:
    """Distinct orders that have a row with an excluded prefix, over all files or for each value of some columns."""
    link = source(columns.link).cast("string")
    return rows.filter(prefix_test(columns, rules)).select(*by, link.alias(LINK)).dropna(subset=[LINK]).distinct()


@dataclass(frozen=True)
class OrderFilter:
    """A filter of bounded size that no linked order fails, and the other orders of the table that pass it.

    Both are small enough for a broadcast, so rows are told apart exactly where
    they are.  Without ``others``, these are too many, and the rows that pass the
    filter are told apart by a join.
    """

    words: DataFrame
    others: DataFrame | None


def _places(link: Column, n_words: Column) -> tuple[Column, Column]:
    """Word of an order and its bits in it."""
    picks = F.xxhash64(link, F.lit("bits"))
    at = [F.pmod(F.shiftright(picks, 8 * i), F.lit(64)).cast("int") for i in range(BITS_PER_ORDER)]
    one = [F.call_function("shiftleft", F.lit(1).cast("long"), a) for a in at]
    return F.pmod(F.xxhash64(link), n_words), reduce(lambda a, b: a.bitwiseOR(b), one)


def order_words(linked: DataFrame, n_orders: int) -> DataFrame:
    """``word``, ``bits``, ``n_words``: the filter of the linked orders."""
    n_words = F.lit(min(max(LEAST_WORDS, n_orders), MOST_WORDS)).cast("long")
    word, bits = _places(F.col(LINK), n_words)
    return linked.groupBy(word.alias("word")).agg(F.bit_or(bits).alias("bits")).withColumn("n_words", n_words)


def _with_hits(rows: DataFrame, link: Column, words: DataFrame, hit: str) -> DataFrame:
    """Add whether the order of a row passes the filter."""
    size = words.select("n_words").first()
    word, bits = _places(link, F.lit(size[0] if size else LEAST_WORDS).cast("long"))
    right = F.broadcast(words.select(F.col("word").alias("_lab_word"), F.col("bits").alias("_lab_bits")))
    joined = rows.join(right, F.when(link.isNotNull(), word) == F.col("_lab_word"), "left")
    passes = F.coalesce(F.col("_lab_bits").bitwiseAND(bits) == bits, F.lit(False))
    return joined.withColumn(hit, passes).drop("_lab_word", "_lab_bits")


def wrong_hits(rows: DataFrame, columns: LabColumns, linked: DataFrame, words: DataFrame) -> DataFrame:
    """Orders of the table that pass the filter and are not linked."""
    link = source(columns.link).cast("string")
    hits = _with_hits(rows.select(link.alias("_lab_order")), F.col("_lab_order"), words, "_lab_hit").filter("_lab_hit")
    return hits.select(F.col("_lab_order").alias(LINK)).distinct().join(linked, LINK, "left_anti")


def flag_scope(
    rows: DataFrame,
    columns: LabColumns,
    rules: ScopeRules = ScopeRules(),
    linked: DataFrame | None = None,
    broadcast: bool = False,
    filtered: OrderFilter | None = None,
) -> DataFrame:
    """Add why a row is excluded: ``prefix``, ``link``, or null when in scope.

    ``linked`` are the orders of :func:`linked_orders`; without it the link
    rule is off.  Set ``broadcast`` only after a size check.  With ``filtered``
    the orders stay where they are too: a row is linked if its order passes the
    filter and is none of the others that do.  When the others are too many, all rows
    that fail the filter stay where they are, and only those that pass are
    shuffled by order to meet the linked ones.  One order may own a large part of
    them, so its rows are spread over ``SALTS`` tasks and the far smaller list
    of orders is repeated for each.
    """
    by_prefix = F.coalesce(prefix_test(columns, rules), F.lit(False))
    if linked is None:
        return rows.withColumn(EXCLUDED_BY, F.when(by_prefix, F.lit("prefix")))
    link = source(columns.link).cast("string")
    marker = "_lab_linked"
    if broadcast:
        right = F.broadcast(linked.withColumn(marker, F.lit(True)))
        joined = rows.join(right, link == F.col(LINK), "left").drop(LINK)
    elif filtered is not None and filtered.others is not None:
        others = F.broadcast(filtered.others.select(LINK, F.lit(True).alias("_lab_other")))
        joined = _with_hits(rows, link, filtered.words, "_lab_hit").join(others, link == F.col(LINK), "left").drop(LINK)
        joined = joined.withColumn(marker, F.col("_lab_hit") & F.col("_lab_other").isNull()).drop("_lab_hit", "_lab_other")
    else:
        words = filtered.words if filtered else order_words(linked, linked.count())
        tested = _with_hits(rows, link, words, "_lab_hit")
        calm = tested.filter(~F.col("_lab_hit")).withColumn(marker, F.lit(None).cast("boolean"))
        spread = source(columns.position) if columns.position else F.xxhash64(*[source(c) for c in rows.columns])
        left = tested.filter("_lab_hit").withColumn(SALT, F.pmod(spread, F.lit(SALTS)).cast("int"))
        right = linked.select(
            LINK,
            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_lab_salt_copy"),
            F.lit(True).alias(marker),
        )
        on = (link == F.col(LINK)) & (F.col(SALT) == F.col("_lab_salt_copy"))
        # the caller found the orders too many for a broadcast
        hits = left.join(right.hint("merge"), on, "left").drop(LINK, SALT, "_lab_salt_copy")
        joined = calm.unionByName(hits).drop("_lab_hit")
    why = F.when(by_prefix, F.lit("prefix")).when(F.col(marker), F.lit("link"))
    return joined.withColumn(EXCLUDED_BY, why).drop(marker)
