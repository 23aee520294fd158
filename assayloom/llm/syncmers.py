"""Document fingerprints from closed syncmers of words.

A window of ``SPAN`` words is an anchor if the smallest of its inner word pairs
stands first or last in it.  Whether a window is chosen depends on its own words
alone, so an edit moves no anchor elsewhere, and equal passages have equal anchors
at corresponding positions.  A fingerprint keeps the smallest distinct anchor
hashes.  All of it is DataFrame work.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import column
from .words import WORD

#: Words of a window, and of the inner runs that are compared.
SPAN, INNER = 6, 2
#: Hashes of a fingerprint, of 32 bits each.
KEPT = 64
#: Blocks of consecutive ids for each shuffle partition, and the most of them.
BLOCKS_EACH, MOST_BLOCKS = 4, 4000


def word_hashes(text: Column) -> Column:
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def inner_hashes(words: Column) -> Column:
    """Hash of each run of ``INNER`` words."""
    last = F.size(words) - INNER
    run = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(INNER)])
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), run)).otherwise(F.array().cast("array<bigint>"))


def anchor_positions(inner: Column) -> Column:
    """Places of the closed syncmers; null if the text is shorter than a window."""
    runs = SPAN - INNER + 1
    last = F.size(inner) - runs

    def closed(i: Column) -> Column:
        here = [F.get(inner, i + j) for j in range(runs)]
        middle = reduce(lambda a, b: F.least(a, b), here[2:-1], here[1])
        return F.least(here[0], here[-1]) <= middle

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), closed))


def with_anchors(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: the anchors of the text, an array of ``position`` and ``hash`` (of 32 bits).

    A text with fewer words than a window is one anchor at position 0; without words it has none.
    """
    rows = docs.withColumn("_words", word_hashes(column(docs, text)))
    rows = rows.withColumn("_inner", inner_hashes(F.col("_words"))).withColumn("_at", anchor_positions(F.col("_inner")))
    words, runs = F.col("_words"), SPAN // INNER
    of_window = lambda i: F.xxhash64(*[F.get("_inner", i + INNER * j) for j in range(runs)])
    anchor = lambda i: F.struct(i.alias("position"), F.shiftrightunsigned(of_window(i), 32).alias("hash"))
    whole = F.struct(F.lit(0).alias("position"), F.shiftrightunsigned(F.xxhash64(words), 32).alias("hash"))
    short = F.when(F.size(words) > 0, F.array(whole)).otherwise(F.array().cast("array<struct<position:int,hash:bigint>>"))
    return rows.withColumn(name, F.coalesce(F.transform("_at", anchor), short)).drop("_words", "_inner", "_at")


def sketch(anchors: Column) -> Column:
    """The smallest distinct hashes."""
    return F.slice(F.sort_array(F.array_distinct(F.transform(anchors, lambda a: a["hash"]))), 1, KEPT)


def written(kept: Column) -> Column:
    return F.array_join(F.transform(kept, lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the smallest hashes of both texts together that both have: estimates the Jaccard similarity of their anchors."""
    both = F.slice(F.sort_array(F.array_union(a, b)), 1, KEPT)
    common = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))


def fingerprint(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Add the sketch of ``text`` as ``name``."""
    rows = with_anchors(docs, text, "_anchors")
    return rows.withColumn(name, sketch(F.col("_anchors"))).drop("_anchors")


def positional_matches(a: Column, b: Column) -> Column:
    """Positions of anchors of ``a`` and of the first equal anchor of ``b``, for texts with some common passages."""
    first = lambda x: F.get(F.filter(b, lambda y: y["hash"] == x["hash"]), F.lit(0))
    pairs = F.transform(a, lambda x: F.struct(x["position"].alias("a"), first(x)["position"].alias("b")))
    return F.filter(pairs, lambda p: p["b"].isNotNull())


def with_next(docs: DataFrame, id_column: str, order: list[str], carry: list[str], name: str) -> DataFrame:
    """Add ``name``: a struct of the ``carry`` columns of the next row by ``id_column``; after the last row comes the first.

    Ids are cut into blocks of consecutive ids at approximate quantiles.  The
    first rows of each block are also sent to the block before it, so every row
    finds its successor in its own block and no task sorts the whole table.
    Null ids come last.
    """
    spark = docs.sparkSession
    blocks = min(MOST_BLOCKS, BLOCKS_EACH * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / blocks for i in range(1, blocks)]
    ids = docs.select(id_column)
    cuts = ids.agg(F.percentile_approx(id_column, shares, 10 * blocks).alias("cuts")).first()["cuts"]
    cuts = sorted(set(cuts or []))
    # two steps through the cuts instead of one through all of them
    wide = max(1, round(len(cuts) ** 0.5))
    parts = [cuts[i : i + wide] for i in range(0, len(cuts), wide)]
    coarse, fine = F.lit([p[0] for p in parts]), F.lit(cuts)
    here = F.col(id_column)
    if cuts:
        step = F.size(F.filter(coarse, lambda c: c <= here))
        inside = F.size(F.filter(F.slice(fine, F.greatest(step - 1, F.lit(0)) * wide + 1, wide), lambda c: c <= here))
        block = F.when(here.isNull(), F.lit(len(cuts) + 1)).otherwise(F.when(step > 0, (step - 1) * wide + inside).otherwise(F.lit(0)))
    else:
        block = F.when(here.isNull(), F.lit(1)).otherwise(F.lit(0))
    block = block.cast("int")
    heads = sorted((r["b"], r["head"]) for r in ids.groupBy(block.alias("b")).agg(F.min(id_column).alias("head")).collect())
    if not heads:
        return docs.withColumn(name, F.lit(None).cast(docs.select(F.struct(*carry).alias("c")).schema["c"].dataType))
    # one row for each block, at most MOST_BLOCKS
    kind = docs.schema[id_column].dataType.simpleString()
    before = [(b, h, heads[i - 1][0]) for i, (b, h) in enumerate(heads)]
    known = F.broadcast(spark.createDataFrame(before, f"_block int, _head {kind}, _before int"))
    rows = docs.withColumn("_block", block).join(known, "_block")
    own = F.struct(F.col("_block").alias("block"), F.lit(False).alias("halo"))
    halo = F.struct(F.col("_before").alias("block"), F.lit(True).alias("halo"))
    rows = rows.withColumn("_to", F.explode(F.when(here.eqNullSafe(F.col("_head")), F.array(own, halo)).otherwise(F.array(own))))
    rows = rows.drop("_block", "_head", "_before").withColumns({"_block": F.col("_to.block"), "_halo": F.col("_to.halo")}).drop("_to")
    window = Window.partitionBy("_block").orderBy("_halo", F.col(id_column).asc_nulls_last(), *order)
    rows = rows.withColumn(name, F.lead(F.struct(*carry)).over(window))
    return rows.filter("not _halo").drop("_block", "_halo")


def edit_fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text and how alike they are.

    The edited text has its last quarter (floor of code points / 4) replaced by
    as many first code points of the next document, or all it has.

    - A null text is empty; a text without words has an empty fingerprint, which is like another empty one.
    - Null ids come last, repeated ids in the order of their texts.  A single document is its own successor.
    - Other columns are left out; no rows give no rows.
    """
    rows = docs.select(column(docs, id_column).alias("id"), F.coalesce(column(docs, text), F.lit("")).alias("text"))
    rows = with_next(fingerprint(rows, "text", "print"), "id", ["text"], ["text", "print"], "next")
    length = F.length("text")
    cut = F.floor(length / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), length - cut), F.substring("next.text", F.lit(1), cut))
    rows = rows.withColumn("edited", edited)
    rows = rows.select("id", length.cast("long").alias("n_chars"), "print", "edited", F.col("next.print").alias("next_print"))
    rows = fingerprint(rows, "edited", "edited_print")
    return rows.select(
        F.col("id").alias(id_column), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("print")).alias("fingerprint"), written(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"), likeness(F.col("print"), F.col("next_print")).alias("near_next"))
