"""Saved tables, whole groups in a task, connected components."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.store import discard, new_path


#: Spark's setting to remove the shuffle files of a query with its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Saved:
    """A table written to the shared folder: its lineage starts at the files.

    ``discard`` removes the files as soon as nothing reads them any more.  A
    ``lean`` one lets Spark remove the shuffle files of the write when it ends.
    """

    def __init__(self, df: DataFrame, name: str, lean: bool = False):
        self.spark = df.sparkSession
        self.path = new_path(self.spark, name)
        before = self.spark.conf.get(SHUFFLE_CLEANUP)
        try:
            if lean:
                self.spark.conf.set(SHUFFLE_CLEANUP, "true")
            df.write.parquet(self.path)
        finally:
            if lean:
                self.spark.conf.set(SHUFFLE_CLEANUP, before)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def discard(self) -> None:
        discard(self.spark, self.path)


def release_shuffles(spark: SparkSession) -> None:
    """Let the driver forget finished jobs, so that their shuffle files go.

    Spark removes shuffle files when the driver's objects are collected as
    garbage, which may come long after the last reader ended.  Objects that Python
    drops are reported to the driver's JVM in the background, so it collects only
    after a pause.
    """
    gc.collect()
    time.sleep(1.5)
    spark.sparkContext._jvm.System.gc()
    time.sleep(1.5)  # the files go in the background


#: Rows that Spark hands to Python at a time, if the session does not say otherwise: whole texts can be long.
BATCH_SETTING, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of batches of texts on both sides of the Python worker."""
    if spark.conf.get(BATCH_SETTING, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, also if the name has dots."""
    return df[f"`{name}`"]


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, min_rows: int) -> Iterator[pa.Table]:
    """Cut a stream that is sorted by ``key`` into tables of complete groups, ``min_rows`` or a little more each."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < min_rows:
            continue
        table = pa.Table.from_batches(held)
        keys = table[key]
        whole = pc.index(keys, keys[-1]).as_py()
        if whole:
            yield table.slice(0, whole)
            # a copy, so that the rows before it can be freed
            held = table.slice(whole).combine_chunks().to_batches()
            rows -= whole
    if rows:
        yield pa.Table.from_batches(held)


def in_groups(df: DataFrame, key: str, work: Callable[[pa.Table], pa.RecordBatch | None], schema: str,
              min_rows: int, order: list[str] | None = None) -> DataFrame:
    """Bring the rows of a key together and hand complete groups to ``work``, many small groups at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, key, min_rows):
            out = work(table)
            if out is not None and out.num_rows:
                yield out

    return df.repartition(key).sortWithinPartitions(key, *(order or [])).mapInArrow(run, schema)


def block_pairs(df: DataFrame, bucket: str, spread: Column, limit: int, name: str, single: bool = False) -> DataFrame:
    """Rows of buckets, dealt to groups of at most about ``2 * limit`` rows.

    A bucket within the limit is one group.  A larger one is cut into blocks by
    ``spread``, and each pair of blocks is a group, so any two rows of a bucket
    meet in a group whatever its size.  Without ``single``, buckets of one row
    are left out; with it, only buckets beyond the limit are looked up.  Adds ``_group`` (long), ``_block``
    (the block of the row), ``_low`` and ``_high`` (the blocks of the group).
    """
    saved = Saved(df.withColumn("_spread", spread), name)
    sizes = saved.df.groupBy(bucket).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > (limit if single else 1))
    blocks = F.ceil(F.coalesce("_n", F.lit(1)) / F.lit(limit)).cast("int")
    rows = saved.df.join(sizes, bucket, "left" if single else "inner").withColumn("_blocks", blocks)
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_spread"), F.col("_blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.withColumns({"_low": F.least("_block", "_other"), "_high": F.greatest("_block", "_other")})
    return rows.withColumn("_group", F.xxhash64(bucket, "_low", "_high")).drop("_n", "_blocks", "_other", "_spread")


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Component of each node that has a link: ``node``, ``component`` (the smallest node reachable).

    Each round hooks every node to its smallest neighbour, follows the hooks to
    their roots by doubling, and keeps the links between different roots.  At
    least half of the linked nodes vanish in a round.  Minima are taken before
    the shuffle, joins read saved tables, so Spark can split a hot node; the
    driver sees counts only.  Links with a null end are ignored.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null and a <> b")
    edges = Saved(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    rounds: list[Saved] = []
    while not edges.df.isEmpty():
        both = edges.df.unionByName(edges.df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        roots = Saved(hooks.select("node", F.least("node", "root").alias("root")), "hooks")
        while True:
            to = roots.df.select(F.col("node").alias("root"), F.col("root").alias("next"))
            after = roots.df.join(to, "root").select("node", F.col("next").alias("root"), (F.col("next") < F.col("root")).alias("moved"))
            jumped = Saved(after, "hooks")
            roots.discard()
            moved = not jumped.df.filter("moved").isEmpty()
            roots = jumped
            if not moved:
                break
        roots.df = roots.df.drop("moved")
        left = roots.df.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = roots.df.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        across = edges.df.join(left, "a").join(right, "b").filter("ra <> rb")
        narrowed = Saved(across.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        edges.discard()
        edges = narrowed
        rounds.append(roots)
    edges.discard()
    if not rounds:
        return ends.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    found = rounds[0].df
    for later in rounds[1:]:
        then = later.df.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(then, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found.withColumnRenamed("root", "component")


def running_total(df: DataFrame, group: str, size: str, order: list[str], name: str, bucket_rows: int = 1024,
                  light: DataFrame | None = None) -> DataFrame:
    """Add ``name``: the sum of ``size`` of the rows before this one in its group, in an order that looks random.

    ``group`` is not null and ``_n`` holds the rows of the group.  A group is cut
    into buckets of about ``bucket_rows`` rows by a hash of ``order``; sums run
    within buckets, and the buckets of a group are placed one after another, so a
    group of any size is spread over many tasks.  Rows that agree in ``order``
    must agree in everything else too, then reruns agree.  ``light`` may hold the
    same rows without other columns, for a first pass over sizes alone.
    """
    def dealt(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_turn", F.xxhash64(*order))
        return rows.withColumn("_bucket", F.pmod(F.xxhash64("_turn"), F.ceil(F.col("_n") / F.lit(bucket_rows))).cast("int")).drop("_n")

    rows = dealt(df)
    totals = dealt(df if light is None else light).groupBy(group, "_bucket").agg(F.sum(size).alias("_total"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(group, "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(group, "_bucket").orderBy("_turn", *order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    rows = rows.join(totals, [group, "_bucket"])
    return rows.withColumn(name, F.col("_base") + F.col("_inside")).drop("_turn", "_bucket", "_base", "_inside")
