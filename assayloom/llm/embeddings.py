"""Near-duplicate vectors by random-hyperplane sign hashing in several tables.

A table cuts the space by some random planes; the signs of a vector are its
bucket.  Vectors at an angle a agree in a sign with probability 1 - a / pi.  Vectors
that share a bucket of their label in any table are compared exactly, in double
precision.  A pair is counted in the first table where it meets, so links are
counted without writing pairs down; components come from a spanning forest of the
links of each bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Saved, block_pairs, column, connected_components, in_groups

#: Vectors of a bucket that are compared at a time; larger buckets are cut into blocks.
BLOCK_ROWS = 2048
#: Mean number of vectors of a bucket that the number of planes aims at, over all labels.
BUCKET_ROWS = 512
SEED = 20_240_601


def plan_tables(rows: int, similarity: float, recall: float) -> tuple[int, int]:
    """Planes of a table and number of tables for so many vectors.

    Planes grow with the logarithm of the rows, so buckets keep their mean size;
    tables are as many as find a pair at exactly ``similarity`` with probability
    ``recall``, closer pairs more often.
    """
    planes = max(6, math.ceil(math.log2(max(rows, 1) / BUCKET_ROWS + 1)))
    together = (1 - math.acos(similarity) / math.pi) ** planes
    return planes, math.ceil(math.log(1 - recall) / math.log(1 - together))


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, every component a finite number."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(lists: pa.Array) -> np.ndarray:
    """Vectors of one dimension, scaled to length one."""
    width = len(lists[0])
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    # divide by the largest first: squares neither overflow nor vanish
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def with_signatures(classes: DataFrame, planes: int, tables: int) -> DataFrame:
    """Add ``signs``: the bucket of the vector in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normals: dict[int, np.ndarray] = {}
        weight = 1 << np.arange(planes)
        for batch in batches:
            width = np.asarray(batch["vector"].value_lengths())
            signs = np.zeros((batch.num_rows, tables), np.int32)
            for w in np.unique(width):
                rows = np.flatnonzero(width == w)
                if w not in normals:
                    normals[w] = np.random.default_rng([SEED, int(w)]).standard_normal((int(w), tables * planes))
                side = _units(batch["vector"].take(pa.array(rows))) @ normals[w] > 0
                signs[rows] = side.reshape(len(rows), tables, planes) @ weight
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tables)
            lists = pa.ListArray.from_arrays(offsets, pa.array(signs.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "signs"])

    schema = classes.withColumn("signs", F.lit(None).cast("array<int>")).schema
    return classes.mapInArrow(run, schema)


def verified_links(dealt: DataFrame, similarity: float) -> DataFrame:
    """Links of dealt rows: ``node``, ``links`` (vectors linked to it here), ``root`` (a node to unite with, or null)."""

    def compare(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        nodes, label = table["node"].chunk(0), table["space"].to_numpy()
        group, turn = table["_group"].to_numpy(), table["turn"].to_numpy()
        copies, block = table["copies"].to_numpy(), table["_block"].to_numpy()
        low, high = table["_low"].to_numpy(), table["_high"].to_numpy()
        signs = table["signs"].chunk(0).flatten().to_numpy().reshape(len(group), -1)
        found = np.zeros(len(group), np.int64)
        root = np.arange(len(group))
        cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
        for s, e in zip(cuts[:-1], cuts[1:]):
            # rows of another bucket can only be here if two 64-bit hashes agree
            for t, space in {(int(t), int(v)) for t, v in zip(turn[s:e], label[s:e])}:
                rows = s + np.flatnonzero((turn[s:e] == t) & (label[s:e] == space))
                one = rows[block[rows] == low[rows]]
                two = one if low[rows[0]] == high[rows[0]] else rows[block[rows] == high[rows]]
                if not len(one) or not len(two):
                    continue
                unit_one = _units(table["vector"].chunk(0).take(pa.array(one)))
                unit_two = unit_one if two is one else _units(table["vector"].chunk(0).take(pa.array(two)))
                for i in range(0, len(one), 512):
                    x, y = np.nonzero(unit_one[i : i + 512] @ unit_two.T >= similarity)
                    a, b = one[x + i], two[y]
                    if two is one:
                        a, b = a[a < b], b[a < b]
                    same = signs[a, t] == signs[b, t]
                    a, b = a[same], b[same]
                    if t:
                        new = ~(signs[a, :t] == signs[b, :t]).any(axis=1)
                        a, b = a[new], b[new]
                    np.add.at(found, a, copies[b])
                    np.add.at(found, b, copies[a])
                    _unite(root, a, b)
        some = np.flatnonzero(found)
        if not len(some):
            return None
        up = nodes.take(pa.array(root[some], mask=root[some] == some))
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(some)), pa.array(found[some]), up], ["node", "links", "root"])

    return in_groups(dealt, "_group", compare, "node string, links long, root string", 8192)


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, root[root]):
            root[:] = root[root]


def embedding_components(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
                         similarity: float = 0.93, recall: float = 0.995, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``id_column``, ``n_links``, ``component_id``, ``kept`` of every row.

    - Only vectors of the same label and dimension are compared; a null label, and a vector that is
      null, empty, zero or has a null or non-finite component, link with nothing.
    - Equal vectors are compared once and count as often as they occur, also under the same id.
    - A null id is never the smallest unless a component has no other; ``kept`` compares null-safely.
    - Other columns are left out; no rows give no rows.
    """
    source = vectors.select(
        column(vectors, id_column).alias("id"), column(vectors, label).cast("string").alias("label"),
        column(vectors, vector).alias("vector"))
    good = usable(F.col("vector")) & F.col("label").isNotNull()
    space = F.xxhash64("label", F.size("vector"))
    node = F.concat_ws("-", F.hex(F.xxhash64("label", "vector")), F.hex(F.xxhash64(F.lit(SEED), "vector", "label")))
    alone = source.filter(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))

    seen = source.filter(good).groupBy("label", "vector").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    seen = seen.select(node.alias("node"), space.alias("space"), "vector", "first", "copies")
    total = source.filter(good).count()
    planes, tables = plan_tables(total, similarity, recall)
    classes = Saved(with_signatures(seen, planes, tables), "vectors")
    light = classes.df.select("node", "space", F.posexplode("signs").alias("turn", "sign"))
    light = light.select("node", "turn", F.xxhash64("space", "turn", "sign").alias("bucket"))
    dealt = block_pairs(light, "bucket", F.col("node"), block_rows, "buckets").drop("bucket")
    dealt = dealt.join(classes.df.drop("first"), "node")
    found = Saved(verified_links(dealt, similarity), "links")
    united = connected_components(found.df.filter("root is not null"), "node", "root")
    counts = found.df.groupBy("node").agg(F.sum("links").alias("links"))
    known = Saved(classes.df.select("node", "first", "copies").join(counts, "node", "left"), "counts")
    rooted = known.df.join(united, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rooted = Saved(rooted, "components")
    least = rooted.df.groupBy("component").agg(F.min("first").alias("least"))
    n_links = (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    labels = Saved(rooted.df.join(least, "component").select("node", n_links, F.col("least").alias("component_id")), "labels")
    for done in (classes, found, known, rooted):
        done.discard()
    linked = source.filter(good).select("id", node.alias("node")).join(labels.df, "node").select("id", "n_links", "component_id")
    return linked.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
