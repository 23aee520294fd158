"""Approximate nearest neighbours: a neighbour graph by NN-descent, queries by greedy search in it.

The graph starts from buckets of random-hyperplane signs.  Each round of the descent
sends every vector, in 8 bits a component, to the vectors it is linked with in
either direction; there the neighbours of a vector, which are neighbours of
neighbours of each other, are compared, and each keeps its best ``NEIGHBOURS``.

A query starts at its own vector and keeps a pool of the best vectors seen.  Each
round opens all members of the pool that were not opened yet, scores their
neighbours exactly, in double precision on the vectors as given, and ends when all of
the pool is open.  Vectors are numbered along their signs, so the neighbours of a
query lie in few blocks, and a query travels to those blocks, not the vectors to it.

Norms may differ: for the graph, vectors get one more component that makes them
equally long, so close ones have a large inner product.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .embeddings import usable
from .tables import Saved, column, in_groups

#: Links of a vector in the graph; in a search it also sees up to twice as many that have a link to it.
NEIGHBOURS = 24
#: Mean and twice the mean: size of a starting bucket and the size beyond which it is cut.
BUCKET_ROWS = 2048
TABLES, FROM_A_TABLE = 8, 16
DESCENTS = 3
#: A round is done in so many parts, by the vectors that are linked to, which bounds what is on disk at a time.
PARTS = 2
#: Vectors that have a link to one vector and are compared in one group with each other.
GROUP_LINKS = 64
POOL = 128
#: A search whose pool still changes after so many rounds ends.
SEARCH_ROUNDS = 40
#: Numbers of a block of vectors have all but the last so many bits in common.
BLOCK_BITS = 12
SEED = 7

STATE = "node long, code binary, scale float, cands array<bigint>, scores array<float>, fresh array<boolean>"


def _lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _by_width(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each dimension and their vectors in double precision."""
    width = np.asarray(lists.value_lengths())
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield rows, flat.astype(np.float64).reshape(-1, w)


def best_of(target: np.ndarray, cand: np.ndarray, score: np.ndarray, fresh: np.ndarray, k: int):
    """The ``k`` best different candidates of each target, sorted by target and score; ties go to the smaller number."""
    order = np.lexsort((fresh, cand, target))
    target, cand, score, fresh = target[order], cand[order], score[order], fresh[order]
    new = np.ones(len(target), bool)
    new[1:] = (target[1:] != target[:-1]) | (cand[1:] != cand[:-1])
    target, cand, score, fresh = target[new], cand[new], score[new], fresh[new]
    order = np.lexsort((cand, -score, target))
    target, cand, score, fresh = target[order], cand[order], score[order], fresh[order]
    rank = np.arange(len(target)) - np.searchsorted(target, target)
    best = rank < k
    return target[best], cand[best], score[best], fresh[best]


def _offers(target: np.ndarray, cand: np.ndarray, score: np.ndarray, k: int) -> pa.RecordBatch | None:
    """New candidates in the form of the graph, one row for each target."""
    if not len(target):
        return None
    target, cand, score, fresh = best_of(target, cand, score, np.ones(len(target), bool), k)
    nodes, counts = np.unique(target, return_counts=True)
    none = len(nodes)
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes), pa.nulls(none, pa.binary()), pa.nulls(none, pa.float32()), _lists(counts, pa.array(cand)),
         _lists(counts, pa.array(score, pa.float32())), _lists(counts, pa.array(fresh))],
        ["node", "code", "scale", "cands", "scores", "fresh"])


def _decoded(codes: pa.Array, scales: np.ndarray) -> np.ndarray:
    """Vectors of one dimension from their 8-bit form."""
    flat = np.frombuffer(b"".join(codes.to_pylist()), np.int8).reshape(len(codes), -1)
    return flat.astype(np.float32) * scales[:, None]


# --- the vectors -------------------------------------------------------------------


def with_codes(classes: DataFrame, largest: float) -> DataFrame:
    """Add the 8-bit form of each vector and its starting buckets; needs ``rows``, the number of vectors of its dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normals: dict[int, np.ndarray] = {}
        for batch in batches:
            codes, scales = [b""] * batch.num_rows, np.zeros(batch.num_rows, np.float32)
            buckets: list[list[int]] = [[]] * batch.num_rows
            total = batch["rows"].to_numpy()
            for rows, x in _by_width(batch["vector"]):
                x = x / largest
                x = np.c_[x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))]
                peak = np.abs(x).max(axis=1)
                scales[rows] = peak / 127
                small = np.rint(x / peak[:, None] * 127).astype(np.int8)
                planes = int(np.ceil(np.log2(max(1, total[rows[0]] / BUCKET_ROWS))))
                tables = TABLES if planes else 1
                width = x.shape[1]
                if width not in normals:
                    normals[width] = np.random.default_rng([SEED, width]).standard_normal((width, tables * planes))
                side = (x @ normals[width] > 0).reshape(len(x), tables, planes)
                signs = side @ (1 << np.arange(planes, dtype=np.int64)) if planes else np.zeros((len(x), 1), np.int64)
                for i, code, bucket in zip(rows.tolist(), small, signs.astype(np.int64).tolist()):
                    codes[i], buckets[i] = code.tobytes(), bucket
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes, pa.binary()), pa.array(scales), pa.array(buckets, pa.list_(pa.int64()))],
                [*batch.schema.names, "code", "scale", "buckets"])

    added = {"code": F.lit(None).cast("binary"), "scale": F.lit(None).cast("float"), "buckets": F.lit(None).cast("array<bigint>")}
    return classes.mapInArrow(run, classes.withColumns(added).schema)


def number_vectors(rows: DataFrame, k: int) -> Saved | None:
    """Different vectors: ``node`` (their number), ``vector``, ``ids`` (the smallest ``k + 1`` ids), code and buckets."""
    rank = F.dense_rank().over(Window.partitionBy("vector").orderBy("id"))
    few = rows.withColumn("_rank", rank).filter(F.col("_rank") <= k + 1)
    classes = few.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    classes = classes.withColumn("space", F.size("vector"))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    classes = Saved(classes.withColumn("length", length), "vectors", lean=True)
    largest = classes.df.agg(F.max("length")).first()[0]
    if largest is None:
        classes.discard()
        return None
    spaces = classes.df.groupBy("space").agg(F.count(F.lit(1)).alias("rows"))
    coded = with_codes(classes.df.join(spaces, "space").drop("length"), largest)
    # close vectors get close numbers
    along = coded.repartitionByRange("space", F.col("buckets")[0], F.xxhash64("vector"))
    along = along.sortWithinPartitions("space", F.col("buckets")[0], F.xxhash64("vector"))
    points = Saved(along.withColumn("_at", F.monotonically_increasing_id()), "points", lean=True)
    classes.discard()
    # numbers without gaps, whatever the partitions: a row for each of them
    part = F.shiftright("_at", 33)
    sizes = sorted(tuple(r) for r in points.df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = np.cumsum([0, *[n for _, n in sizes[:-1]]]).tolist()
    bases = pa.table({"_part": pa.array([p for p, _ in sizes], pa.int64()), "_before": pa.array(before, pa.int64())})
    bases = F.broadcast(rows.sparkSession.createDataFrame(bases))
    numbered = points.df.join(bases, part == F.col("_part"))
    points.df = numbered.withColumn("node", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_before")
    return points


# --- the graph ---------------------------------------------------------------------


def starting_links(points: DataFrame) -> DataFrame:
    """Best vectors of each bucket for each vector; buckets beyond twice the mean are cut."""
    each = points.select("node", "code", "scale", "space", F.size("buckets").alias("tables"), F.posexplode("buckets").alias("turn", "sign"))
    each = each.withColumn("bucket", F.xxhash64("space", "turn", "sign"))
    large = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 2 * BUCKET_ROWS)
    part = F.pmod(F.xxhash64("node"), F.coalesce(F.ceil(F.col("n") / (2 * BUCKET_ROWS)), F.lit(1)))
    dealt = each.join(large, "bucket", "left").withColumn("group", F.xxhash64("bucket", part))
    dealt = dealt.select("group", "node", "code", "scale", "tables")

    def compare(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        group, node, tables = (table[c].to_numpy() for c in ("group", "node", "tables"))
        scales, codes = table["scale"].to_numpy(), table["code"].chunk(0)
        cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
        target, cand, score = [], [], []
        for low, high in zip(cuts[:-1], cuts[1:]):
            if high - low < 2:
                continue
            mine = node[low:high]
            x = _decoded(codes.slice(low, high - low), scales[low:high])
            k = min(high - low - 1, NEIGHBOURS if tables[low] == 1 else FROM_A_TABLE)
            for i in range(0, len(mine), 512):
                like = x[i : i + 512] @ x.T
                like[np.arange(len(like)), np.arange(i, i + len(like))] = -np.inf
                top = np.argpartition(like, -k, axis=1)[:, -k:]
                target.append(np.repeat(mine[i : i + 512], k))
                cand.append(mine[top].ravel())
                score.append(np.take_along_axis(like, top, axis=1).ravel())
        if not target:
            return None
        return _offers(np.concatenate(target), np.concatenate(cand), np.concatenate(score), NEIGHBOURS)

    return in_groups(dealt, "group", compare, STATE, 8192)


def merged(state: DataFrame, offers: DataFrame) -> DataFrame:
    """The graph after the offers: each vector keeps its best links, those that are new are fresh."""

    def work(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        node = table["node"].to_numpy()
        lists = table["cands"].chunk(0)
        target = np.repeat(node, np.asarray(lists.value_lengths()))
        values = [table[c].chunk(0).flatten().to_numpy(zero_copy_only=False) for c in ("cands", "scores", "fresh")]
        target, cand, score, fresh = best_of(target, *values, NEIGHBOURS)
        own = np.flatnonzero(table["code"].is_valid().to_numpy())
        counts = np.searchsorted(target, node[own], side="right") - np.searchsorted(target, node[own])
        kept = table.select(["node", "code", "scale"]).take(pa.array(own)).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [*[c.chunk(0) for c in kept.columns], _lists(counts, pa.array(cand)), _lists(counts, pa.array(score, pa.float32())),
             _lists(counts, pa.array(fresh.astype(bool)))],
            ["node", "code", "scale", "cands", "scores", "fresh"])

    return in_groups(state.unionByName(offers), "node", work, STATE, 8192)


def descent(state: DataFrame, part: int) -> DataFrame:
    """Offers of one part of a round: vectors linked with the same vector are compared, pairs of old links are not."""
    links = state.select("node", "code", "scale", F.get("scores", F.lit(NEIGHBOURS - 1)).alias("worst"),
                         F.explode(F.arrays_zip("cands", "fresh")).alias("link"))
    back = links.select(F.col("link.cands").alias("owner"), F.col("node").alias("member"), "code", "scale", "worst", F.col("link.fresh").alias("fresh"))
    ends = state.select(F.col("node").alias("member"), "code", "scale", F.get("scores", F.lit(NEIGHBOURS - 1)).alias("worst"))
    ahead = links.select(F.col("node").alias("owner"), F.col("link.cands").alias("member"), F.col("link.fresh").alias("fresh"))
    here = F.pmod(F.xxhash64(F.lit(SEED), "owner"), F.lit(PARTS)) == part
    back, ahead = back.filter(here), ahead.filter(here)
    # those that link to one vector are dealt to groups, each of which also holds the vector's own links
    crowd = back.groupBy("owner").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP_LINKS)
    crowd = crowd.select("owner", F.ceil(F.col("n") / GROUP_LINKS).alias("parts"))
    one = F.coalesce("parts", F.lit(1))
    back = back.join(crowd, "owner", "left").withColumn("part", F.pmod(F.xxhash64("member"), one)).drop("parts")
    ahead = ahead.join(crowd, "owner", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), one - 1))).drop("parts")
    both = back.unionByName(ahead.join(ends, "member")).withColumn("group", F.xxhash64("owner", "part"))

    def compare(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        group, node = table["group"].to_numpy(), table["member"].to_numpy()
        fresh = table["fresh"].to_numpy(zero_copy_only=False).astype(bool)
        worst = np.nan_to_num(table["worst"].to_numpy(zero_copy_only=False).astype(np.float32), nan=-np.inf)
        scales, codes = table["scale"].to_numpy(), table["code"].chunk(0)
        cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
        target, cand, score = [], [], []
        for low, high in zip(cuts[:-1], cuts[1:]):
            new = fresh[low:high]
            if high - low < 2 or not new.any():
                continue
            mine = node[low:high]
            x = _decoded(codes.slice(low, high - low), scales[low:high])
            like = x @ x.T
            a, b = np.nonzero((like > worst[low:high, None]) & (new[:, None] | new) & (mine[:, None] != mine))
            target.append(mine[a])
            cand.append(mine[b])
            score.append(like[a, b])
        if not target:
            return None
        return _offers(np.concatenate(target), np.concatenate(cand), np.concatenate(score), NEIGHBOURS)

    return in_groups(both.select("group", "member", "code", "scale", "worst", "fresh"), "group", compare, STATE, 16384)


def neighbour_graph(points: DataFrame) -> Saved:
    """``node``, ``cands``, ``scores``: links of each vector, the best first."""
    empty = {"cands": "array<bigint>", "scores": "array<float>", "fresh": "array<boolean>"}
    state = points.select("node", "code", "scale", *[F.array().cast(kind).alias(name) for name, kind in empty.items()])
    graph = Saved(merged(state, starting_links(points)), "graph", lean=True)
    for _ in range(DESCENTS):
        offers = [Saved(descent(graph.df, part), "offers", lean=True) for part in range(PARTS)]
        every = reduce(DataFrame.unionByName, [o.df for o in offers])
        later = Saved(merged(graph.df, every), "graph", lean=True)
        for done in (graph, *offers):
            done.discard()
        graph = later
    return graph


def both_ways(graph: DataFrame) -> DataFrame:
    """``node``, ``near``: the links of a vector and the best of those that have a link to it."""
    links = graph.select("node", F.explode(F.arrays_zip("cands", "scores")).alias("link"))
    back = links.select(F.col("link.cands").alias("to"), "node", F.col("link.scores").alias("score"))
    rank = F.row_number().over(Window.partitionBy("to").orderBy(F.desc("score"), "node"))
    back = back.withColumn("_rank", rank).filter(F.col("_rank") <= 2 * NEIGHBOURS)
    back = back.groupBy(F.col("to").alias("node")).agg(F.collect_list(F.col("node")).alias("back"))
    near = F.array_union("cands", F.coalesce("back", F.array().cast("array<bigint>")))
    return graph.join(back, "node", "left").select("node", near.alias("near"))


# --- the search --------------------------------------------------------------------


def asked(pool: DataFrame, near: DataFrame, size: int) -> DataFrame:
    """What each query wants scored next, by block: neighbours of what it opens that are not in its pool."""
    opened = pool.select("query", F.explode(F.filter(F.arrays_zip("ids", "open"), lambda s: s["open"])["ids"]).alias("node"))
    seen = opened.join(near, "node").select("query", "near")
    floor = F.get("scores", F.lit(size - 1)).alias("floor")
    mine = pool.filter(F.exists("open", lambda x: x)).select("query", "vector", floor, "ids")
    rows = mine.unionByName(seen, allowMissingColumns=True)

    def work(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        query = table["query"].to_numpy()
        own = np.flatnonzero(table["ids"].is_valid().to_numpy())
        near_, ids = table["near"].chunk(0), table["ids"].chunk(0)
        offsets, flat = np.asarray(near_.offsets), near_.values.to_numpy()
        starts, pool_ids = np.asarray(ids.offsets), ids.values.to_numpy()
        cuts = np.flatnonzero(np.r_[True, query[1:] != query[:-1], True])
        rows, blocks, counts, cands = [], [], [], []
        for at, low, high in zip(own, cuts[:-1], cuts[1:]):
            want = np.unique(np.concatenate([flat[offsets[i] : offsets[i + 1]] for i in range(low, high)]))
            want = want[~np.isin(want, pool_ids[starts[at] : starts[at + 1]])]
            block, count = np.unique(want >> BLOCK_BITS, return_counts=True)
            rows.append(np.full(len(block), at))
            blocks.append(block)
            counts.append(count)
            cands.append(want)
        if not rows:
            return None
        of = table.select(["query", "vector", "floor"]).take(pa.array(np.concatenate(rows))).combine_chunks()
        if not of.num_rows:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(blocks)), *[c.chunk(0) for c in of.columns],
             _lists(np.concatenate(counts), pa.array(np.concatenate(cands)))],
            ["block", "query", "vector", "floor", "cands"])

    vector = pool.schema["vector"].dataType.simpleString()
    return in_groups(rows, "query", work, f"block long, query long, vector {vector}, floor double, cands array<bigint>", 8192)


def inner_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of pairs of rows; a pair gives the same bits wherever it is computed."""
    return (x * y).sum(axis=1)


def scored(asks: DataFrame, points: DataFrame) -> DataFrame:
    """``query``, ``ids``, ``scores``: exact inner products of what was asked, if they can enter the pool."""
    held = points.select(F.shiftright("node", BLOCK_BITS).alias("block"), "node", "vector")
    rows = held.unionByName(asks, allowMissingColumns=True)
    rows = rows.repartition("block").sortWithinPartitions("block", F.asc_nulls_first("query"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts = None, []
        for batch in batches:
            block = batch["block"].to_numpy()
            is_ask = batch["query"].is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (is_ask[1:] != is_ask[:-1]), True])
            for low, high in zip(cuts[:-1], cuts[1:]):
                run_ = batch.slice(low, high - low)
                if not is_ask[low]:
                    if block[low] != here:
                        here, parts = block[low], []
                    nodes = run_["node"].to_numpy()
                    parts += [(nodes[at], x) for at, x in _by_width(run_["vector"])]
                elif block[low] == here:
                    yield from answers(run_, parts)

    def answers(asks_: pa.RecordBatch, parts: list) -> Iterator[pa.RecordBatch]:
        by_width: dict[int, list] = {}
        for nodes, x in parts:
            by_width.setdefault(x.shape[1], []).append((nodes, x))
        lists = asks_["cands"]
        floors = np.nan_to_num(asks_["floor"].to_numpy(zero_copy_only=False).astype(np.float64), nan=-np.inf)
        for rows, q in _by_width(asks_["vector"]):
            if q.shape[1] not in by_width:
                continue
            nodes = np.concatenate([n for n, _ in by_width[q.shape[1]]])
            x = np.concatenate([v for _, v in by_width[q.shape[1]]])
            for i in range(0, len(rows), 256):
                mine = rows[i : i + 256]
                wanted = lists.take(pa.array(mine))
                cand = wanted.flatten().to_numpy()
                of = np.repeat(np.arange(len(mine)), np.asarray(wanted.value_lengths()))
                score = inner_products(x[np.searchsorted(nodes, cand)], q[i : i + 256][of])
                good = score > floors[mine][of]
                counts = np.bincount(of[good], minlength=len(mine))
                yield pa.RecordBatch.from_arrays(
                    [asks_["query"].take(pa.array(mine)), _lists(counts, pa.array(cand[good])), _lists(counts, pa.array(score[good]))],
                    ["query", "ids", "scores"])

    return rows.select("block", "node", "vector", "query", "floor", "cands").mapInArrow(
        run, "query long, ids array<bigint>, scores array<double>")


def next_pool(pool: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """The best ``size`` of the pool and the new ones; what was in the pool is open now."""

    def work(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        query = table["query"].to_numpy()
        own = np.flatnonzero(table["vector"].is_valid().to_numpy())
        lists = table["ids"].chunk(0)
        counts = np.asarray(lists.value_lengths())
        new = np.repeat(table["vector"].is_null().to_numpy(), counts)
        target, cand, score, fresh = best_of(np.repeat(query, counts), lists.flatten().to_numpy(),
                                             table["scores"].chunk(0).flatten().to_numpy(), new, size)
        n = np.searchsorted(target, query[own], side="right") - np.searchsorted(target, query[own])
        of = table.select(["query", "vector"]).take(pa.array(own)).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [*[c.chunk(0) for c in of.columns], _lists(n, pa.array(cand)), _lists(n, pa.array(score)), _lists(n, pa.array(fresh))],
            ["query", "vector", "ids", "scores", "open"])

    rows = pool.drop("open").unionByName(found, allowMissingColumns=True)
    return in_groups(rows, "query", work, pool.schema.simpleString()[7:-1].replace(":", " "), 4096)


def search(queries: DataFrame, points: DataFrame, near: DataFrame, size: int) -> Saved:
    """Pool of each query (``query``: the number of its vector, ``vector``) when all of it is open."""
    first = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    start = queries.select("query", "vector", F.array("query").alias("ids"), F.array(first).alias("scores"), F.array(F.lit(True)).alias("open"))
    pool = Saved(start, "pool", lean=True)
    for _ in range(SEARCH_ROUNDS):
        if pool.df.filter(F.exists("open", lambda x: x)).isEmpty():
            break
        found = scored(asked(pool.df, near, size), points)
        later = Saved(next_pool(pool.df, found, size), "pool", lean=True)
        pool.discard()
        pool = later
    return pool


def nearest_neighbours(vectors: DataFrame, k: int = 20, every: int = 20, id_column: str = "vec_id", vector: str = "embedding",
                       pool: int = POOL) -> DataFrame:
    """``query_id``, ``rank``, ``id_column``, ``score``: the ``k`` nearest found for each row whose id is divisible by ``every``.

    Nearest is the largest inner product, in double precision; ties go to the
    smaller id.  All rows but those of the query's own id are candidates.

    - Vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do rows without an id.
    - Equal vectors are one node of the graph; a node keeps its ``k + 1`` smallest ids, more can not be in an answer.
    - A row that is repeated counts once.  An id with several vectors is several candidates, and several queries if it is one.
    - Only vectors of the same dimension are compared.  With fewer candidates all of them are returned.
    - Other columns are left out; no rows give no rows.
    """
    rows = vectors.select(column(vectors, id_column).alias("id"), column(vectors, vector).alias("vector"))
    rows = rows.filter(usable(F.col("vector")) & F.col("id").isNotNull())
    asking = rows.filter(F.col("id") % every == 0)
    points = number_vectors(rows, k)
    if points is None:
        empty = asking.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias(id_column), F.lit(0.0).alias("score"))
        return empty.limit(0)
    graph = neighbour_graph(points.df)
    near = Saved(both_ways(graph.df), "near", lean=True)
    graph.discard()
    numbers = points.df.select("vector", F.col("node").alias("query"))
    who = Saved(asking.distinct().join(numbers, "vector").select("id", "query"), "queries", lean=True)
    starts = points.df.withColumnRenamed("node", "query").join(who.df.select("query").distinct(), "query", "left_semi")
    found = search(starts.select("query", "vector"), points.df, near.df, max(pool, 2 * k))
    near.discard()

    pairs = found.df.select("query", F.explode(F.arrays_zip("ids", "scores")).alias("hit"))
    pairs = pairs.select("query", F.col("hit.ids").alias("node"), F.col("hit.scores").alias("score"))
    hits = pairs.join(points.df.select("node", "ids"), "node").select("query", "score", F.explode("ids").alias("id"))
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    hits = hits.withColumn("_rank", best).filter(F.col("_rank") <= 2 * k)
    lists = hits.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("_rank", "id", "score"))).alias("hits"))
    answers = who.df.withColumnRenamed("id", "query_id").join(Saved(lists, "answers", lean=True).df, "query")
    others = F.filter("hits", lambda h: h["id"] != F.col("query_id"))
    ranked = answers.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "hit"))
    for done in (points, found):
        done.discard()
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), F.col("hit.id").alias(id_column), F.col("hit.score").alias("score"))
