"""Mix sources to target weights by a splitting tree of block quotas.

The documents of a source stand in a random order; its words, in that order, are
cut into blocks of equal length.  A source's quota is a whole number of blocks.
The quotas are parted over the output shards by a binary tree: a node that holds
some blocks of each source gives a fixed number of them to its left half, and how
many of each source is a draw from the multivariate hypergeometric distribution,
as if all its blocks had been shuffled.  The draws of a source are positions in
permutations of its blocks, one permutation for each pass, and the shards own
disjoint runs of positions.  A shard shuffles only what it has drawn.

Only the quotas are worked out on the driver: one row for each source, not for
documents or blocks.  Everything on documents is DataFrame work.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .tables import Saved, column, running_total
from .words import WORD

#: Fixed values of the mix: weights by order of the source, share of all words, most passes over a source.
WEIGHTS, SHARE, PASSES = (3, 1, 2), 1.5, 2
#: A block has this many words at most, unless the corpus would have over 200 million blocks.
BLOCK_WORDS, MOST_BLOCKS = 4096, 200_000_000
#: A smaller source is cut into about this many blocks.
BLOCKS = 1024
SHARDS = 64
#: The plan of more sources than these is joined by a shuffle.
BROADCAST_SOURCES = 20_000
SEED = 97


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, passes: float) -> list[float]:
    """Words of each source: shares by weight, none above ``passes`` times its size, the excess shared again."""
    found = [0.0] * len(sizes)
    open_, left = [i for i, s in enumerate(sizes) if s], share * sum(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if unit * weights[i] > passes * sizes[i]]
        for i in over or open_:
            found[i] = float(passes * sizes[i]) if over else unit * weights[i]
        if not over:
            break
        left -= sum(found[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return found


def split_quotas(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (column) for each shard (row): the leaves of the splitting tree."""
    rng = np.random.default_rng(seed)
    leaves = np.zeros((shards, len(quotas)), np.int64)
    nodes = [(0, shards, np.asarray(quotas, np.int64))]
    while nodes:
        low, high, held = nodes.pop()
        if high - low == 1:
            leaves[low] = held
            continue
        middle = (low + high) // 2
        to_left = int(held.sum()) * (middle - low) // (high - low)
        left = rng.multivariate_hypergeometric(held, to_left, method="marginals") if len(held) else held
        nodes += [(middle, high, held - left), (low, middle, left)]
    return leaves


def plan_sources(sources: Sequence[Row], weights: Sequence[float], share: float, passes: int, shards: int, seed: int) -> list[tuple]:
    """One row for each source: place, name, rows, size, target, block length, blocks, draws, permutation, shard starts."""
    names = sorted((r for r in sources), key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["size"]) for r in names]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(names))], share, passes)
    rng, total, plan = np.random.default_rng(seed), sum(sizes), []
    for i, row in enumerate(names):
        length = max(1, min(BLOCK_WORDS, sizes[i] // BLOCKS), total // MOST_BLOCKS)
        blocks = -(-sizes[i] // length)
        draws = min(passes * blocks, round(wanted[i] / length))
        step = int(rng.integers(1, max(blocks, 2)))
        while math.gcd(step, blocks) > 1:
            step = int(rng.integers(1, blocks))
        shifts = [int(x) for x in rng.integers(0, max(blocks, 1), passes)]
        plan.append((i, row["source"], int(row["n"]), sizes[i], wanted[i], length, blocks, draws, step, shifts))
    parts = split_quotas([p[7] for p in plan], shards, seed)
    starts = np.vstack([np.zeros((1, len(plan)), np.int64), np.cumsum(parts, axis=0)[:-1]])
    return [(*p, [int(x) for x in starts[:, i]]) for i, p in enumerate(plan)]


PLAN = ("_place int, _source string, _n long, _source_size long, _target double, _length long, _blocks long, _draws long, "
        "_step long, _shifts array<long>, _starts array<long>")


def mix_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", keep: Sequence[str] = (),
                  weights: Sequence[float] = WEIGHTS, share: float = SHARE, passes: int = PASSES, shards: int = SHARDS,
                  seed: int = SEED) -> DataFrame:
    """``id_column``, ``size``, ``source_size``, ``target``, ``taken``, ``pieces`` and the columns of ``keep``, for every row.

    A piece is a run of words of the document that the mix takes: ``pass``,
    ``block``, ``start`` (words of the document before it), ``words``, ``shard`` and
    ``turn``, its place in the local shuffle of the shard.

    - A null or empty text has size 0 and no pieces; a null source is a source, the last one.
    - A null id is an id like others; repeated rows are taken one by one.
    - The order depends on ids and sizes alone, so reruns agree.
    - Columns of ``keep`` must differ from the names above; other columns are left out.
    - No rows give no rows.
    """
    size = F.coalesce(F.regexp_count(column(docs, text), F.lit(WORD)), F.lit(0)).cast("long")
    kept = [column(docs, c) for c in keep]
    rows = docs.select(column(docs, id_column).alias("_id"), column(docs, source).alias("_name"), size.alias("size"), *kept)
    light = Saved(rows.select("_id", "_name", "size"), "sizes")
    sources = light.df.groupBy(F.col("_name").alias("source")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).collect()
    known = plan_sources(sources, weights, share, passes, shards, seed)
    plan = docs.sparkSession.createDataFrame(known, PLAN)
    if len(known) <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)

    def of_source(some: DataFrame) -> DataFrame:
        return some.join(plan, F.col("_name").eqNullSafe(F.col("_source"))).drop("_name", "_source")

    few = of_source(light.df).select("_place", "_n", "_id", "size")
    placed = of_source(rows) if keep else of_source(light.df)
    placed = running_total(placed, "_place", "size", ["_id", "size"], "_before", light=few)

    first = F.expr("_before div _length")
    last = F.expr("(_before + size - 1) div _length")

    def draw(turn: int):
        def piece(b):
            at = F.pmod(b * F.col("_step") + F.col("_shifts")[turn], F.col("_blocks")) + F.col("_blocks") * turn
            start = F.greatest(b * F.col("_length") - F.col("_before"), F.lit(0))
            end = F.least((b + 1) * F.col("_length") - F.col("_before"), F.col("size"))
            shard = F.size(F.filter("_starts", lambda s: s <= at)) - 1
            return F.struct(
                F.lit(turn).alias("pass"), b.alias("block"), start.alias("start"), (end - start).alias("words"),
                shard.alias("shard"), at.alias("at"), F.xxhash64(F.lit(seed), "_place", at).alias("turn"))

        drawn = F.filter(F.transform(F.sequence(first, last), piece), lambda p: p["at"] < F.col("_draws"))
        return F.when(F.col("size") > 0, drawn)

    pieces = F.array_compact(F.flatten(F.array(*[F.coalesce(draw(t), F.array()) for t in range(passes)])))
    out = placed.withColumn("pieces", pieces)
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    return out.select(
        F.col("_id").alias(id_column), "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        taken.alias("taken"), "pieces", *keep)


def shard_rows(mixed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row for each piece, shard by shard, each shard shuffled."""
    rows = mixed.withColumn("piece", F.explode("pieces")).drop("pieces")
    rows = rows.withColumns({"shard": F.col("piece.shard"), "turn": F.col("piece.turn")})
    return rows.repartition(shards, "shard").sortWithinPartitions("shard", "turn", "piece.start")


def mixed_texts(mixed: DataFrame, text: str = "text", passes: int = PASSES) -> DataFrame:
    """One row for each document and pass that takes words of it, with the words taken as ``text``.

    A text that is taken whole stays as it is; of others the words taken are joined by one space.
    """
    rows = mixed.withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    rows = rows.withColumn("_runs", F.array_sort(F.transform(F.filter("pieces", lambda p: p["pass"] == F.col("_pass")), lambda p: F.struct(p["start"], p["words"]))))
    taken = F.aggregate("_runs", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    rows = rows.filter(F.size("_runs") > 0)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    rows = rows.withColumn("_words", F.when(taken < F.col("size"), words))
    cut = F.array_join(F.flatten(F.transform("_runs", lambda p: F.slice(F.col("_words"), p["start"].cast("int") + 1, p["words"].cast("int")))), " ")
    return rows.withColumn(text, F.when(F.col("_words").isNull(), F.col(text)).otherwise(cut)).drop("_pass", "_runs", "_words")
