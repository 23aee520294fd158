"""Centroid clustering with ns-bounds, exact in integers.

Each vector keeps a lower bound of its distance to every centroid and the round in
which that distance was last evaluated.  A later round loosens a bound by the norm
of the total displacement of the centroid since then, for which the centroids of
all rounds are kept; the sum of the drifts of single rounds would loosen it more.
Only centroids whose bound does not exceed the distance to the own centroid are
evaluated again, exactly.

The table of vectors and bounds is written anew in each round and never moves
between tasks.  Centroids change by the sums of the vectors that changed sides, so
a round reads the vectors of those alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Saved, column

#: Components up to this size give squared distances of 64 of them below 2**63.
LARGEST = 1 << 27
#: Vectors that are judged at a time in a task.
ROWS_AT_ONCE = 4096
#: Bounds are stored in single precision and compared with this much slack, far above its rounding.
SLACK = 1e-6


def scaled(vector: Column, scale: float) -> Column:
    """Components times ``scale``, rounded down, as integers."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def fit_vector(vector: Column, width: int, scale: float) -> Column:
    """The right number of components, all of them finite and of a size whose distances fit into a long."""
    small = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < LARGEST)
    return F.coalesce((F.size(vector) == width) & F.forall(vector, small), F.lit(False))


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors to a centroid, or of pairs of rows."""
    gap = x - centroid
    return np.einsum("...i,...i->...", gap, gap)


class History:
    """Centroids of all rounds so far, ``rounds x k x width``."""

    def __init__(self, rounds: list[np.ndarray]):
        self.now = len(rounds) - 1
        self.centroids = np.stack(rounds)
        gaps = (self.centroids - self.centroids[-1]).astype(np.float64)
        #: how far each centroid is from where it was in each earlier round
        self.moved = np.sqrt((gaps * gaps).sum(axis=2)) * (1 + SLACK)

    def assign(self, x: np.ndarray, own: np.ndarray, bounds: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest centroid of each vector and its exact squared distance; mends ``bounds`` and ``seen`` in place.

        ``own`` is the centroid of the last round, ``bounds`` the distances when they
        were evaluated and ``seen`` those rounds.  Also gives the number of
        evaluations of each vector.
        """
        rows, k = np.arange(len(x)), bounds.shape[1]
        # a bound for the own centroid is a distance: loosened, it holds from above
        slack = 1 + SLACK
        above = bounds[rows, own] * slack + self.moved[seen[rows, own], own]
        below = bounds * (1 - SLACK) - self.moved[seen, np.arange(k)]
        open_ = below <= (above * slack + SLACK)[:, None]
        open_[rows, own] = False
        best = np.full(len(x), -1, np.int64)
        nearest = own.copy()
        cost = np.zeros(len(x), np.int64)
        # the distance to the own centroid first, it closes most of the open ones
        some = np.flatnonzero(open_.any(axis=1) | (self.moved[seen[rows, own], own] > 0))
        exact = squared(x[some], self.centroids[-1][own[some]])
        best[some] = exact
        self._note(bounds, seen, some, own[some], exact)
        cost[some] += 1
        open_[some] &= below[some] <= (np.sqrt(exact) * slack + SLACK)[:, None]
        some = some[open_[some].any(axis=1)]
        for j in range(k):
            at = some[open_[some, j]]
            if not len(at):
                continue
            found = squared(x[at], self.centroids[-1][j])
            self._note(bounds, seen, at, j, found)
            cost[at] += 1
            better = (found < best[at]) | ((found == best[at]) & (j < nearest[at]))
            best[at[better]], nearest[at[better]] = found[better], j
        still = np.flatnonzero(best < 0)
        best[still] = squared(x[still], self.centroids[-1][own[still]])
        return nearest, best, cost

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Evaluate everything: nearest centroid, its distance, bounds, rounds."""
        every = np.stack([squared(x, c) for c in self.centroids[-1]], axis=1)
        nearest = every.argmin(axis=1)  # the first of equal ones
        seen = np.full(every.shape, self.now, np.int8)
        return nearest, every[np.arange(len(x)), nearest], np.sqrt(every).astype(np.float32), seen

    def _note(self, bounds: np.ndarray, seen: np.ndarray, rows, j, distance: np.ndarray) -> None:
        bounds[rows, j] = np.sqrt(distance)
        seen[rows, j] = self.now


def _matrix(lists: pa.Array, rows: int, kind) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(rows, -1)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


STATE = "id {id}, vector array<int>, cluster int, before int, bounds array<float>, seen array<tinyint>"


def next_state(state: DataFrame, rounds: list[np.ndarray], schema: str, last: bool) -> DataFrame:
    """One assignment of every vector; the last one gives ``id, cluster, distance``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history = History(rounds)
        for whole in batches:
            for low in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(low, ROWS_AT_ONCE)
                n = batch.num_rows
                x = _matrix(batch["vector"], n, np.int64)
                if history.now:
                    own = batch["cluster"].to_numpy().astype(np.int64)
                    bounds = _matrix(batch["bounds"], n, np.float32)
                    seen = _matrix(batch["seen"], n, np.int8)
                    nearest, distance, _ = history.assign(x, own, bounds, seen)
                else:
                    own = np.full(n, -1, np.int64)
                    nearest, distance, bounds, seen = history.first(x)
                cluster = pa.array(nearest, pa.int32())
                if last:
                    yield pa.RecordBatch.from_arrays([batch["id"], cluster, pa.array(distance)], ["id", "cluster", "distance"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [batch["id"], batch["vector"], cluster, pa.array(own, pa.int32()), _lists(bounds, pa.float32()),
                         _lists(seen, pa.int8())],
                        ["id", "vector", "cluster", "before", "bounds", "seen"])

    return state.mapInArrow(run, schema)


def changes(state: DataFrame, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """What the last round adds to the counts and the component sums of the centroids.

    Read from the vectors that changed sides; each task sums up its own first.
    The driver gets the sums of ``k`` centroids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            x = _matrix(batch["vector"], batch.num_rows, np.int64) if batch.num_rows else np.zeros((0, width), np.int64)
            for name, sign in (("cluster", 1), ("before", -1)):
                at = batch[name].to_numpy().astype(np.int64)
                for j in np.unique(at[at >= 0]):
                    mine = x[at == j]
                    counts[j] += sign * len(mine)
                    sums[j] += sign * mine.sum(axis=0)
        where = pa.array(np.arange(k), pa.int32())
        yield pa.RecordBatch.from_arrays([where, pa.array(counts), _lists(sums, pa.int64())], ["cluster", "n", "sums"])

    moved = state.filter("cluster <> before").select("vector", "cluster", "before")
    parts = moved.mapInArrow(run, "cluster int, n long, sums array<bigint>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
    total = each.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("part").alias("part"))
    counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
    for row in total.collect():
        counts[row["cluster"]], sums[row["cluster"], row["at"]] = row["n"], row["part"]
    return counts, sums


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, width: int = 64, scale: float = 256.0, seed: str = "2",
                    id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id_column``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256`` of every kept vector.

    Kept are vectors of ``width`` components, none null or not finite, and none
    so large (2**27 after scaling) that a squared distance would not fit into a
    long.  Components become integers; centroids are rounded down, so everything
    is exact and reruns agree.

    - Centroids start as the ``k`` vectors with the smallest digests of their ids, ties by the vector.
      Fewer vectors give fewer centroids; equal ones may start more than one, the smaller number wins.
    - A centroid without vectors stays where it is.
    - Repeated rows each count; a null id is hashed as an empty text.
    - Columns other than the result are left out; no kept vectors give no rows.
    """
    fit = fit_vector(F.col("vector"), width, scale)
    rows = vectors.select(column(vectors, id_column).alias("id"), column(vectors, vector).alias("vector")).filter(fit)
    rows = rows.select("id", scaled(F.col("vector"), scale).cast("array<int>").alias("vector"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    start = rows.orderBy(digest, "vector").limit(k).collect()
    id_type = rows.schema["id"].dataType.simpleString()
    result = (f"`{id_column}` {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    if not start:
        return rows.sparkSession.createDataFrame([], result)
    schema = STATE.format(id=id_type)
    history = [np.array([r["vector"] for r in start], np.int64)]
    counts, sums = np.zeros(len(start), np.int64), np.zeros((len(start), width), np.int64)
    final = f"id {id_type}, cluster int, distance long"
    state = Saved(next_state(rows, history, schema if rounds else final, not rounds), "clusters", lean=True)
    for turn in range(1, rounds + 1):
        more, part = changes(state.df, len(start), width)
        counts, sums = counts + more, sums + part
        full = counts > 0
        centroids = history[-1].copy()
        centroids[full] = sums[full] // counts[full, None]  # rounds down
        history.append(centroids)
        last = turn == rounds
        later = Saved(next_state(state.df, history, final if last else schema, last), "clusters", lean=True)
        state.discard()
        state = later
    # a row for each centroid that has vectors
    inertia = {r["cluster"]: r["inertia"] for r in state.df.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    facts = pa.table({
        "cluster": pa.array(list(inertia), pa.int32()),
        "cluster_inertia": pa.array(list(inertia.values()), pa.int64()),
        "inertia": pa.array([sum(inertia.values())] * len(inertia), pa.int64()),
        "centroid_sha256": [hashlib.sha256(",".join(map(str, history[-1][j].tolist())).encode()).hexdigest() for j in inertia],
    })
    facts = F.broadcast(rows.sparkSession.createDataFrame(facts))
    return state.df.join(facts, "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
