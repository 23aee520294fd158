"""Clustering against the plain algorithm, and the bounds against full evaluation."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np

from assayloom.llm.clusters import History, cluster_vectors, squared
from assayloom.llm.queries import op11_centroids_ns_bounds
from conftest import SF


def plain(rows, k=40, rounds=5, width=64):
    """The contract word by word, in Python integers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * float(x)) for x in v]))
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    start = sorted(kept, key=lambda r: (digest(f"2:{'' if r[0] is None else r[0]}"), r[1]))[:k]
    centroids = [v for _, v in start]
    x = np.array([v for _, v in kept], object).reshape(len(kept), width)

    def nearest():
        costs = np.stack([((x - np.array(c, object)) ** 2).sum(axis=1) for c in centroids], axis=1)
        return [min((c, j) for j, c in enumerate(row))[::-1] for row in costs.tolist()]

    if not kept:
        return []
    for _ in range(rounds):
        where = [j for j, _ in nearest()]
        for j in set(where):
            mine = [v for (_, v), w in zip(kept, where) if w == j]
            centroids[j] = [sum(c) // len(mine) for c in zip(*mine)]
    found = nearest()
    inertia = sum(d for _, d in found)
    by = {j: sum(d for w, d in found if w == j) for j, _ in found}
    return [(i, j, d, by[j], inertia, digest(",".join(map(str, centroids[j])))) for (i, _), (j, d) in zip(kept, found)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_whole_table(spark):
    source = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert rows_of(op11_centroids_ns_bounds(spark, SF)) == sorted(plain([tuple(r) for r in source]), key=str)


def test_odd_vectors_ties_and_repeats(spark):
    rng = random.Random(4)
    some = [[rng.choice([-0.5, 0.0, 0.25]) for _ in range(64)] for _ in range(30)]
    rows = [(i, rng.choice(some), 1) for i in range(150)] + [(7, some[0], 1)] * 40
    rows += [(None, some[1], 1), (None, some[2], None), (900, None, 1), (901, [], 1), (902, [1.0] * 63, 1), (903, [1.0] * 65, 1),
             (904, [None] + [1.0] * 63, 1), (905, [float("nan")] + [1.0] * 63, 1), (906, [float("inf")] + [1.0] * 63, 1),
             (907, [-200.3] * 64, 1), (908, [0.0] * 64, 1), (909, [-0.0] * 64, 1)]
    got = rows_of(cluster_vectors(table(spark, rows).repartition(5)))
    assert got == sorted(plain([(i, v) for i, v, _ in rows]), key=str)
    # a component whose distances would not fit into a long
    assert rows_of(cluster_vectors(table(spark, [*rows, (910, [1e7] * 64, 1)]))) == got


def test_few_and_no_vectors(spark):
    few = [(i, [float(i % 3)] * 64, 1) for i in range(7)]
    assert rows_of(cluster_vectors(table(spark, few))) == sorted(plain([(i, v) for i, v, _ in few]), key=str)
    assert cluster_vectors(table(spark, [])).collect() == []
    assert cluster_vectors(table(spark, [(1, None, 1)])).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    short = spark.createDataFrame([(i, [i * 0.5, -i * 0.25], 3) for i in range(20)], "`vec.id` long, cluster array<double>, distance int")
    got = cluster_vectors(short, 3, 0, 2, id_column="vec.id", vector="cluster")
    assert rows_of(got) == sorted(plain([(i, [i * 0.5, -i * 0.25]) for i in range(20)], 3, 0, 2), key=str)


def test_bounds_hold_and_spare_evaluations():
    rng = np.random.default_rng(2)
    x = rng.integers(-200, 200, (3000, 64))
    x[1000:2000] = x[:1000] + rng.integers(-3, 4, (1000, 64))
    rounds, spent = [x[:25].copy()], 0
    own, _, bounds, seen = History(rounds).first(x)
    for _ in range(8):
        centroids = rounds[-1].copy()
        for j in np.unique(own):
            centroids[j] = x[own == j].sum(axis=0) // (own == j).sum()
        rounds.append(centroids)
        history = History(rounds)
        own, best, cost = history.assign(x, own, bounds, seen)
        every = np.stack([squared(x, c) for c in centroids], axis=1)
        assert (own == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
        # what is stored is the distance to the centroid of the round in which it was seen
        for j in range(25):
            then = history.centroids[seen[:, j], j]
            assert np.allclose(bounds[:, j], np.sqrt(squared(x, then)), rtol=1e-6)
        spent += cost.sum()
    assert spent < 0.8 * 8 * 25 * len(x)


def test_total_displacement_is_tighter_than_summed_drifts():
    there_and_back = [np.zeros((1, 64), np.int64), np.full((1, 64), 50), np.zeros((1, 64), np.int64)]
    assert History(there_and_back).moved[0, 0] == 0
