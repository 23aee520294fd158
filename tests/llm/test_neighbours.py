"""Nearest neighbours against brute force: exact on small tables, recall on a larger one."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from assayloom.llm import neighbours
from assayloom.llm.neighbours import best_of, nearest_neighbours
from assayloom.llm.queries import op13_neighbours_nn_descent
from conftest import SF


def score(x, y):
    return float((np.array(x, np.float64) * np.array(y, np.float64)).sum())


def plain(rows, k=20, every=20):
    """All candidates of each query, the nearest first."""
    good = {(i, tuple(v)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)}
    out = []
    for q, v in good:
        if q % every == 0:
            hits = sorted((-score(v, w), i) for i, w in good if i != q and len(w) == len(v))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(hits, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert all(abs(a[3] - b[3]) < 1e-9 for a, b in zip(got, want))


def test_whole_table(spark):
    rows = [tuple(r)[:2] for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    same(found(op13_neighbours_nn_descent(spark, SF)), plain(rows))


def test_odd_rows_copies_and_ties(spark):
    rng = random.Random(3)
    some = [[rng.choice([-1.0, 0.5, 0.0, 2.0]) for _ in range(5)] for _ in range(12)]
    rows = [(i, rng.choice(some)) for i in range(-60, 200)]
    rows += [(i, [0.25, 0.5, 1.0]) for i in range(300, 325)] + [(400, [1.0, 2.0]), (401, [-1.0, 2.0]), (420, [1.0])]
    rows += [(500, None), (520, []), (540, [0.0] * 5), (560, [None, 1.0, 1.0, 1.0, 1.0]), (580, [float("nan")] * 5),
             (600, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (None, some[0]), (0, some[1]), (0, some[2]), (20, some[3]), (20, some[3])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, node string")
    got, want = found(nearest_neighbours(table.repartition(4))), plain(rows)
    same(got, want)
    # everything of the only other vector of its dimension, nothing for the last one
    assert [r for r in got if r[0] == 400] == [(400, 1, 401, 3.0)] and not [r for r in got if r[0] == 420]


def test_nothing_to_search(spark):
    table = lambda rows: spark.createDataFrame(rows, "`vec.id` long, embedding array<float>")
    for rows in ([], [(20, None)], [(None, [1.0])], [(1, [1.0]), (2, [2.0])], [(20, [1.0])]):
        out = nearest_neighbours(table(rows), id_column="vec.id")
        assert out.columns == ["query_id", "rank", "vec.id", "score"] and out.collect() == []


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_in_many_buckets(spark, monkeypatch, lengths):
    monkeypatch.setattr(neighbours, "BUCKET_ROWS", 128)
    monkeypatch.setattr(neighbours, "BLOCK_BITS", 6)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((2500, 16))
    x[1000:1800] = x[5] + 0.05 * rng.standard_normal((800, 16))  # near copies of one vector
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths:
        x *= rng.uniform(0.5, 2, (len(x), 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000 + i, x[7].tolist()) for i in range(700)]
    got = found(nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    ids, every = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        like = every @ every[ids == q][0]
        like[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -like.round(12)))[:20]]
        mine = [r for r in got if r[0] == q]
        assert [r[1] for r in mine] == list(range(1, 21))
        hits += len({r[2] for r in mine} & set(best.tolist()))
        total += 20
    assert hits / total >= 0.9


def test_best_of_keeps_the_old_one_of_equal_candidates():
    target, cand = np.array([2, 1, 1, 1, 1, 2]), np.array([5, 9, 8, 9, 7, 5])
    score, fresh = np.array([1.0, 3.0, 2.0, 3.0, 2.0, 1.0]), np.array([True, True, True, False, True, True])
    got = best_of(target, cand, score, fresh, 2)
    assert [list(map(float, c)) for c in got] == [[1, 1, 2], [9, 7, 5], [3, 2, 1], [0, 1, 1]]
