"""Vector links against all pairs."""

import math

import numpy as np
import pytest

from assayloom.llm.embeddings import embedding_components, plan_tables


def plain(rows, similarity=0.93):
    """(id, n_links, component, kept) by comparing all pairs, and the number of links."""
    def fit(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if lab is not None and fit(v) else None for _, v, lab in rows]
    near = [[j for j in range(len(rows)) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= similarity] for i in range(len(rows))]
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((vec_id, len(near[i]), least, vec_id == least))
    return sorted(out, key=str)


def build(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def result(df, **kw):
    return sorted((tuple(r) for r in embedding_components(df, **kw).collect()), key=str)


def test_recall_on_a_whole_table(spark):
    """The given vectors and noisy copies of half of them, most of them close to the threshold."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    rng = np.random.default_rng(7)
    for vec_id, vector, label in rows[::2]:
        noise = rng.standard_normal(len(vector))
        noise *= np.linalg.norm(vector) / np.linalg.norm(noise) * rng.uniform(0.2, 0.42)
        rows.append((100_000 + vec_id, (np.array(vector) + noise).astype(np.float32).tolist(), label))
    want = {r[0]: r for r in plain(rows)}
    got = {r[0]: r for r in result(build(spark, rows))}
    assert got.keys() == want.keys()
    links = sum(r[1] for r in want.values())
    assert links > 300 and all(got[i][1] <= want[i][1] for i in got)
    assert sum(r[1] for r in got.values()) >= 0.97 * links


@pytest.mark.parametrize("block_rows", [2048, 3])
def test_hot_group(spark, block_rows):
    """Copies, near copies and others; the hot bucket is cut into blocks of about three."""
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + rng.standard_normal(16) * 0.05).tolist(), 1) for i in range(40)]
    rows += [(100 + i, centre.tolist(), 1) for i in range(20)]
    rows += [(200 + i, rng.standard_normal(16).tolist(), i % 3) for i in range(60)]
    rows = [(i, np.array(v, np.float32).tolist(), lab) for i, v, lab in rows]
    assert result(build(spark, rows), recall=0.9999, block_rows=block_rows) == plain(rows)


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1),
        (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (None, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1),
        (12, [1.0, 0.0, 0.0], 1), (None, [0.0, 5.0], 7), (13, [3e38, 3e38], 3), (14, [1e-30, 1e-30], 3),
    ]
    want = [r if r[0] is not None else (*r[:3], r[2] is None) for r in plain(rows)]
    assert result(build(spark, rows)) == sorted(want, key=str)
    assert embedding_components(build(spark, [])).count() == 0
    clash = build(spark, rows[:3]).selectExpr("*", "1 as node", "2 as vector", "3 as id")
    assert len(result(clash)) == 3


def test_tables_grow_with_the_rows():
    assert plan_tables(10**9, 0.93, 0.995)[0] > plan_tables(10**5, 0.93, 0.995)[0]
