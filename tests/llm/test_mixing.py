"""The mix: exact targets, words near them, pieces that tile documents."""

import math
from collections import defaultdict

import numpy as np
import pytest

from assayloom.llm.mixing import mix_documents, plan_sources, shard_rows, split_quotas, targets


def plain_targets(sizes, weights):
    """Water level by bisection."""
    low, high = 0.0, 3.0 * sum(sizes) + 1
    for _ in range(200):
        middle = (low + high) / 2
        if sum(min(2 * s, middle * w) for s, w in zip(sizes, weights)) < 1.5 * sum(sizes):
            low = middle
        else:
            high = middle
    return [min(2 * s, high * w) for s, w in zip(sizes, weights)]


@pytest.mark.parametrize("sizes", [[100, 50, 70], [1000, 1, 1], [0, 10, 10, 10, 5], [5], [10**12, 10**3, 7, 7, 7]])
def test_targets(sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    assert targets(sizes, weights, 1.5, 2) == pytest.approx(plain_targets(sizes, weights), rel=1e-9)


def test_tree_keeps_quotas():
    quotas = [1000, 0, 17, 60_000, 1]
    leaves = split_quotas(quotas, 16, 5)
    assert leaves.sum(axis=0).tolist() == quotas and (leaves >= 0).all()
    assert set(leaves.sum(axis=1)) <= {math.floor(sum(quotas) / 16) + d for d in (-1, 0, 1)}
    # shares of the large source differ by chance as for draws without replacement
    share = leaves[:, 3] - leaves.sum(axis=1) * 60_000 / sum(quotas)
    assert 0 < np.abs(share).max() < 60


def test_whole_table(spark, table):
    docs = table("documents")
    rows = mix_documents(docs).collect()
    texts = {r["doc_id"]: r for r in docs.collect()}
    assert len(rows) == len(texts)
    sizes = {i: len([w for w in r["text"].replace("\t", " ").replace("\n", " ").split(" ") if w]) for i, r in texts.items()}
    taken, size = defaultdict(int), defaultdict(int)
    for r in rows:
        source = texts[r["doc_id"]]["source"]
        assert r["size"] == sizes[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
        size[source] += r["size"]
        for turn in (0, 1):
            runs = sorted((p["start"], p["words"]) for p in r["pieces"] if p["pass"] == turn)
            assert all(a + n <= b for (a, n), (b, _) in zip(runs, runs[1:])) and all(n > 0 for _, n in runs)
            assert not runs or runs[-1][0] + runs[-1][1] <= r["size"]
    names = sorted(size)
    wanted = plain_targets([size[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))])
    for r in rows:
        place = names.index(texts[r["doc_id"]]["source"])
        assert r["source_size"] == size[names[place]] and r["target"] == pytest.approx(wanted[place])
    for s, want in zip(names, wanted):
        assert abs(taken[s] - want) <= max(2, 0.002 * size[s] + 1)
    again = mix_documents(docs.repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_shards_are_disjoint_and_even(spark, table):
    rows = shard_rows(mix_documents(table("documents"), keep=["source"], shards=8), 8).collect()
    draws = defaultdict(set)
    for r in rows:
        p = r["piece"]
        draws[r["source"], p["pass"], p["block"]].add(p["shard"])
    assert all(len(s) == 1 for s in draws.values())
    per_shard = np.bincount([next(iter(s)) for s in draws.values()], minlength=8)
    assert per_shard.max() - per_shard.min() <= 8


def test_edges(documents):
    rows = [(1, None, None, "b"), (2, "", None, "a"), (3, "one two three", None, None), (3, "one two three", None, None), (None, "x y", None, "a"),
            (4, "w " * 50_000, None, "a"), (5, " \t ", None, "empty only")]
    got = sorted(((r["doc_id"], r["size"], r["taken"], r["source_size"]) for r in mix_documents(documents(rows)).collect()), key=str)
    assert [(g[0], g[1], g[3]) for g in got] == sorted([(1, 0, 0), (2, 0, 50_002), (3, 3, 6), (3, 3, 6), (None, 2, 50_002), (4, 50_000, 50_002), (5, 0, 0)], key=str)
    assert all(0 <= g[2] <= 2 * g[1] for g in got)
    assert mix_documents(documents([])).collect() == []
    clash = documents(rows).withColumnsRenamed({"lang": "size", "n_chars": "pieces"})
    assert mix_documents(clash).count() == len(rows)


def test_permutations_reach_every_block():
    from pyspark.sql import Row

    plan = plan_sources([Row(source=f"s{i}", n=5, size=s) for i, s in enumerate([1, 2, 3, 10, 5000, 999_983, 4096 * 5000])], (3, 1, 2), 1.5, 2, 4, 1)
    for _, _, _, size, _, length, blocks, draws, step, shifts, starts in plan:
        assert (blocks - 1) * length < size <= blocks * length and draws <= 2 * blocks and len(starts) == 4
        for shift in shifts:
            assert len({(b * step + shift) % blocks for b in range(blocks)}) == blocks
