"""SimHash against a plain reading of its definition."""

import hashlib
import re

import numpy as np
import pytest
import xxhash

from assayloom.llm.simhash import drop_near_duplicates, simhash_components, tree_links

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    runs = [words[i : i + size] for i in range(len(words) - size + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_roots(rows, size=3, radius=2):
    """Fingerprint of each row, and the function to the first fingerprint of its component."""
    prints = [(i, plain_print(t, size)) for i, t in rows]
    distinct = sorted({p for _, p in prints})
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(distinct):
        for q in distinct[:i]:
            if (p ^ q).bit_count() <= radius:
                root[find(p)] = find(q)
    return prints, find


def plain_kept(rows):
    """One row of each component: the smallest id, then the smallest digest of the text."""
    prints, find = plain_roots(rows)
    best = {}
    for (i, t), (_, p) in zip(rows, prints):
        key = (i is None, i or 0, hashlib.md5((t or "").encode()).digest(), i, t)
        best[find(p)] = min(best.get(find(p), key), key, key=lambda k: k[:3])
    return sorted(((k[3], k[4] or "") for k in best.values()), key=str)


def plain_components(rows, size=3, radius=2):
    prints, find = plain_roots(rows, size, radius)
    least = {}
    for i, p in prints:
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    return sorted(((i, f"{p:016x}", least.get(find(p))) for i, p in prints), key=str)


def spark_components(df, **kw):
    return sorted((tuple(r) for r in simhash_components(df, **kw).collect()), key=str)


def test_whole_table(table):
    rows = [(r[0], r[1]) for r in table("documents").select("doc_id", "text").collect()]
    assert spark_components(table("documents")) == plain_components(rows)


EDGES = [
    (5, None), (4, ""), (9, " \t\n"), (3, "one"), (8, "ONE"), (2, "one  two"), (7, "One\ttwo"), (None, "a b c d"), (6, "a b c d"),
    (6, "a b c d"), (10, "É é É é"), (11, "é é é é"), (12, "x " * 30000), (13, "x x x"), (None, "alone here now"),
]


@pytest.mark.parametrize("tree_rows", [20_000, 2])
def test_edges(documents, tree_rows):
    assert spark_components(documents(EDGES), tree_rows=tree_rows) == plain_components(EDGES)


def test_empty_table_and_clashing_names(spark, documents):
    assert simhash_components(documents([])).count() == 0
    df = documents([(1, "a b c"), (2, "a b c")]).withColumnsRenamed({"lang": "print", "source": "fingerprint"})
    assert sorted(tuple(r)[::2] for r in simhash_components(df).collect()) == [(1, 1), (2, 1)]


def test_trees_find_every_link_of_a_shard():
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 2**63, 60, dtype=np.uint64)
    rows = []
    for c in centre:
        rows += [c ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for a, b in rng.integers(0, 64, (6, 2))]
    prints = np.unique(np.array(rows, np.uint64))
    shard = np.sort(rng.integers(0, 4, len(prints)))
    label = tree_links(prints[:, None], shard, 3)
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 3
    near &= shard[:, None] == shard[None]
    want = np.arange(len(prints))
    for _ in range(len(prints)):
        want = np.where(near, want[None], len(prints)).min(axis=1)
    assert (label == want).all()


def test_hot_shard_is_cut_into_trees(documents):
    """One bucket holds all fingerprints, cut into blocks of about three rows."""
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(words))]
    for i in range(1, 40):
        own = list(words)
        own[int(rng.integers(400))] = f"new{i}"
        rows.append((i, " ".join(own)))
    assert spark_components(documents(rows), tree_rows=3) == plain_components(rows)


def kept(df):
    return sorted(((r["doc_id"], r["text"] or "") for r in drop_near_duplicates(df, ["doc_id", "text"]).collect()), key=str)


def test_near_duplicates(documents):
    rng = np.random.default_rng(2)
    rows = []
    for d in range(30):
        words = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        near = list(words)
        near[int(rng.integers(300))] = "other"
        far = list(words)
        for p in rng.choice(300, 60, replace=False):
            far[p] = "other"
        rows += [(10 * d, " ".join(words)), (10 * d + 1, " ".join(near)), (10 * d + 2, " ".join(far))]
    rows += [(7, None), (3, ""), (5, "same"), (5, "other words"), (None, "same"), (None, "no id"), (None, "no id"), (5, "other words")]
    df = documents(rows)
    assert kept(df) == plain_kept(rows) and len(plain_kept(rows)) < len(rows)
    assert drop_near_duplicates(documents([]), ["doc_id"]).count() == 0
    named = df.withColumnsRenamed({"lang": "root", "source": "digest", "n_chars": "a.b"})
    assert drop_near_duplicates(named, ["doc_id", "root", "digest", "a.b"]).count() == len(plain_kept(rows))
    assert kept(documents(EDGES)) == plain_kept(EDGES)


def test_near_duplicates_of_a_whole_table(table):
    rows = [(r[0], r[1]) for r in table("documents").select("doc_id", "text").collect()]
    assert kept(table("documents")) == plain_kept(rows)
