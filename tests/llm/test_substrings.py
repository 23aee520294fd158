"""Repeated windows against a count of all windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from assayloom.llm import substrings
from assayloom.llm.queries import op5_substring_super_kmers
from assayloom.llm.substrings import remove_repeated_windows, window_classes


def plain(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def result(df, **kw):
    return sorted((tuple(r) for r in remove_repeated_windows(df, **kw).collect()), key=str)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in plain(rows, 35)]
    got = sorted((tuple(r) for r in op5_substring_super_kmers(spark, sf).collect()), key=str)
    assert got == sorted(want, key=str) and sum(r[2] for r in got) > 1000


@pytest.mark.parametrize("bucket_rows", [12_000, 1])
def test_edges(documents, bucket_rows):
    rnd = random.Random(2)
    few = lambda n, k: " ".join(rnd.choice([f"w{i}" for i in range(k)]) for _ in range(n))
    passage = few(80, 500)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "short text"), (4, "short text"), (5, "a " * 3000), (6, "a b c " * 200), (None, few(60, 900)),
            (7, "é😀 " * 34), (8, "x\t" * 35), (9, "x  " * 36), (10, few(400, 2)), (11, few(300, 3))]
    rows += [(20 + i, f"{few(20, 900)} {passage} {few(30, 900)}") for i in range(6)]
    rows += [(40, few(100, 900) + " end")] * 3 + [(41, rows[13][1])]
    assert result(documents(rows), bucket_rows=bucket_rows) == plain(rows, 35)
    assert result(documents(rows), window=5, bucket_rows=bucket_rows) == plain(rows, 5)


def test_frequent_minimisers_come_last(documents, monkeypatch):
    monkeypatch.setattr(substrings, "LEAST_FREQUENT", 3)
    monkeypatch.setattr(substrings, "FREQUENT", 0.0)
    rnd = random.Random(3)
    few = lambda n: " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))
    passage = few(60)
    rows = [(i, f"{few(40)} {passage} {few(rnd.randrange(60))}") for i in range(40)]
    assert result(documents(rows)) == plain(rows, 35)


def test_empty_table_and_clashing_names(documents):
    assert result(documents([])) == []
    clash = documents([(1, "a b")]).withColumnsRenamed({"lang": "parts", "source": "id", "n_chars": "kept"})
    assert result(clash) == [(1, 2, 0, "a b")]


def test_window_classes():
    rnd = np.random.default_rng(0)
    for window in (1, 2, 3, 5, 7, 9, 20, 27, 35, 60):
        values = rnd.integers(0, 2, 400)
        values[200:300] = values[:100]
        got = window_classes(values, window)
        want = [tuple(values[i : i + window]) for i in range(400 - window + 1)]
        assert len(got) == len(want) and len(set(zip(got.tolist(), want))) == len(set(want)) == len(set(got.tolist()))


def test_minimisers_that_share_bits(documents, monkeypatch):
    """A full table of bits sends more strings, the result is the same."""
    monkeypatch.setattr(substrings, "TABLE_WORDS", 2)
    monkeypatch.setattr(substrings, "ROW_WORDS", 1)
    rnd = random.Random(4)
    few = lambda n: " ".join(f"w{rnd.randrange(3000)}" for _ in range(n))
    passage = few(50)
    rows = [(i, f"{few(90)} {passage} {few(90)}" if i % 3 else few(200)) for i in range(30)]
    assert result(documents(rows)) == plain(rows, 35)


def test_bit_table(spark):
    keys = np.random.default_rng(5).integers(0, 1 << 62, 4000)
    table = substrings.bit_table(spark.createDataFrame([(int(k),) for k in keys[:2000]], "key long"))
    hit = substrings.marked(table, keys.view(np.uint64))
    assert len(table) == substrings.TABLE_WORDS and hit[:2000].all() and hit[2000:].sum() < 20
    assert not substrings.bit_table(spark.createDataFrame([], "key long")).any()
