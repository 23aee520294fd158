"""Fill-in-middle against a plain reading of the contract in Python."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayloom.llm.middle import FenwickTree, Units, fill_in_middle, restored
from assayloom.llm.queries import op12_fill_in_middle_fenwick
from conftest import SF


def expected(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fenwick_tree_descends_like_a_search_in_prefix_sums():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 7, 8, 9, 100):
        units = np.array([rng.choice([0, 0, 1, 5]) for _ in range(n)], np.int64)
        chars = units * 3 + 1
        tree, sums = FenwickTree(units, chars), np.r_[0, np.cumsum(units)]
        for wanted in range(int(sums[-1]) + 2):
            at = int(np.searchsorted(sums, wanted, side="right")) - 1
            assert tree.descend(wanted) == (at, wanted - sums[at], chars[:at].sum())


@pytest.mark.parametrize("block", [1, 3, 16, 512])
def test_places_in_texts_of_many_blocks(block):
    rng = random.Random(block)
    for _ in range(60):
        text = "".join(rng.choice(["a", "bc", "Z", " ", "\n", "é", "漢", "😀", "@", "[", "`", "{", "\0"]) for _ in range(rng.randrange(90)))
        units = Units(np.frombuffer(text.encode(), np.uint8), block)
        parts = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
        assert units.count == len(parts)
        assert [units.chars_before(i) for i in range(len(parts) + 1)] == [len("".join(parts[:i])) for i in range(len(parts) + 1)]


ODD = [None, "", " ", "a", "<P>", "a <S> b", "x<M", "<", "<<<", "P>S>M>", "<P", "é漢😀 und mehr " * 40, "word " * 60000, "x" * 300000, "漢" * 5000]


def test_odd_texts(documents):
    rows = [(i, t) for i, t in enumerate(ODD * 6)] + [(None, "no id"), (None, None), (3, "a"), (3, "a")]
    made = fill_in_middle(documents(rows))
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect()), key=str)
    assert got == sorted(((i, *expected(i, t)) for i, t in rows), key=str)
    assert {g[2] for g in got} == {"plain", "psm", "spm"}
    back = made.select("doc_id", restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert sorted(((r.doc_id, r.t) for r in back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)


def test_empty_table_and_clashing_names(spark, documents):
    assert fill_in_middle(documents([])).collect() == []
    named = spark.createDataFrame([(1, "a b", "x", "y", 7)], "doc_id long, text string, output string, `_text` string, `n.a` long")
    row = fill_in_middle(named, keep=["_text", "n.a"]).first()
    assert (row["doc_id"], row["n"], row["output"], row["_text"], row["n.a"]) == (1, 3, expected(1, "a b")[4], "y", 7)


def test_query_on_the_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {i: expected(i, t) for i, t in texts.items()}
    got = op12_fill_in_middle_fenwick(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        n, form, prefix, middle, output = want[r.doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == digest(output) and r.restored_sha256 == digest(texts[r.doc_id] or "")
