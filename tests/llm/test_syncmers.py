"""Closed syncmers: choice by the window alone, edited texts as defined."""

import hashlib
import random

from pyspark.sql import functions as F

from assayloom.llm.syncmers import INNER, SPAN, edit_fingerprints, positional_matches, with_anchors, with_next


def results(df):
    return {r["doc_id"]: r for r in edit_fingerprints(df).collect()}


def check(rows, got):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1].encode()))
    for n, (doc_id, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        r = got[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest()), doc_id
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_whole_table(spark, table):
    docs = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    got = results(table("documents"))
    assert len(got) == len(docs)
    check(docs, got)
    by_text = {}
    for doc_id, text in docs:
        assert by_text.setdefault(text, got[doc_id]["fingerprint"]) == got[doc_id]["fingerprint"]
    large = [r for r in got.values() if r["n_chars"] > 800]
    near, far = (sum(r[c] for r in large) / len(large) for c in ("near_edited", "near_next"))
    assert near > 0.45 and far < 0.1


def test_edges(documents):
    rows = [(3, None), (1, ""), (2, "one two three"), (7, "é😀x " * 9000), (5, "\n\t "), (None, "last"), (9, "abcd"), (8, "one two three")]
    got = results(documents(rows))
    check(rows, got)
    assert got[2]["fingerprint"] == got[8]["fingerprint"] and got[1]["fingerprint"] == got[3]["fingerprint"] == got[5]["fingerprint"] == ""
    assert got[3]["near_edited"] == 1.0
    assert results(documents([])) == {}
    check([(4, "alone here with some words")], results(documents([(4, "alone here with some words")])))
    clash = documents(rows).withColumnsRenamed({"lang": "next", "source": "print", "n_chars": "edited"})
    assert edit_fingerprints(clash).count() == len(rows)


def test_next_over_many_blocks(spark):
    rnd = random.Random(6)
    ids = [rnd.choice([rnd.randrange(10**6), 77, None]) for _ in range(500)]
    rows = [(i, f"v{n:03}") for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(7)
    got = sorted((tuple(r) for r in with_next(df, "id", ["text"], ["id", "text"], "next").collect()), key=lambda r: r[1])
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    after = {a[1]: b for a, b in zip(order, order[1:] + order[:1])}
    assert len(got) == 500 and all(tuple(n) == after[t] for _, t, n in got)


def test_anchors_are_context_free(documents):
    rnd = random.Random(4)
    passage = [f"w{rnd.randrange(300)}" for _ in range(200)]
    rows = [(1, " ".join(["a", "b", "c"] + passage + ["z"])), (2, " ".join([f"q{i}" for i in range(50)] + passage))]
    found = {r["doc_id"]: {(a["position"], a["hash"]) for a in r["anchors"]} for r in with_anchors(documents(rows), "text", "anchors").collect()}
    inside = lambda at, n: {(p - at, h) for p, h in found[n] if at <= p <= at + 200 - SPAN}
    assert inside(3, 1) == inside(50, 2)
    share = len(inside(3, 1)) / (200 - SPAN + 1)
    assert abs(share - 2 / (SPAN - INNER + 1)) < 0.12
    pairs = with_anchors(with_anchors(documents(rows[:1]), "text", "a").withColumn("other", F.lit(rows[1][1])), "other", "b")
    matched = pairs.select(positional_matches(F.col("a"), F.col("b")).alias("m")).first()["m"]
    assert sum(m["b"] - m["a"] == 47 for m in matched) > 0.9 * len(inside(3, 1))
