"""The pipeline, stage by stage, against brute force."""

import re
from collections import Counter

import pytest
from test_mixing import plain_targets
from test_packing import check
from test_secrets import plain_base
from test_simhash import plain_kept

import corpus_pipeline
from assayloom.llm.tables import Saved

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = Saved(stage(spark, docs, SF), name).df
        out.append(docs)
    return [d.collect() for d in out]


def test_columns(steps):
    for rows in steps[:5]:
        assert list(rows[0].asDict()) == corpus_pipeline.COLUMNS


def test_language_keeps_clean_documents(steps):
    assert len(steps[1]) >= 0.99 * len(steps[0])
    assert {tuple(r) for r in steps[1]} <= {tuple(r) for r in steps[0]}


def test_near_duplicates(steps):
    before, after = ({r["doc_id"]: r for r in rows} for rows in steps[1:3])
    assert len(after) == len(steps[2]) and all(before[i] == r for i, r in after.items())
    want = plain_kept([(i, r["text"]) for i, r in before.items()])
    assert sorted(((i, r["text"] or "") for i, r in after.items()), key=str) == want and len(after) < len(before)


def test_secrets(steps):
    before, after = ({r["doc_id"]: r["text"] for r in rows} for rows in steps[2:4])
    assert before.keys() == after.keys()
    for i, text in before.items():
        if text == after[i]:
            assert not plain_base(text)
    assert not any(plain_base(t) for t in after.values()) and any(before[i] != after[i] for i in before)


def test_mix(steps):
    size, taken, words = Counter(), Counter(), {}
    for r in steps[3]:
        words[r["doc_id"]] = WORD.findall(r["text"])
        size[r["source"]] += len(words[r["doc_id"]])
    times = Counter()
    for r in steps[4]:
        got = WORD.findall(r["text"])
        taken[r["source"]] += len(got)
        times[r["doc_id"]] += 1
        assert not Counter(got) - Counter(words[r["doc_id"]])
    assert max(times.values()) == 2
    names = sorted(size)
    for name, want in zip(names, plain_targets([size[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))])):
        assert abs(taken[name] - want) <= 0.002 * size[name] + 2


def test_packing(steps):
    check(steps[5], [(r["doc_id"], r["text"]) for r in steps[4]])


def test_run(spark, steps):
    place = lambda r: tuple(r)[:5]
    assert Counter(map(place, corpus_pipeline.run(spark, SF).collect())) == Counter(map(place, steps[5]))


def test_odd_rows(spark, documents):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "the cat sat on the mat again", "en", None, 5), (3, "the dog sat on the log today", "en", "a", 5),
            (3, "the dog sat on the log today", "en", "a", 5), (4, "password=hunter2hunter2 is the login", "xx", "b", 5), (5, "word " * 20_000, "en", "a", 5)]
    for docs in (documents(rows).selectExpr("*", "1 as spans", "2 as accepted", "3 as pieces", "4 as print"), documents([])):
        for name, stage in corpus_pipeline.STAGES:
            docs = Saved(stage(spark, docs, SF), name).df
        assert docs.columns[0] == "doc_id" and docs.filter("length > 2048 or offset + length > 2048").count() == 0
