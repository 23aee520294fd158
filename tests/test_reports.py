"""Reports on small tables where the answer is known."""

import functools

import pytest
from pyspark.sql import functions as F

from assayloom.plans import reports


def row(file, code, name, result, unit, n=1, link=None):
    return [(file, link, code, name, result, unit)] * n


def test_codes_in_review_count_no_code_as_one(job):
    rows = row("f", None, None, "Clear", None) + row("f", "A", None, "Clear", None) + row("f", "A", None, "Odd", None) \
        + row("g", "A", None, "Clear", None) + row("h", None, None, "Clear", None) + row("i", "A", None, "5", None)
    got = {r["file"]: r["codes_in_review"] for r in reports.file_summary(job(rows).decisions).collect()}
    assert got == {"f": 2, "g": 1, "h": 1, "i": 0}


def test_distribution(job):
    rows = row("f", "A", None, "5", None, 2) + row("f", "A", None, "", None) + row("f", "MB", None, "x", None)
    r = reports.distribution_comparison(job(rows).decisions).first()
    assert (r["total_rows"], r["excluded_rows"], r["split_pct"], r["missing_pct"], r["review_pct"]) == (4, 1, 50.0, 25.0, 0.0)
    assert r["shape_plain_numeric_pct"] == 50.0 and r["shape_short_text_pct"] == 0.0 and r["rows_written"] is None
    assert len([c for c in r.asDict() if c.startswith("shape_")]) == 17


def test_row_count_check(spark):
    source = spark.createDataFrame([("a", 2), ("b", 3)], "file string, total_rows long")
    written = spark.createDataFrame([("a", 2), ("c", 1)], "file string, rows_written long")
    got = sorted(tuple(r) for r in reports.row_count_check(source, written).collect())
    assert got == [("a", 2, 2, True), ("b", 3, 0, False), ("c", 0, 1, False)]


@pytest.mark.parametrize("k", [2, 1500])
def test_top_per_file(spark, job, monkeypatch, k):
    """A small and a large k take different ways to the same rows."""
    rows = [r for i in range(40) for r in row("f", "A", None, f"word {i} x", None, 1 + i % 7)] + row("g", "A", None, "word", None)
    decisions = job(rows).decisions
    got = [tuple(r)[:3] for r in reports.review_top(decisions, k).orderBy("file", F.desc("n_rows"), "result").collect()]
    everything = reports.decisions_table(decisions).filter("split_action = 'review'").orderBy(
        "file", F.desc("n_rows"), "result").collect()
    want, seen = [], {}
    for r in everything:
        seen[r["file"]] = seen.get(r["file"], 0) + 1
        if seen[r["file"]] <= k:
            want.append(tuple(r)[:3])
    assert got == want
    monkeypatch.setattr(reports, "MAP_SIDE_TOP", 1)
    again = [tuple(r)[:3] for r in reports.review_top(decisions, k).orderBy("file", F.desc("n_rows"), "result").collect()]
    assert again == want


def test_small_top_is_cut_before_the_shuffle(job):
    plan = reports.review_top(job(row("f", "A", None, "word", None)).decisions)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_near_misses_against_brute_force(job):
    from assayloom import fixed_values as fixed

    @functools.cache
    def distance(a, b):
        """By its definition: the last step changes, drops or adds a letter."""
        if not a or not b:
            return len(a or b)
        return min(distance(a[1:], b[1:]) + (a[0] != b[0]), distance(a[1:], b) + 1, distance(a, b[1:]) + 1)

    values = ["Male", "DONE", "teacee", "Abnormal", "fewww", "Nagatve", "Maany", "Postitive", "rarely", "detec", "x", "fe", "abc",
              "increse", "two words", "undetecteble", "Marke", "positives", "ตรวจ", "abcdefghijklmnopqrstuvw"]
    decisions = job([r for v in values for r in row("f", None, None, v, None) + row("f", "A", None, v, "g", 2)]).decisions
    in_review = {r["result"] for r in decisions.filter("split_action = 'review'").collect()}
    want = set()
    for v in in_review:
        if 4 <= len(v) <= 20 and " " not in v and v.lower() not in fixed.NEAR_MISS_VOCABULARY:
            best = min((distance(v.lower(), w), w) for w in fixed.NEAR_MISS_VOCABULARY)
            if best[0] <= 2:
                want.add(("f", v, best[1], best[0], 3, 2))
    from assayloom.operators.near_miss import near_misses

    assert {tuple(r) for r in near_misses(decisions).collect()} == want
    assert ("f", "Male", "many", 2, 3, 2) in want


def test_near_misses_in_a_large_vocabulary(spark, job):
    """50,000 words, against every pair of words with a plain edit distance."""
    import random

    from assayloom.operators.near_miss import near_misses_among

    rng = random.Random(8)
    letters = "abcdefgh"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(2, 12))) for _ in range(52_000)}
    words = sorted(words)[:50_000]
    values = [w[:i] + w[i + 2 :] for w in rng.sample(words, 40) for i in (1,)] + ["xx" + w for w in rng.sample(words, 20)]
    values += [w.upper() for w in rng.sample(words, 10)] + ["zzzzzzzz", "Zebra-like"]
    values = sorted({v for v in values if 4 <= len(v) <= 20})
    decisions = job([r for v in values for r in row("f", "A", None, v, None)]).decisions
    review = {r["result"] for r in decisions.filter("split_action = 'review'").collect()}

    def distance(a, b):
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, before = [i], last
            for j, y in enumerate(b, 1):
                last.append(min(before[j - 1] + (x != y), before[j] + 1, last[-1] + 1))
        return last[-1]

    want = set()
    for v in values:
        if v in review:
            near = [w for w in words if abs(len(w) - len(v)) <= 2 and len(set(w) ^ set(v.lower())) <= 4]
            best = min(((distance(v.lower(), w), w) for w in near), default=(9, ""))
            if 0 < best[0] <= 2:
                want.add(("f", v, best[1], best[0], 1, 1))
    vocabulary = spark.createDataFrame([(w.title(),) for w in words] + [(None,), ("q" * 400,)], "word string")
    assert {tuple(r) for r in near_misses_among(decisions, vocabulary).collect()} == want and len(want) > 20
    assert near_misses_among(decisions, vocabulary.limit(0)).count() == 0


def test_cells_of_many_names(job):
    """Texts in byte order whatever their first letters; rows without a code are one key."""
    from assayloom import fixed_values as fixed

    names = ["b", "a | c", "Zeta", "é", "ab", "abcdefg2", "abcdefg10", "abcdefg", "", None, "a"]
    rows = [r for i, n in enumerate(names) for r in row(f"f{i % 3}", None if i % 2 else "A", n, "5", "g", 2)]
    rows += row("f9", None, "abcdefg10", "6", "g", 3)
    d = job(rows).decisions
    got = {r["code"]: r.asDict() for r in reports.code_dictionary(d).collect()}
    for code in (None, "A"):
        mine = [r for r in rows if r[2] == code]
        texts = sorted({r[3] for r in mine if r[3]}, key=lambda t: t.encode())
        assert got[code]["test_names"] == fixed.NAME_SEPARATOR.join(texts)
        assert (got[code]["n_rows"], got[code]["n_files"]) == (len(mine), len({r[0] for r in mine}))
    long = {(r["code"], r["text"]): r["n_rows"] for r in reports.dictionary_entries(d).filter("cell = 'test_names'").collect()}
    assert long[(None, "abcdefg10")] == 3 and long[("A", "abcdefg10")] == 2 and (None, "") not in long
    plan = reports.code_dictionary(d)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan


def test_file_without_rows(spark, job):
    files = spark.createDataFrame([("f",), ("empty",)], "file string")
    got = {r["file"]: r for r in reports.distribution_comparison(job(row("f", "A", None, "5", "g")).decisions, files=files).collect()}
    assert (got["empty"]["total_rows"], got["empty"]["codes_in_review"], got["empty"]["split_pct"]) == (0, 0, None)
    assert got["f"]["split_pct"] == 100.0


def test_unit_reports(job, units):
    rows = (
        row("2011", "200106", "LDL", "5", "mmol/L", 3) + row("2012", "200106", "LDL chol", "5", "mg/dL", 2)
        + row("2012", "200106", "", "5", "odd", 4) + row("2012", "200106", None, "5", None, 1)
        + row("2011", "X", "single", "5", "odd") + row("2012", "X", "single", "5", None)
        + row("2011", "Y", "b", "5", "u1") + row("2012", "Y", "a", "5", "u2") + row("2012", "Y", "a", "Clear", "u3")
    )
    d = job(rows).decisions
    assert {tuple(r) for r in reports.multi_unit_codes(d).collect()} == {("200106", 3), ("Y", 2)}
    got = [tuple(r) for r in reports.units_not_registered(d, units.conversions).collect()]
    assert got == [
        ("200106", "odd", "", 4, 1, "2012"), ("200106", "<blank>", "", 1, 1, "2012"),
        ("Y", "u1", "b", 1, 1, "2011"), ("Y", "u2", "a", 1, 1, "2012"),
    ]
    assert [tuple(r) for r in reports.conversions_applied(d).collect()] == [("200106", "mmol/L", "mg/dL", "LDL", 3, 1, "2011")]
    book = {r["code"]: tuple(r)[1:] for r in reports.code_dictionary(d).collect()}
    assert book["200106"] == ("LDL | LDL chol", "mg/dL | mmol/L | odd", "mg/dL | mmol/L | odd", 10, 2)
    assert book["Y"] == ("a | b", "u1 | u2 | u3", "u1 | u2", 3, 2)


def test_lost_file_fails_the_row_check(spark, job):
    decisions = job([("a", "1", "C", None, "5", "g"), ("b", "2", "C", None, "6", "g")]).decisions
    written = spark.createDataFrame([("a", 1)], "file string, rows_written long")
    got = {r["file"]: (r["rows_written"], r["row_count_match"]) for r in reports.distribution_comparison(decisions, written).collect()}
    assert got == {"a": (1, True), "b": (0, False)}
