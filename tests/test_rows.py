"""Scope, decisions on rows, and what must hold for any table."""

import pytest
from pyspark.sql import functions as F

from assayloom import Harmonization, LabColumns, RuleSet, ScopeRules
from assayloom.operators.keys import NEW_COLUMNS
from assayloom.plans import reports

ROWS = [
    # file, order, code, name, result, unit
    ("a", "1", "MB7", "Culture", "5", "mg/dL"),
    ("a", "1", None, None, "5", "mg/dL"),          # excluded by its order; the same value occurs in scope
    ("a", "2", None, None, "5", "mg/dL"),
    ("b", "1", "200106", "LDL", "3.5", "mmol/L"),  # the order was seen in the other file
    ("b", None, "MB1", None, "x", None),           # no order: excludes itself only
    ("b", None, None, None, None, None),
    ("b", None, None, None, "", ""),
    ("b", "3", "mb1", "  ", "Positive", None),     # the prefix is case-sensitive
    ("b", "3", "mb1", "n", "Positive", ""),
]


def multiset(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_exclusion(job):
    decisions = job(ROWS).decisions
    counts = {r["file"]: r.asDict() for r in reports.file_summary(decisions).collect()}
    assert (counts["a"]["excluded_rows"], counts["a"]["excluded_linked_rows"], counts["a"]["in_scope_rows"]) == (2, 1, 1)
    assert (counts["b"]["excluded_rows"], counts["b"]["excluded_linked_rows"], counts["b"]["in_scope_rows"]) == (2, 1, 4)


def test_excluded_rows_keep_nothing(job):
    rows = job(ROWS).harmonized().filter("shape = 'microbiology'").collect()
    assert len(rows) == 4
    assert all(r[c] is None for r in rows for c in NEW_COLUMNS if c != "shape")


def test_link_rule_off(job):
    for rules in (RuleSet(scope=ScopeRules(exclude_linked=False)), RuleSet(columns=LabColumns(link=None))):
        total = reports.excluded_counts(job(ROWS, rules=rules).decisions).agg(
            F.sum("excluded_rows"), F.sum("excluded_linked_rows")).first()
        assert tuple(total) == (2, 0)


def test_more_prefixes_and_label(job):
    rules = RuleSet(scope=ScopeRules(prefixes=("MB", "mb"), exclude_linked=False, label="out"))
    shapes = [r["shape"] for r in job(ROWS, rules=rules).harmonized().collect()]
    assert shapes.count("out") == 4


def test_null_and_empty_stay_apart(job):
    """No value and an empty value have one decision each; no row is doubled."""
    j = job(ROWS)
    assert j.lookup is not None
    assert j.harmonized().count() == len(ROWS)
    values = [(r["result"], r["n_rows"]) for r in reports.decisions_table(j.decisions).filter("shape = 'missing'").collect()]
    assert sorted(values, key=str) == [("", 1), (None, 1)]


def test_lookup_and_in_place_agree(job):
    j = job(ROWS)
    assert multiset(j.harmonized()) == multiset(j.harmonized_in_place())
    small = job(ROWS, broadcast_rows=1)
    assert small.lookup is None
    assert multiset(small.harmonized()) == multiset(j.harmonized())


def test_shuffled_link_join_agrees(spark, job):
    rows = ROWS + [("a", "1", "200106", None, str(i), "mg/dL") for i in range(300)]
    rows += [("a", None, "200106", None, str(i), "mg/dL") for i in range(300)]
    wide, narrow = job(rows), job(rows, broadcast_rows=0)
    narrow.others_limits = (-1, -1)  # the filter alone can not tell the orders apart
    plan = narrow.keyed_rows()._jdf.queryExecution().optimizedPlan().toString()
    assert not narrow._broadcast_linked and narrow.order_filter.others is None and "_lab_salt" in plan
    assert multiset(wide.harmonized_in_place()) == multiset(narrow.harmonized_in_place())
    assert multiset(wide.decisions) == multiset(narrow.decisions)


def test_only_rows_that_pass_the_filter_are_shuffled(spark, lab, units):
    """The orders are too many to send and so are the others that pass: rows that fail the filter stay in scan order."""
    n = 20_000
    rows = [("a", str(i) if i % 3 else "7", "MB1" if i % 40 == 0 else "A", None, str(i), "g") for i in range(n)]
    base = lab(rows).withColumn("at", F.monotonically_increasing_id()).coalesce(1)
    sent = Harmonization(base, RuleSet(columns=LabColumns(position="at")), units)
    apart = Harmonization(base, RuleSet(columns=LabColumns(position="at")), units, broadcast_rows=0)
    apart.others_limits = (-1, -1)
    flags = lambda j: [(r["at"], r["_lab_excluded_by"]) for r in j.keyed_rows().select("at", "_lab_excluded_by").collect()]
    got = flags(apart)
    assert sorted(got) == sorted(flags(sent))
    keyed = apart.keyed_rows()
    keyed.write.format("noop").mode("overwrite").save()
    passing = apart.order_filter.words.count() and keyed.filter("_lab_excluded_by = 'link'").count()
    # those in front of the join, in the order of the scan, are all that fail the filter
    still = next(i for i in range(1, n) if got[i][0] < got[i - 1][0])
    assert still > n / 4 and n - still >= passing and [f for _, f in got[:still]].count("link") == 0
    text = keyed._jdf.queryExecution().optimizedPlan().toString()
    left = text[text.index("Join LeftOuter"):]
    assert "rightHint=(strategy=merge)" in left and "Union" in text[:text.index("rightHint=(strategy=merge)")]


def test_one_number_is_the_hashed_key_of_the_lookup(job):
    j = job(ROWS)
    text = j.harmonized()._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in text.splitlines() if "_lab_lookup_key" in line and "BroadcastHashJoin" in line)
    keys = join[join.index("BroadcastHashJoin") :].split("], ", 2)
    assert "_lab_row_key" in keys[0] and "," not in keys[0].split("[")[1] and "_lab_lookup_key" in keys[1] and "," not in keys[1].split("[")[1]


def test_equal_keys_of_different_values_do_no_harm(job, monkeypatch):
    from assayloom.operators import attach as module

    j = job(ROWS + [("b", "4", "200106", None, str(i), "mmol/L") for i in range(40)])
    want = multiset(j.harmonized_in_place())
    monkeypatch.setattr(module, "value_key", lambda *_: F.lit(1).cast("long"))
    assert multiset(j.harmonized()) == want


def test_result_does_not_depend_on_partitions(lab, units):
    base = lab(ROWS * 20)
    got = [multiset(Harmonization(base.repartition(n), units=units).decisions) for n in (1, 5)]
    assert got[0] == got[1]


def test_source_columns(spark, units):
    rows = spark.createDataFrame(
        [("f", 7, "200106", "3.5", "mmol/L", "old", 1.5, "kept")],
        "file string, OBS_ID int, CODE_TEST string, RESULT_VAL string, UNIT string, shape string, Number double, _extra string",
    )
    j = Harmonization(rows, RuleSet(columns=LabColumns(name=None)), units)
    out = j.harmonized()
    row = out.first()
    assert out.columns[:7] == ["file", "OBS_ID", "CODE_TEST", "RESULT_VAL", "unit_recorded", "number_recorded", "_extra"]
    assert out.columns[7:] == NEW_COLUMNS
    assert (row["shape"], row["number_recorded"], row["unit_recorded"], row["_extra"]) == ("plain_numeric", 1.5, "mmol/L", "kept")
    assert row["OBS_ID"] == 7
    assert j.harmonized(keep=["OBS_ID"]).columns == ["OBS_ID", *NEW_COLUMNS]


def test_numeric_result_column(spark, units):
    rows = spark.createDataFrame([("f", 1, 200106, 3.5, "mmol/L")], "file string, OBS_ID int, CODE_TEST int, RESULT_VAL double, UNIT string")
    row = Harmonization(rows, RuleSet(columns=LabColumns(name=None)), units).harmonized().first()
    assert row["number_std"] == pytest.approx(135.3275)


def test_missing_column_is_refused(lab):
    with pytest.raises(ValueError, match="OBS_ID"):
        Harmonization(lab(ROWS).drop("OBS_ID"))


def test_invariants(spark, units):
    from labview import lab_rows

    rows = lab_rows(spark, "/root/testdata/sf0.001")
    j = Harmonization(rows, units=units)
    summary = reports.file_summary(j.decisions)
    n = rows.count()
    assert j.harmonized().count() == n
    assert summary.agg(F.sum("total_rows")).first()[0] == n
    bad = summary.filter("in_scope_rows + excluded_rows <> total_rows OR split_rows + missing_rows + review_rows <> in_scope_rows "
                         "OR parse_failures <> 0")
    assert bad.count() == 0
    typed = ["operator", "number", "range_low", "range_high", "unit", "value", "qualifier"]
    not_split = j.decisions.filter("split_action <> 'split'").filter(F.coalesce(*[F.col(c).cast("string") for c in typed]).isNotNull())
    assert not_split.count() == 0
