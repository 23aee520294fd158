"""Rule tables from CSV files, their audits, and the spellings they make known."""

import pytest
from pyspark.sql import functions as F

from assayloom import UnitRules
from assayloom.operators import audits
from assayloom.operators.units import known_spellings, multiplier
from assayloom.sources import rule_tables


@pytest.fixture
def csv(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def test_read_synonyms(spark, csv):
    path = csv("s.csv", 'unit_as_recorded,unit_to_use,note\n x 10\\S\\3/ul ,10^3/uL,""\n๐,"",not a unit\n,ignored,x\n"a,b","c""d",\n')
    rows = rule_tables.read_synonyms(spark, path).orderBy("pos").select("unit_as_recorded", "unit_to_use").collect()
    assert [tuple(r) for r in rows] == [(r"x 10\S\3/ul", "10^3/uL"), ("๐", ""), ("a,b", 'c"d')]


def test_read_conversions(spark, csv):
    path = csv("c.csv", "code,unit_source,unit_target,method,factor,molar_mass,test_name,note,added_by,added_on\n"
                        "1, a ,b,4,1e-6,180,x,,,\n2,c,d,0,,n.a.,y,,,\n")
    table = rule_tables.read_conversions(spark, path).orderBy("pos")
    rows = table.select("code", "unit_source", "unit_target", "method", "factor", "molar_mass").collect()
    assert [tuple(r) for r in rows] == [("1", "a", "b", "4", 1e-6, 180.0), ("2", "c", "d", "0", None, None)]


def test_spelling_precedence(spark):
    synonyms = rule_tables.synonym_table(spark, [("MG/DL", "mg/dL"), ("old", "New"), ("nothing", "")])
    conversions = rule_tables.conversion_table(
        spark, [("1", "NEW", "MMOL/L", "1", 1.0, None), ("2", "mmol/L", "x", "1", 1.0, None)])
    known = dict(known_spellings(synonyms, conversions).collect())
    assert known == {"mg/dl": "mg/dL", "old": "New", "nothing": "", "new": "New", "mmol/l": "mmol/L", "x": "x"}
    clash = audits.spelling_clashes(conversions, synonyms).collect()
    assert [tuple(r) for r in clash] == [("mmol/l", "MMOL/L", "mmol/L", 2)]
    found = audits.conversion_audit(conversions, synonyms).filter("problem like 'spellings%'").collect()
    assert [tuple(r) for r in found] == [(None, "MMOL/L", "mmol/L", "spellings of one unit differ")]
    # a clash asks for a synonym row, it does not refuse the table
    assert audits.conversion_problems(conversions, synonyms).count() == 0


def test_methods(spark):
    cases = [("0", 7.0, 2.0, 1.0), ("1", 7.0, None, 7.0), ("9", 8.457, None, 8.457), ("4", 0.1, 386.65, 0.1 * 386.65),
             ("5", 10.0, 90.078, 10.0 / 90.078)]
    df = spark.createDataFrame(cases, "m string, f double, mm double, want double")
    got = df.select(multiplier(F.col("m"), F.col("f"), F.col("mm")).alias("x"), "want").collect()
    assert all(r["x"] == r["want"] for r in got)


def test_method_without_conversion(spark, lab):
    from assayloom import Harmonization

    units = UnitRules.load(rule_tables.synonym_table(spark), rule_tables.conversion_table(
        spark, [("X", "a", "b", "0", None, None)]))
    row = Harmonization(lab([("f", "1", "X", None, "5", "A")]), units=units).harmonized().first()
    assert (row["unit"], row["number_std"], row["unit_std"], row["conversion_status"]) == ("a", 5.0, "b", "convert")


BAD = [
    ([("mg%", "mg/dL"), ("MG %", "mg/L")], [], "unit synonyms"),
    ([], [("1", "a", "b", "1", 1.0, None), ("1", "a", "c", "1", 1.0, None)], "duplicate pair"),
    ([("MG%", "mg/dL")], [("1", "mg%", "g/L", "1", 1.0, None)], "source unit"),
    ([("MG%", "mg/dL")], [("1", "g/L", "mg%", "1", 1.0, None)], "target unit"),
    ([], [("1", "a", "b", "7", 1.0, None)], "unknown method"),
    ([], [("1", "a", "b", "9", None, None)], "factor is missing"),
    ([], [("1", "a", "b", "4", 1.0, None)], "molar mass is missing"),
]


@pytest.mark.parametrize("synonyms, conversions, message", BAD)
def test_bad_rules_are_refused(spark, synonyms, conversions, message):
    with pytest.raises(ValueError, match=message):
        UnitRules.load(rule_tables.synonym_table(spark, synonyms), rule_tables.conversion_table(spark, conversions))


def test_rule_tables_too_large_to_broadcast(spark, lab, monkeypatch):
    from assayloom import Harmonization
    from assayloom.operators import units as module

    rows = lab([("f", str(i), "200106", "n", "3.5", u) for i, u in enumerate(["MMOL / L", "mg%", None, "odd"])])
    small = Harmonization(rows, units=UnitRules.default(spark))
    monkeypatch.setattr(module, "RULE_ROWS", 1)
    monkeypatch.setattr(module, "_defaults", {})
    large = Harmonization(rows, units=UnitRules.default(spark))
    assert (small.units.large, large.units.large) == (frozenset(), {"spellings", "conversions"})
    got = [sorted(map(str, j.harmonized_in_place().collect())) for j in (small, large)]
    assert got[0] == got[1]


@pytest.mark.parametrize("share", [1e-3, 0.5])
def test_a_frequent_unit_is_not_one_task(spark, monkeypatch, share):
    """One unit and no unit own a third of all rows each; with and without a rule for the frequent one."""
    from assayloom.operators import units as module

    monkeypatch.setattr(module, "HOT_SHARE", share)
    n = 12_000
    units_ = ["MG / DL" if i % 3 == 0 else None if i % 3 == 1 else f"unit {i % 900}" if i % 2 else "hot, no rule" for i in range(n)]
    rows = spark.createDataFrame([(i, "200106", u, {"a": 1}) for i, u in enumerate(units_)], "i int, _lab_code string, u string, m map<string,int>")
    rules = spark.createDataFrame([(f"unit{i}", f"U{i}") for i in range(0, 900, 2)] + [("mg/dl", "mg/dL")], "unit_key string, spelling string")
    small = module.canonical_unit(rows, rules, "u", "agreed").select("i", "agreed")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = module.canonical_unit(rows, rules, "u", "agreed", large=True)
        assert sorted(map(tuple, large.select("i", "agreed").collect())) == sorted(map(tuple, small.collect()))
        assert large.columns == ["i", "_lab_code", "u", "m", "agreed"]
        tasks = [r["count"] for r in large.groupBy(F.spark_partition_id()).count().collect()]
        if share == 1e-3:
            assert max(tasks) < 2 * n / len(tasks)
        numbers = rows.select("i", "_lab_code", F.col("u").alias("unit"), F.lit(2.0).alias("number"), F.lit(None).cast("double").alias("range_low"),
                              F.lit(None).cast("double").alias("range_high"), F.lit("plain_numeric").alias("shape"), F.lit("split").alias("split_action"))
        registry = spark.createDataFrame([("200106", "MG / DL", "g/L", 0.5), ("200106", "unit 4", "x", 3.0), ("2001", "06unit 4", "y", 9.0)],
                                         "code string, unit_source string, unit_target string, multiplier double")
        both = [sorted(map(str, module.standardise(numbers, registry, large).collect())) for large in (False, True)]
        assert both[0] == both[1]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_prepare_keeps_settings_of_the_user(spark):
    from assayloom import prepare

    name = "spark.sql.maxConcurrentOutputFileWriters"
    spark.conf.set(name, "3")
    assert prepare(spark).conf.get(name) == "3"
    spark.conf.unset(name)
    assert prepare(spark).conf.get(name) == "16"
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
