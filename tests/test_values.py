"""Golden values: cleaning, shapes, typed columns, units and conversion."""

import pytest
from pyspark.sql import functions as F

from assayloom import fixed_values as fixed
from assayloom.functions.text import clean_result, clean_unit, unit_key
from assayloom.operators import audits
from assayloom.sources import rule_tables

SHAPES = [
    (None, "missing"), ("", "missing"), ("   ", "missing"),
    ("None", "null_literal"), (" n/a ", "null_literal"), ("NA", "null_literal"),
    ("*0000", "not_reported_sentinel"), ("*000", "not_reported_sentinel"),
    ("x" * 81, "narrative_text"), ("x" * 80, "short_text"), ("5\n-\n6", "narrative_text"), ("line.br next", "narrative_text"),
    ("5", "plain_numeric"), ("1,234", "plain_numeric"), ("18%", "plain_numeric"), (".5", "plain_numeric"),
    ("1e3", "plain_numeric"), ("-2.5E-3", "plain_numeric"), ("1,234,567.5", "plain_numeric"), ("18 %", "plain_numeric"),
    ("<5", "operator_numeric"), (">= 100", "operator_numeric"), ("</=10", "operator_numeric"), ("> / = 3", "operator_numeric"),
    ("= .5", "operator_numeric"),
    ("0-1", "numeric_range"), ("2.5 – 3.5", "numeric_range"), ("-5 - 10", "numeric_range"), ("5--10", "numeric_range"),
    ("1+", "ordinal_plus"), ("3+", "ordinal_plus"), ("1+.", "ordinal_plus"),
    ("Over 20", "verbal_operator_numeric"), ("less than 5", "verbal_operator_numeric"),
    ("GREATER  THAN 1.5 %", "verbal_operator_numeric"),
    ("Positive", "qualifier_numeric"), ("Dimly Positive", "qualifier_numeric"), ("0.01 Negative", "qualifier_numeric"),
    ("Negative(ตรวจไม่พบเชื้อ)", "qualifier_numeric"), ("Dimly - Moderately Positive", "qualifier_numeric"),
    ("Positive 3+", "qualifier_ordinal"),
    ("Negative < 2", "qualifier_comparison"), ("< 10.0 Negative", "qualifier_comparison"),
    ("Centrifuged 10 ml. urine", "mixed_text_numeric"), ("1:80", "mixed_text_numeric"), ("1.2.3", "mixed_text_numeric"),
    ("1,2", "mixed_text_numeric"), ("Detected 5", "mixed_text_numeric"),
    ("Detected", "qualifier_detection"), ("Not Detected.", "qualifier_detection"), ("Strongly detected", "qualifier_detection"),
    ("non detectable", "qualifier_detection"), ("Detected (low)", "qualifier_detection"),
    ("Trace", "severity_grade"), ("Decreased", "severity_grade"), ("!few", "severity_grade"), ("Adequate,", "severity_grade"),
    ("Clear", "short_text"), ("Negative for JAK2 V617F Mutation", "short_text"), ("12a", "short_text"),
    ("Markedly decrease", "short_text"), ("teacee", "short_text"),
    ("-", "punctuation_or_junk"), ("**", "punctuation_or_junk"), ("...", "punctuation_or_junk"),
    ("๕", "plain_numeric"),
]


def test_shapes(judge):
    got = judge([(text, None, None) for text, _ in SHAPES])
    wrong = [(t, want, g["shape"]) for (t, want), g in zip(SHAPES, got) if g["shape"] != want]
    assert not wrong
    assert {want for _, want in SHAPES} == set(fixed.SHAPES)


def test_actions(judge):
    for (_, shape), row in zip(SHAPES, judge([(text, None, None) for text, _ in SHAPES])):
        want = "missing" if shape in fixed.MISSING_SHAPES else "review" if shape in fixed.REVIEW_SHAPES else "split"
        assert row["split_action"] == want


END_TO_END = [
    (("3.5", "mmol/L", "200106"), dict(shape="plain_numeric", number=3.5, unit="mmol/L", number_std=135.3275,
                                       unit_std="mg/dL", conversion_status="convert")),
    (("135", "mg/dL", "200106"), dict(shape="plain_numeric", number=135.0, unit="mg/dL", number_std=135.0,
                                      unit_std="mg/dL", conversion_status="not_registered")),
    (("0.5-1.5", "mmol/L", "200106"), dict(shape="numeric_range", range_low=0.5, range_high=1.5, unit="mmol/L",
                                           range_low_std=19.3325, range_high_std=57.9975, unit_std="mg/dL",
                                           conversion_status="convert")),
    (("< 5", "umol/L", "200058"), dict(shape="operator_numeric", operator="<", number=5.0, unit="umol/L",
                                       number_std=0.05656, unit_std="mg/dL", conversion_status="convert")),
    (("7.2", "K/ul", "250657"), dict(shape="plain_numeric", number=7.2, unit="10^3/uL", number_std=7.2,
                                     unit_std="10^3/uL", conversion_status="not_registered")),
    (("Weakly Positive", None, "100063"), dict(shape="qualifier_numeric", value="Positive", qualifier="Weakly")),
    (("Not Detected.", None, "400091"), dict(shape="qualifier_detection", value="Negative")),
    (("Trace", "/HPF", "150511"), dict(shape="severity_grade", unit="/HPF", qualifier="Trace", unit_std="/HPF")),
    (("Centrifuged 10 ml. urine", None, "150501"), dict(shape="mixed_text_numeric", split_action="review")),
    (("None", None, "L"), dict(shape="null_literal", split_action="missing")),
    (("*0000", "fL", "250510"), dict(shape="not_reported_sentinel", split_action="missing")),
    # negative bound, gloss, percent
    (("-5 - 10", None, None), dict(shape="numeric_range", range_low=-5.0, range_high=10.0, range_low_std=-5.0,
                                   range_high_std=10.0, conversion_status="not_registered")),
    (("Negative (not positive)", None, None), dict(shape="qualifier_numeric", value="Negative")),
    (("Negative (2 tests)", None, None), dict(shape="qualifier_numeric", value="Negative")),
    (("Detected (strongly)", None, None), dict(shape="qualifier_detection", value="Positive")),
    (("18%", "mg/dL", None), dict(shape="plain_numeric", split_action="review")),
    (("18%", "%", None), dict(shape="plain_numeric", number=18.0, unit="%", number_std=18.0, unit_std="%",
                              conversion_status="not_registered")),
    (("18 %", None, None), dict(shape="plain_numeric", number=18.0, unit="%", number_std=18.0, unit_std="%",
                                conversion_status="not_registered")),
    (("Positive 5%", "mg/dL", None), dict(shape="qualifier_numeric", split_action="review")),
    # operators
    (("</=10", None, None), dict(shape="operator_numeric", operator="<=", number=10.0, number_std=10.0,
                                 conversion_status="not_registered")),
    (("> / = 1,500", None, None), dict(shape="operator_numeric", operator=">=", number=1500.0, number_std=1500.0,
                                       conversion_status="not_registered")),
    (("Over 20", None, None), dict(shape="verbal_operator_numeric", operator=">", number=20.0, number_std=20.0,
                                   qualifier="Over", conversion_status="not_registered")),
    (("LESS  THAN .5 %", None, None), dict(shape="verbal_operator_numeric", operator="<", number=0.5, number_std=0.5,
                                           qualifier="Less Than", unit="%", unit_std="%",
                                           conversion_status="not_registered")),
    (("3+", "mg/dL", None), dict(shape="ordinal_plus", operator="+", number=3.0, number_std=3.0)),
    (("Positive 2+", "mg/dL", None), dict(shape="qualifier_ordinal", operator="+", number=2.0, number_std=2.0,
                                          value="Positive")),
    (("Negative <= 2.5", None, None), dict(shape="qualifier_comparison", operator="<=", number=2.5, number_std=2.5,
                                           value="Negative")),
    (("0.01 Negative", "mg/dL", None), dict(shape="qualifier_numeric", number=0.01, number_std=0.01, value="Negative")),
    (("Non Reactive", None, None), dict(shape="qualifier_numeric", value="Non-Reactive")),
    (("dimly -  moderately positve", None, None), dict(shape="qualifier_numeric", value="Positive",
                                                       qualifier="Dimly-Moderately")),
    (("borderli", None, None), dict(shape="qualifier_detection", value="Equivocal")),
    (("Weakly detectable.", None, None), dict(shape="qualifier_detection", value="Positive", qualifier="Weakly")),
    (("5.2", "mmol/L", "200047"), dict(shape="plain_numeric", number=5.2, unit="mmol/L", number_std=201.058,
                                       unit_std="mg/dL", conversion_status="convert")),
    (("9.0078", "mg/dl", "200098"), dict(shape="plain_numeric", number=9.0078, unit="mg/dL", number_std=1.0,
                                         unit_std="mmol/L", conversion_status="convert")),
    (("2", "pmol/L", "200127"), dict(shape="plain_numeric", number=2.0, unit="pmol/L", number_std=16.914,
                                     unit_std="pg/mL", conversion_status="convert")),
    (("1.5", "ng/mL", "200159"), dict(shape="plain_numeric", number=1.5, unit="ng/mL", number_std=1500.0,
                                      unit_std="ng/L", conversion_status="convert")),
    # Thai digits have the shape of a number, but are not one
    (("๕", None, None), dict(shape="plain_numeric", conversion_status="not_registered")),
]
COLUMNS = ("shape split_action operator number range_low range_high unit value qualifier number_std range_low_std "
           "range_high_std unit_std conversion_status").split()


def test_end_to_end(judge):
    got = judge([value for value, _ in END_TO_END])
    for (value, want), row in zip(END_TO_END, got):
        want = {"split_action": "split", **want}
        for column in COLUMNS:
            expected, actual = want.get(column), row[column]
            if isinstance(expected, float):
                expected = pytest.approx(expected, rel=1e-12)
            assert actual == expected, (value, column, actual, expected)


def test_every_listed_grade_has_its_label(judge):
    words = [(w.replace("d?", "d"), label) for alternatives, label in fixed.SEVERITY_GRADES for w in alternatives.split("|")]
    rows = judge([(w, None, None) for w, _ in words])
    assert [(r["shape"], r["qualifier"]) for r in rows] == [("severity_grade", label) for _, label in words]


def test_cleaning(spark):
    pairs = [
        (" 5 ", "5"), ("3.8.", "3.8"), ("1+.", "1+"), ("> 40000.", "> 40000"), ("5 ..", "5"), ("5%.", "5%"), ("!few", "few"),
        ("Adequate,", "Adequate"), ("TRACE'", "TRACE"), ("few.", "few"), ("[few", "few"), ("[few]", "[few]"),
        ("two words.", "two words."), ("a1.", "a1."), ("few1,", "few1,"), ("  x　", "x"), ("\t\n", ""),
        (None, None), ("...", "..."), ("5.a.", "5.a."),
    ]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "i int, raw string").coalesce(1)
    once = clean_result(F.col("raw"))
    got = df.select("i", once.alias("c"), clean_result(once).alias("again")).orderBy("i").collect()
    assert [r["c"] for r in got] == [want for _, want in pairs]
    assert [r["again"] for r in got] == [want for _, want in pairs]


def test_units(spark, judge):
    assert [r["unit"] for r in judge([("1", u, None) for u in ("MG / DL", "mg/dl", "mg%", " mg / dL1 ")])] == ["mg/dL"] * 4
    cases = [("๐", None), ("", None), ("  ", None), ("K/ul", "10^3/uL"), (r"x 10\S\3/cumm", "10^3/uL"), ("odd unit", "odd unit"),
             ("copies", "copies/mL"), ("nm", "nmol/L"), ("'C", "C")]
    assert [r["unit"] for r in judge([("1", u, None) for u, _ in cases])] == [want for _, want in cases]
    df = spark.createDataFrame([(" UG / 24 hr ",)], "u string")
    assert df.select(clean_unit(F.col("u")), unit_key(F.col("u"))).first()[:] == ("UG / 24 hr", "ug/24hr")


def test_shipped_rule_tables_are_sound(spark):
    synonyms, conversions = rule_tables.synonym_table(spark), rule_tables.conversion_table(spark)
    audits.refuse(audits.synonym_problems(synonyms), "synonyms")
    audits.refuse(audits.conversion_problems(conversions, synonyms), "conversions")
    assert audits.spelling_clashes(conversions, synonyms).count() == 0
    assert (synonyms.count(), conversions.count()) == (41, 94)
