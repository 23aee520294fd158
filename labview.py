"""Lab rows over the test tables; the text runs in Spark SQL and in DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from assayloom import fixed_values as fixed

LAB_VIEW = r"""
SELECT
  concat('lab_', year(l_shipdate)) AS file,
  l_orderkey AS OBS_ID,
  l_linenumber AS LINE_NO,
  CASE WHEN l_orderkey % 20 = 0 AND l_partkey % 2 = 0 THEN 'MB001'
       WHEN l_partkey % 11 = 0 THEN '200106' WHEN l_partkey % 11 = 1 THEN '200047'
       WHEN l_partkey % 11 = 2 THEN '200058' WHEN l_partkey % 11 = 3 THEN '250657'
       WHEN l_partkey % 11 = 4 THEN '100063' WHEN l_partkey % 11 = 5 THEN '400091'
       WHEN l_partkey % 11 = 6 THEN '150511' WHEN l_partkey % 11 = 7 THEN '200098'
       WHEN l_partkey % 11 = 8 THEN '200159' WHEN l_partkey % 11 = 9 THEN '200127'
       ELSE NULL END AS CODE_TEST,
  CASE WHEN l_suppkey % 3 = 0 THEN concat('Test ', l_partkey % 11)
       WHEN l_suppkey % 3 = 1 THEN concat('  Assay ', l_partkey % 11, ' ')
       ELSE NULL END AS SHORT_TEST,
  CASE (l_orderkey + l_linenumber * 7 + l_suppkey * 3) % 44
    WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' None ' WHEN 3 THEN 'n/a' WHEN 4 THEN '*000'
    WHEN 5 THEN concat(' ', CAST(l_quantity AS INT), '.', l_linenumber, ' ')
    WHEN 6 THEN concat('1,', 100 + l_linenumber) WHEN 7 THEN concat(CAST(l_quantity AS INT), '%')
    WHEN 8 THEN concat('.', l_linenumber) WHEN 9 THEN concat('< ', CAST(l_quantity AS INT))
    WHEN 10 THEN concat('</=', CAST(l_quantity AS INT)) WHEN 11 THEN concat('> / = ', l_linenumber)
    WHEN 12 THEN concat(l_linenumber, ' - ', 10 + l_linenumber) WHEN 13 THEN concat('-', l_linenumber, ' - 10')
    WHEN 14 THEN concat(l_linenumber, '+') WHEN 15 THEN concat('Over ', CAST(l_quantity AS INT))
    WHEN 16 THEN concat('less than ', l_linenumber) WHEN 17 THEN 'Positive' WHEN 18 THEN 'NEGATIVE'
    WHEN 19 THEN 'Weakly Positive' WHEN 20 THEN 'Dimly - Moderately Positive' WHEN 21 THEN 'non-reactive'
    WHEN 22 THEN concat('Positive ', l_linenumber, '+') WHEN 23 THEN concat('Negative < ', l_linenumber)
    WHEN 24 THEN concat('< ', l_linenumber, '.0 Negative') WHEN 25 THEN '0.01 Negative'
    WHEN 26 THEN 'Not Detected.' WHEN 27 THEN 'Strongly detected' WHEN 28 THEN 'Trace'
    WHEN 29 THEN '!few' WHEN 30 THEN 'Adequate,' WHEN 31 THEN 'Centrifuged 10 ml. urine'
    WHEN 32 THEN concat('1:', 80 * l_linenumber) WHEN 33 THEN 'Clear' WHEN 34 THEN 'JAK2'
    WHEN 35 THEN 'teacee' WHEN 36 THEN 'Male' WHEN 37 THEN '**' WHEN 38 THEN concat(CAST(l_quantity AS INT), '.8.')
    WHEN 39 THEN 'No growth'
    WHEN 40 THEN 'Specimen received after the cut-off time and rejected by the laboratory, please collect again'
    WHEN 41 THEN 'Negative (not positive)' WHEN 42 THEN 'borderline' ELSE concat(CAST(l_quantity AS INT), 'e-1') END AS RESULT_VAL,
  CASE (l_suppkey + l_linenumber) % 10
    WHEN 0 THEN 'mmol/L' WHEN 1 THEN 'MG / DL' WHEN 2 THEN 'mg/dl'
    WHEN 3 THEN CASE l_partkey % 11 WHEN 8 THEN 'ng/mL' WHEN 9 THEN 'pmol/L' ELSE 'K/ul' END WHEN 4 THEN NULL
    WHEN 5 THEN '' WHEN 6 THEN '%' WHEN 7 THEN 'umol/L' WHEN 8 THEN 'mg%' ELSE ' mmol/l ' END AS UNIT
FROM lineitem
"""


COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"]


def spellings(pattern: str) -> list[str]:
    """Texts that a word pattern matches: every alternative, with and without its optional parts."""
    pattern = re.sub(r"\\s[+*]", " ", pattern).replace(r"[-\s]?", "-?")
    inner = re.search(r"\(\?:([^()]*)\)(\??)|([\w-])\?", pattern)
    if inner is None:
        return pattern.split("|")
    if "|" in pattern[: inner.start()]:
        head, rest = pattern.split("|", 1)
        return [*spellings(head), *spellings(rest)]
    parts = inner[1].split("|") if inner[1] is not None else [inner[3]]
    if inner[2] or inner[3]:
        parts = [*parts, ""]
    return [text for part in parts for text in spellings(pattern[: inner.start()] + part + pattern[inner.end() :])]


def _wide_texts() -> list[str]:
    """Results that reach every row of the word tables, and every sign."""
    first = [spellings(row[0])[0] for row in fixed.QUALIFIER_VALUES]
    verbal = [f"{text} {n}" for n, row in enumerate(fixed.VERBAL_OPERATORS, 3) for text in spellings(row[0])]
    values = [text for row in fixed.QUALIFIER_VALUES for text in spellings(row[0])]
    modifiers = [text for row in fixed.MODIFIER_RANGES + fixed.MODIFIERS for text in spellings(row[0])]
    modified = [f"{text} {first[i % len(first)]}" for i, text in enumerate(modifiers)]
    found = [text for row in fixed.DETECTION_VALUES for text in spellings(row[0])]
    detected = [f"{text} {found[i % len(found)]}" for i, text in enumerate(spellings("|".join(row[0] for row in fixed.MODIFIERS)))]
    grades = [text for row in fixed.SEVERITY_GRADES for text in spellings(row[0])]
    signs = ["= 5", "=0.5 %", "= 1,234", "Positive = 3", "= 4 Negative", "<=7", ">= 2.50", "< / = 9", "12.", "1+.", "3\u20134", "\u0e55", "\u0e55.\u0e51 %"]
    numbers = [f"{n}.{n % 10}" for n in range(1, 300)]
    return [*signs, *verbal, *values, *modified, *found, *detected, *grades, *numbers]


def _sql_text(value: str) -> str:
    """A literal that Spark and DuckDB read alike."""
    parts = ["'" + part.replace("'", "\' || chr(39) || \'") + "'" for part in value.split("\\")]
    return " || chr(92) || ".join(parts)


def _sql_table(rows: list[tuple[str, ...]]) -> str:
    return ", ".join(f"({i}, {', '.join(map(_sql_text, row))})" for i, row in enumerate(rows))


_TEXTS = [(text,) for text in _wide_texts()]
_PAIRS = [(row[0], row[1]) for row in fixed.UNIT_CONVERSIONS]
_UNITS = [(row[0],) for row in fixed.UNIT_SYNONYMS]

#: A second view with every row of the word tables, of the conversions and of the unit spellings.
WIDE_VIEW = f"""
SELECT
  concat('wide_', year(l_shipdate)) AS file,
  l_orderkey AS OBS_ID,
  l_linenumber AS LINE_NO,
  CASE WHEN l_orderkey % 20 = 0 AND l_partkey % 2 = 0 THEN 'MB001' ELSE pair_code END AS CODE_TEST,
  CASE WHEN l_suppkey % 3 = 0 THEN concat('Test ', l_partkey % 11) ELSE NULL END AS SHORT_TEST,
  result_text AS RESULT_VAL,
  CASE WHEN l_suppkey % 4 = 0 THEN other_unit ELSE pair_unit END AS UNIT
FROM lineitem
  JOIN (VALUES {_sql_table(_TEXTS)}) AS texts(text_no, result_text) ON (l_orderkey * 31 + l_partkey * 7 + l_linenumber) % {len(_TEXTS)} = text_no
  JOIN (VALUES {_sql_table(_PAIRS)}) AS pairs(pair_no, pair_code, pair_unit) ON (l_partkey + l_suppkey * 13) % {len(_PAIRS)} = pair_no
  JOIN (VALUES {_sql_table(_UNITS)}) AS units(unit_no, other_unit) ON (l_partkey * 3 + l_linenumber) % {len(_UNITS)} = unit_no
"""


def lab_rows(spark: SparkSession, sf_dir: str, view: str = LAB_VIEW) -> DataFrame:
    """The view over ``lineitem``.  A scan with fewer splits than cores is spread over the cores first."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*COLUMNS)
    cores = spark.sparkContext.defaultParallelism
    if lineitem.rdd.getNumPartitions() < cores:
        lineitem = lineitem.repartition(cores, "l_orderkey", "l_partkey", "l_linenumber")
    return spark.sql(view.replace("FROM lineitem", "FROM {lineitem}"), lineitem=lineitem)
