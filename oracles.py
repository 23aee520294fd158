"""DuckDB SQL for each registered query, written without the Spark code.

Only the fixed values (word tables, spellings, factors) are shared.  All
statements start from the lab view over ``lineitem``.
"""

from __future__ import annotations

from assayloom import fixed_values as fixed
from labview import LAB_VIEW, WIDE_VIEW

SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def text(value) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def double(value) -> str:
    return "NULL::DOUBLE" if value is None else f"'{value!r}'::DOUBLE"


def pattern_text(pattern: str) -> str:
    """A pattern as text; digits of any script, as the rules want them."""
    return text(pattern.replace(r"\d", r"\p{Nd}"))


def has(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {pattern_text(pattern)})"


def one(column: str, pattern: str, group: int = 0) -> str:
    return f"nullif(regexp_extract({column}, {pattern_text(pattern)}, {group}), '')"


def words(table) -> str:
    return "|".join(row[0] for row in table)


def label_case(column: str, pairs, form: str = "{}") -> str:
    whens = " ".join(f"WHEN {has(column, form.format(p))} THEN {text(label)}" for p, label in pairs)
    return f"CASE {whens} END"


def in_list(names) -> str:
    return "(" + ", ".join(text(n) for n in names) + ")"


SIMPLE = fixed.NUMBER_SIMPLE
NUMBER = f"(?:{fixed.NUMBER_CORE}|{fixed.NUMBER_LEADING_DOT})"
TOKENS = "|".join(fixed.OPERATOR_TOKENS)
COMPARE = "(?:<=|>=|<|>|=)"
QUALITY = f"(?:{words(fixed.QUALIFIER_VALUES)})"
MODIFIER = f"(?:{words(fixed.MODIFIERS)})"
ANY_MODIFIER = f"(?:{words(fixed.MODIFIER_RANGES)}|{words(fixed.MODIFIERS)})"
VERBAL = f"(?:{words(fixed.VERBAL_OPERATORS)})"
GLOSS = f"(?:{fixed.GLOSS})?"
MARKS = r"""[!.,'"\\\[\]]+"""


def clean(column: str) -> str:
    out = f"trim({column}::VARCHAR, {text(SPACE)})"
    for pattern in (fixed.NUMERIC_TRAILING_DOT, rf"^{MARKS}(\p{{L}}+)$", rf"^(\p{{L}}+){MARKS}$"):
        out = f"regexp_replace({out}, {pattern_text(pattern)}, '\\1')"
    return out


def key(column: str) -> str:
    return rf"lower(regexp_replace({column}, '\s+', '', 'g'))"


def shape_case(v: str) -> str:
    tests = [
        (f"{v} IS NULL OR {v} = ''", "missing"),
        (has(v, r"(?i)^\s*(?:none|n/?a)\s*$"), "null_literal"),
        (has(v, r"^\s*\*+0+\s*$"), "not_reported_sentinel"),
        (f"{has(v, fixed.LINE_BREAK)} OR length({v}) > {fixed.NARRATIVE_LENGTH}", "narrative_text"),
        (has(v, rf"^{NUMBER}\s*%?$"), "plain_numeric"),
        (has(v, rf"^(?:{TOKENS})\s*{NUMBER}\s*%?$"), "operator_numeric"),
        (has(v, rf"^{SIMPLE}\s*{fixed.RANGE_SEPARATOR}\s*{SIMPLE}\s*%?$"), "numeric_range"),
        (has(v, r"^\s*\d+\+\s*$"), "ordinal_plus"),
        (has(v, rf"(?i)^\s*{VERBAL}\s+{SIMPLE}\s*%?\s*$"), "verbal_operator_numeric"),
        (has(v, rf"(?i)^\s*(?:{SIMPLE}\s*%?\s*)?(?:{ANY_MODIFIER}\s+)?{QUALITY}{GLOSS}(?:\s*{SIMPLE}\s*%?)?\s*$"),
         "qualifier_numeric"),
        (has(v, rf"(?i)^\s*{QUALITY}\s+\d+\+\s*$"), "qualifier_ordinal"),
        (has(v, rf"(?i)^\s*{QUALITY}\s*{COMPARE}\s*{SIMPLE}\s*%?\s*$") + " OR "
         + has(v, rf"(?i)^\s*{COMPARE}\s*{SIMPLE}\s*%?\s*{QUALITY}\s*$"), "qualifier_comparison"),
        (has(v, fixed.STANDALONE_NUMBER), "mixed_text_numeric"),
        (has(v, rf"(?i)^\s*(?:{MODIFIER}\s+)?(?:{words(fixed.DETECTION_VALUES)}){GLOSS}\.?\s*$"),
         "qualifier_detection"),
        (has(v, rf"(?i)^\s*(?:{words(fixed.SEVERITY_GRADES)})\s*$"), "severity_grade"),
        (has(v, r"\p{L}"), "short_text"),
    ]
    whens = "\n".join(f"    WHEN {test} THEN '{label}'" for test, label in tests)
    return f"CASE\n{whens}\n    ELSE 'punctuation_or_junk' END"


SYNONYMS = ", ".join(f"({text(a)}, {text(b)}, {i})" for i, (a, b) in enumerate(fixed.UNIT_SYNONYMS))
REGISTRY = ", ".join(
    f"({text(c)}, {text(s)}, {text(t)}, {text(m)}, {double(f)}, {double(mm)}, {i})"
    for i, (c, s, t, m, f, mm) in enumerate(fixed.UNIT_CONVERSIONS)
)

ACTION = f"""CASE WHEN shape IN {in_list(fixed.MISSING_SHAPES)} THEN 'missing'
    WHEN shape IN {in_list(fixed.REVIEW_SHAPES)} THEN 'review'
    WHEN result LIKE '%\\%' ESCAPE '\\' AND canonical IS NOT NULL AND canonical <> '%' THEN 'review'
    ELSE 'split' END"""

PLAIN = rf"lower(regexp_replace(result, '\s*\([^)]+\)', '', 'g'))"
DETECTION = [(rf"^(?:{MODIFIER}\s+)?(?:{w})\.?$", label) for w, label in fixed.DETECTION_VALUES]
MEASURED = (
    rf"try_cast(regexp_replace(replace(regexp_replace(regexp_replace(result, {text('^(?:' + TOKENS + ')')}, ''), "
    rf"{text('(?i)^' + VERBAL)}, ''), ',', ''), '\s*%$', '') AS DOUBLE)"
)
RANGE = rf"^({SIMPLE})\s*{fixed.RANGE_SEPARATOR}\s*({SIMPLE})"

CTES = {
    "lab": ((), LAB_VIEW),
    "cleaned": (("lab",), f"""SELECT file, OBS_ID, LINE_NO, RESULT_VAL AS result_raw, UNIT AS unit_raw, CODE_TEST AS code,
  trim(SHORT_TEST, {text(SPACE)}) AS name, {clean('RESULT_VAL')} AS result,
  nullif(trim(UNIT, {text(SPACE)}), '') AS unit_recorded FROM lab"""),
    "linked": (("cleaned",), "SELECT DISTINCT OBS_ID FROM cleaned WHERE code LIKE 'MB%' AND OBS_ID IS NOT NULL"),
    "scoped": (("cleaned", "linked"), """SELECT c.*, CASE WHEN c.code LIKE 'MB%' THEN 'prefix'
  WHEN l.OBS_ID IS NOT NULL THEN 'link' END AS excluded_by FROM cleaned c LEFT JOIN linked l ON c.OBS_ID = l.OBS_ID"""),
    "vals": (("scoped",), """SELECT file, result, unit_recorded, code, name, count(*) AS n_rows FROM scoped
  WHERE excluded_by IS NULL GROUP BY ALL"""),
    "synonyms(unit_as_recorded, unit_to_use, pos)": ((), f"VALUES {SYNONYMS}"),
    "registry(code, unit_source, unit_target, method, factor, molar_mass, pos)": ((), f"VALUES {REGISTRY}"),
    "spellings": (("synonyms", "registry"), f"""SELECT unit_key, arg_min(spelling, ord) AS spelling FROM (
    SELECT {key('unit_as_recorded')} AS unit_key, unit_to_use AS spelling, pos AS ord FROM synonyms
    UNION ALL SELECT {key('unit_to_use')}, unit_to_use, 1000 + pos FROM synonyms WHERE unit_to_use <> ''
    UNION ALL SELECT {key('unit_source')}, unit_source, 2000 + pos FROM registry
    UNION ALL SELECT {key('unit_target')}, unit_target, 3000 + pos FROM registry) GROUP BY unit_key"""),
    "canon": (("vals", "spellings"), f"""SELECT v.*, nullif(coalesce(s.spelling, v.unit_recorded), '') AS canonical
  FROM vals v LEFT JOIN spellings s ON s.unit_key = {key('v.unit_recorded')}"""),
    "shaped": (("canon",), f"SELECT *, {shape_case('result')} AS shape, {PLAIN} AS plain FROM canon"),
    "acted": (("shaped",), f"SELECT *, {ACTION} AS split_action FROM shaped"),
    "typed": (("acted",), rf"""SELECT file, result, unit_recorded, code, name, n_rows, canonical, shape, split_action,
  CASE WHEN split_action <> 'split' THEN NULL
    WHEN shape = 'operator_numeric' THEN regexp_replace({one('result', f'^(?:{TOKENS})')}, '\s*/\s*', '')
    WHEN shape = 'verbal_operator_numeric' THEN {label_case('plain', [(w, o) for w, o, _ in fixed.VERBAL_OPERATORS], r'\b(?:{})\b')}
    WHEN shape IN ('ordinal_plus', 'qualifier_ordinal') THEN '+'
    WHEN shape = 'qualifier_comparison' THEN {one('result', '<=|>=|<|>|=')} END AS operator,
  CASE WHEN split_action <> 'split' THEN NULL
    WHEN shape IN ('plain_numeric', 'operator_numeric', 'verbal_operator_numeric') THEN {MEASURED}
    WHEN shape IN ('ordinal_plus', 'qualifier_ordinal') THEN try_cast({one('result', r'(\d+)\+', 1)} AS DOUBLE)
    WHEN shape IN ('qualifier_numeric', 'qualifier_comparison') THEN try_cast({one('plain', SIMPLE)} AS DOUBLE)
    END AS number,
  CASE WHEN split_action = 'split' AND shape = 'numeric_range' THEN try_cast({one('result', RANGE, 1)} AS DOUBLE) END AS range_low,
  CASE WHEN split_action = 'split' AND shape = 'numeric_range' THEN try_cast({one('result', RANGE, 2)} AS DOUBLE) END AS range_high,
  CASE WHEN split_action <> 'split' OR shape IN {in_list(fixed.QUALITATIVE_SHAPES + ['ordinal_plus'])} THEN NULL
    WHEN result LIKE '%\%' ESCAPE '\' THEN '%' ELSE canonical END AS unit,
  CASE WHEN split_action <> 'split' THEN NULL
    WHEN shape = 'qualifier_detection' THEN {label_case('plain', DETECTION)}
    WHEN shape IN {in_list(fixed.QUALITATIVE_SHAPES)} THEN {label_case('plain', fixed.QUALIFIER_VALUES)} END AS value,
  CASE WHEN split_action <> 'split' THEN NULL
    WHEN shape = 'severity_grade' THEN {label_case('plain', fixed.SEVERITY_GRADES, '^(?:{})$')}
    WHEN shape IN ('qualifier_numeric', 'qualifier_detection')
      THEN {label_case('plain', fixed.MODIFIER_RANGES + fixed.MODIFIERS, r'\b(?:{})\b')}
    WHEN shape = 'verbal_operator_numeric' THEN {label_case('plain', [(w, x) for w, _, x in fixed.VERBAL_OPERATORS], r'\b(?:{})\b')}
    END AS qualifier
FROM acted"""),
    "factors": (("registry",), """SELECT code, unit_source, unit_target, CASE method WHEN '1' THEN factor WHEN '9' THEN factor
  WHEN '4' THEN factor * molar_mass WHEN '5' THEN factor / molar_mass ELSE 1.0::DOUBLE END AS m FROM registry"""),
    "std": (("typed", "factors"), f"""SELECT t.*, f.m, f.unit_target,
  t.shape IN {in_list(fixed.NUMERIC_SHAPES)} AND t.split_action = 'split' AS is_num, f.code IS NOT NULL AS reg
  FROM typed t LEFT JOIN factors f ON t.code = f.code AND t.unit = f.unit_source"""),
    "decided": (("std",), """SELECT file, result, unit_recorded, code, name, n_rows, shape, split_action, operator, number,
  range_low, range_high, unit, value, qualifier,
  CASE WHEN is_num AND reg THEN number * m ELSE number END AS number_std,
  CASE WHEN is_num AND reg THEN range_low * m ELSE range_low END AS range_low_std,
  CASE WHEN is_num AND reg THEN range_high * m ELSE range_high END AS range_high_std,
  CASE WHEN is_num AND reg THEN unit_target ELSE unit END AS unit_std,
  CASE WHEN is_num AND reg THEN 'convert' WHEN is_num THEN 'not_registered' END AS conversion_status FROM std"""),
    "num": (("decided",), "SELECT * FROM decided WHERE conversion_status IS NOT NULL"),
    "totals": (("scoped",), """SELECT file, count(*) AS total_rows, count(excluded_by) AS excluded_rows,
  count(*) FILTER (excluded_by = 'link') AS excluded_linked_rows FROM scoped GROUP BY file"""),
    "sums": (("decided",), f"""SELECT file, sum(n_rows)::BIGINT AS in_scope_rows,
  {', '.join(f"coalesce(sum(n_rows) FILTER (split_action = '{a}'), 0)::BIGINT AS {a}_rows" for a in ('split', 'missing', 'review'))},
  count(*) AS distinct_values,
  count(DISTINCT coalesce(code, '<none>')) FILTER (split_action = 'review') AS codes_in_review,
  coalesce(sum(n_rows) FILTER (split_action = 'split' AND number IS NULL AND value IS NULL AND range_low IS NULL
    AND qualifier IS NULL), 0)::BIGINT AS parse_failures,
  {', '.join(f"coalesce(sum(n_rows) FILTER (shape = '{s}'), 0)::BIGINT AS n_{s}" for s in fixed.SHAPES)}
  FROM decided GROUP BY file"""),
    "shares": (("totals", "sums"), f"""SELECT t.file, total_rows, excluded_rows, excluded_linked_rows,
  {', '.join(f"round(100.0::DOUBLE * {a}_rows / total_rows, 2) AS {a}_pct" for a in ('split', 'missing', 'review'))},
  codes_in_review, parse_failures, total_rows AS rows_written, TRUE AS row_count_match,
  {', '.join(f"round(100.0::DOUBLE * n_{s} / total_rows, 3) AS shape_{s}_pct" for s in fixed.SHAPES)}
  FROM totals t JOIN sums s ON t.file = s.file"""),
    "multi": (("num",), """SELECT code, count(DISTINCT unit) AS n_units FROM num WHERE unit IS NOT NULL
  GROUP BY code HAVING count(DISTINCT unit) > 1"""),
}


def with_ctes(*names: str, view: str = LAB_VIEW) -> str:
    """WITH clause of the named tables and all they need, in the order of the list above."""
    by_name = {full.split("(")[0]: full for full in CTES}
    wanted, queue = set(), list(names)
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue += CTES[by_name[name]][0]
    bodies = {full: body for full, (_, body) in CTES.items()} | {"lab": view}
    parts = [f"{full} AS ({body})" for full, body in bodies.items() if full.split("(")[0] in wanted]
    return "WITH " + ",\n".join(parts) + "\n"


NEW = ("shape, split_action, operator, number, range_low, range_high, unit, value, qualifier, "
       "number_std, range_low_std, range_high_std, unit_std, conversion_status")
NAMES = "coalesce(string_agg(DISTINCT nullif(name, ''), ' | ' ORDER BY nullif(name, '')), '')"
FILES = "count(DISTINCT file) AS n_files, string_agg(DISTINCT file, '; ' ORDER BY file) AS files"


def joined(column: str) -> str:
    return f"coalesce(string_agg(DISTINCT {column}, ' | ' ORDER BY {column}), '')"


def by_shape(columns: str, shapes) -> str:
    return with_ctes("decided") + (
        f"SELECT result, unit_recorded, shape, split_action, {columns}, sum(n_rows)::BIGINT AS n_rows FROM decided "
        f"WHERE shape IN {in_list(shapes)} GROUP BY ALL"
    )


def oracle_sql() -> dict[str, str]:
    d = with_ctes("decided")
    return {
        "lab_scan": with_ctes("scoped")
        + "SELECT file, OBS_ID, LINE_NO, result, unit_recorded, code, name, excluded_by FROM scoped",
        "normalize_result": with_ctes("cleaned") + "SELECT file, OBS_ID, LINE_NO, result_raw, result FROM cleaned",
        "normalize_unit": with_ctes("cleaned") + "SELECT file, OBS_ID, LINE_NO, unit_raw, unit_recorded FROM cleaned",
        "unit_key": with_ctes("cleaned")
        + f"SELECT unit_recorded, {key('unit_recorded')} AS unit_key, count(*) AS n_rows FROM cleaned GROUP BY ALL",
        "scope_by_prefix": with_ctes("cleaned")
        + "SELECT file, OBS_ID, LINE_NO, code, coalesce(code LIKE 'MB%', FALSE) AS excluded FROM cleaned",
        "linked_orders": with_ctes("linked") + "SELECT OBS_ID::VARCHAR AS link FROM linked",
        "scope_by_link": with_ctes("scoped")
        + "SELECT file, OBS_ID, LINE_NO, code, excluded_by FROM scoped WHERE excluded_by IS NOT NULL",
        "scope_by_link_shuffled": with_ctes("scoped")
        + "SELECT file, OBS_ID, LINE_NO, code, excluded_by FROM scoped WHERE excluded_by IS NOT NULL",
        "scope_by_link_filtered": with_ctes("scoped")
        + "SELECT file, OBS_ID, LINE_NO, code, excluded_by FROM scoped WHERE excluded_by IS NOT NULL",
        "excluded_counts": with_ctes("totals") + "SELECT file, excluded_rows, excluded_linked_rows FROM totals",
        "distinct_values": with_ctes("vals") + "SELECT * FROM vals",
        "shape_classify": d + "SELECT result, shape, sum(n_rows)::BIGINT AS n_rows FROM decided GROUP BY ALL",
        "split_action": d
        + "SELECT result, unit_recorded, shape, split_action, sum(n_rows)::BIGINT AS n_rows FROM decided GROUP BY ALL",
        "percent_guard": with_ctes("acted")
        + "SELECT result, unit_recorded, canonical, shape, split_action, sum(n_rows)::BIGINT AS n_rows FROM acted "
          "WHERE suffix(result, '%') GROUP BY ALL",
        "label_qualifier": with_ctes("shaped")
        + f"SELECT result, {label_case('plain', fixed.QUALIFIER_VALUES)} AS value_label, "
          f"{label_case('plain', fixed.MODIFIER_RANGES + fixed.MODIFIERS, chr(92) + 'b(?:{})' + chr(92) + 'b')} "
          "AS modifier_label, sum(n_rows)::BIGINT AS n_rows FROM shaped GROUP BY ALL",
        "typed_operator": by_shape("operator", ["operator_numeric"]),
        "typed_verbal": by_shape("operator, number, qualifier", ["verbal_operator_numeric"]),
        "typed_ordinal": by_shape("operator, number", fixed.ORDINAL_SHAPES),
        "typed_comparison": by_shape("operator, number, value", ["qualifier_comparison"]),
        "typed_number": by_shape("number", ["plain_numeric", "operator_numeric", "verbal_operator_numeric"]),
        "typed_range": by_shape("range_low, range_high", ["numeric_range"]),
        "typed_qualifier": by_shape("number, value, qualifier", ["qualifier_numeric", "qualifier_detection"]),
        "typed_value": by_shape("value", fixed.QUALITATIVE_SHAPES),
        "typed_severity": by_shape("qualifier", ["severity_grade"]),
        "typed_unit": by_shape("unit", fixed.SHAPES),
        "canonical_unit": with_ctes("canon")
        + "SELECT unit_recorded, canonical AS unit, sum(n_rows)::BIGINT AS n_rows FROM canon GROUP BY ALL",
        "unit_synonym_dim": with_ctes("synonyms", "cleaned")
        + f"SELECT unit_as_recorded, unit_to_use, count(c.unit_recorded) AS n_rows FROM synonyms s LEFT JOIN cleaned c "
          f"ON {key('c.unit_recorded')} = {key('s.unit_as_recorded')} GROUP BY ALL",
        "known_spellings": with_ctes("spellings", "cleaned")
        + f"SELECT s.unit_key, s.spelling, count(c.unit_recorded) AS n_rows FROM spellings s LEFT JOIN cleaned c "
          f"ON {key('c.unit_recorded')} = s.unit_key GROUP BY ALL",
        "conversion_dim": with_ctes("registry", "num")
        + "SELECT r.code, r.unit_source, r.unit_target, r.method, r.factor, r.molar_mass, "
          "coalesce(sum(n.n_rows), 0)::BIGINT AS n_rows FROM registry r LEFT JOIN num n "
          "ON r.code = n.code AND r.unit_source = n.unit GROUP BY ALL",
        "conversion_methods": """SELECT l_orderkey, l_partkey, l_linenumber, method, l_extendedprice AS number,
  l_extendedprice * CASE method WHEN '4' THEN l_discount * l_quantity WHEN '5' THEN l_discount / l_quantity
    WHEN '0' THEN 1.0::DOUBLE ELSE l_discount END AS number_std
FROM (SELECT *, CASE l_linenumber % 5 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '4' WHEN 3 THEN '5' ELSE '9' END AS method
  FROM lineitem)""",
        "convert_units": with_ctes("num")
        + "SELECT code, result, unit, number, range_low, range_high, number_std, range_low_std, range_high_std, unit_std, "
          "conversion_status, sum(n_rows)::BIGINT AS n_rows FROM num GROUP BY ALL",
        "decisions": d + f"SELECT file, result, unit_recorded, code, name, n_rows, {NEW} FROM decided",
        "harmonized_rows": harmonized_sql(),
        "harmonized_in_place": harmonized_sql(),
        "action_counts": d + "SELECT file, split_action, sum(n_rows)::BIGINT AS n_rows FROM decided GROUP BY ALL",
        "shape_counts": d + "SELECT file, shape, sum(n_rows)::BIGINT AS n_rows FROM decided GROUP BY ALL",
        "excluded_label": with_ctes("scoped", "decided")
        + "SELECT file, 'microbiology' AS shape, count(*) AS n_rows FROM scoped WHERE excluded_by IS NOT NULL GROUP BY file "
          "UNION ALL SELECT file, shape, sum(n_rows)::BIGINT FROM decided GROUP BY ALL",
        "parse_failures": with_ctes("sums") + "SELECT file, parse_failures FROM sums",
        "file_summary": with_ctes("totals", "sums")
        + "SELECT t.file, total_rows, excluded_rows, excluded_linked_rows, in_scope_rows, split_rows, missing_rows, "
          "review_rows, distinct_values, codes_in_review, parse_failures FROM totals t JOIN sums s ON t.file = s.file",
        "conversion_status_counts": with_ctes("num")
        + "SELECT file, conversion_status, sum(n_rows)::BIGINT AS n_rows FROM num GROUP BY ALL",
        "distribution_comparison": with_ctes("shares") + "SELECT * FROM shares",
        "review_spread": with_ctes("shares")
        + "SELECT min(review_pct) AS min_review_pct, max(review_pct) AS max_review_pct, "
          "round(max(review_pct) - min(review_pct), 2) AS spread FROM shares",
        "row_count_check": with_ctes("totals")
        + "SELECT file, total_rows, total_rows AS rows_written, TRUE AS row_count_match FROM totals",
        "review_top": d
        + f"SELECT file, result, unit_recorded, code, name, n_rows, {NEW} FROM decided WHERE split_action = 'review' "
          "QUALIFY row_number() OVER (PARTITION BY file ORDER BY n_rows DESC, result NULLS FIRST, "
          f"unit_recorded NULLS FIRST, code NULLS FIRST, name NULLS FIRST) <= {fixed.REVIEW_TOP_N}",
        "near_miss": with_ctes("decided") + near_miss_sql(),
        "near_miss_indexed": with_ctes("decided") + near_miss_sql(),
        "unit_pairs": with_ctes("num")
        + f"SELECT file, code, unit, conversion_status, sum(n_rows)::BIGINT AS n_rows, {NAMES} AS test_names "
          "FROM num GROUP BY file, code, unit, conversion_status",
        "conversions_used": with_ctes("num")
        + f"SELECT file, code, unit AS unit_source, unit_std AS unit_target, sum(n_rows)::BIGINT AS n_rows, "
          f"{NAMES} AS test_names FROM num WHERE conversion_status = 'convert' GROUP BY file, code, unit, unit_std",
        "unregistered_per_file": with_ctes("num")
        + "SELECT file, count(*) AS pairs, count(*) FILTER (s = 'not_registered') AS unregistered_pairs, "
          "coalesce(sum(n) FILTER (s = 'not_registered'), 0)::BIGINT AS unregistered_rows FROM (SELECT file, code, unit, "
          "conversion_status AS s, sum(n_rows) AS n FROM num GROUP BY ALL) GROUP BY file",
        "multi_unit_codes": with_ctes("multi") + "SELECT code, n_units FROM multi",
        "units_not_registered": with_ctes("multi", "registry", "num")
        + f"SELECT code, coalesce(unit, '<blank>') AS unit, {NAMES} AS test_names, sum(n_rows)::BIGINT AS n_rows, {FILES} "
          "FROM num WHERE conversion_status = 'not_registered' AND code IN (SELECT code FROM multi) "
          "AND NOT EXISTS (SELECT 1 FROM registry r WHERE r.code = num.code AND r.unit_target = num.unit) "
          "GROUP BY num.code, num.unit",
        "conversions_applied": with_ctes("num")
        + f"SELECT code, unit AS unit_source, unit_std AS unit_target, {NAMES} AS test_names, "
          f"sum(n_rows)::BIGINT AS n_rows, {FILES} FROM num WHERE conversion_status = 'convert' "
          "GROUP BY code, unit, unit_std",
        "code_dictionary": d
        + f"SELECT code, {NAMES} AS test_names, {joined('unit_recorded')} AS units_recorded, "
          f"{joined('unit')} AS units_used, sum(n_rows)::BIGINT AS n_rows, count(DISTINCT file) AS n_files "
          "FROM decided GROUP BY code",
        "audit_synonyms": with_ctes("cleaned")
        + f"SELECT {key('unit_recorded')} AS unit_key, count(DISTINCT unit_recorded) AS n_targets, "
          "min(unit_recorded) AS first_target, max(unit_recorded) AS last_target FROM cleaned "
          "WHERE unit_recorded IS NOT NULL GROUP BY 1 HAVING count(DISTINCT unit_recorded) > 1",
        "code_dictionary_long": d + "SELECT code, cell, text, sum(n_rows)::BIGINT AS n_rows FROM (" + " UNION ALL ".join(
            f"SELECT code, '{cell}' AS cell, nullif({column}, '') AS text, n_rows FROM decided" for cell, column in (
                ("test_names", "name"), ("units_recorded", "unit_recorded"), ("units_used", "unit")))
        + ") WHERE text IS NOT NULL GROUP BY ALL",
        "audit_registry": audit_registry_sql(),
        "document_shapes": document_sql(),
        # through files: the same rows as without
        "folder_rows": with_ctes("lab") + "SELECT file, OBS_ID, LINE_NO, CODE_TEST, SHORT_TEST, RESULT_VAL, UNIT FROM lab",
        "folder_harmonized": harmonized_sql(),
        "folder_distribution": with_ctes("shares") + "SELECT * FROM shares",
        "written_content": with_ctes("totals")
        + "SELECT file, total_rows, total_rows AS rows_written, TRUE AS row_count_match, TRUE AS source_match, "
          "TRUE AS decisions_match FROM totals",
        "periods_update": d + f"SELECT file, result, unit_recorded, code, name, n_rows, {NEW} FROM decided",
        "decisions_file": d + f"SELECT file, result, unit_recorded, code, name, n_rows, {NEW} FROM decided",
        "report_file": d
        + f"SELECT code, {NAMES} AS test_names, {joined('unit_recorded')} AS units_recorded, "
          f"{joined('unit')} AS units_used, sum(n_rows)::BIGINT AS n_rows, count(DISTINCT file) AS n_files "
          "FROM decided GROUP BY code",
        "synonyms_file": with_ctes("lab") + f"""SELECT trim(UNIT, {text(SPACE)}) AS unit_as_recorded,
  CASE WHEN n % 3 = 0 THEN '' ELSE upper(trim(UNIT, {text(SPACE)})) END AS unit_to_use
FROM (SELECT UNIT, count(*) AS n FROM lab WHERE UNIT IS NOT NULL GROUP BY UNIT) WHERE trim(UNIT, {text(SPACE)}) <> ''""",
        "conversions_file": with_ctes("lab") + f"""SELECT CODE_TEST AS code, trim(UNIT, {text(SPACE)}) AS unit_source, 'mg/dL' AS unit_target,
  (n % 5)::VARCHAR AS method, CASE WHEN n % 3 = 0 THEN NULL ELSE n / 8.0::DOUBLE END AS factor,
  CASE WHEN n % 7 = 0 THEN NULL ELSE n::DOUBLE END AS molar_mass
FROM (SELECT CODE_TEST, UNIT, count(*) AS n FROM lab WHERE CODE_TEST IS NOT NULL AND UNIT IS NOT NULL GROUP BY CODE_TEST, UNIT)""",
        "text_files": text_files_sql(),
        "wide_decisions": with_ctes("decided", view=WIDE_VIEW)
        + f"SELECT file, result, unit_recorded, code, name, n_rows, {NEW} FROM decided",
        "wide_harmonized": harmonized_sql(WIDE_VIEW),
        "wide_parse_failures": with_ctes("sums", view=WIDE_VIEW) + "SELECT file, parse_failures FROM sums",
        "wide_conversions_applied": with_ctes("num", view=WIDE_VIEW)
        + f"SELECT code, unit AS unit_source, unit_std AS unit_target, {NAMES} AS test_names, "
          f"sum(n_rows)::BIGINT AS n_rows, {FILES} FROM num WHERE conversion_status = 'convert' "
          "GROUP BY code, unit, unit_std",
    }


def text_files_sql() -> str:
    """Texts of three tables, counted by table and shape."""
    tables = {"documents": "doc_id", "benchmark": "item_id", "conversations": "conv_id"}
    rows = " UNION ALL ".join(f"SELECT '{name}.parquet' AS file, {clean('text')} AS result FROM {name}" for name in tables)
    return f"""SELECT file, shape, count(*) AS n_rows, sum(length(result))::BIGINT AS n_chars
FROM (SELECT file, result, {shape_case('result')} AS shape FROM ({rows})) GROUP BY file, shape"""


def harmonized_sql(view: str = LAB_VIEW) -> str:
    keys = ("result", "unit_recorded", "code")
    on = " AND ".join(f"s.{k} IS NOT DISTINCT FROM d.{k}" for k in keys)
    rest = ", ".join(f"d.{c.strip()}" for c in NEW.split(",")[1:])
    return with_ctes("lab", "linked", "decided", view=view) + f""", s AS (
  SELECT lab.*, CASE WHEN CODE_TEST LIKE 'MB%' OR OBS_ID IN (SELECT OBS_ID FROM linked) THEN 1 END AS gone,
    {clean('RESULT_VAL')} AS result, nullif(trim(UNIT, {text(SPACE)}), '') AS unit_clean, CODE_TEST AS code FROM lab),
look AS (SELECT DISTINCT result, unit_recorded, code, {NEW} FROM decided)
SELECT s.file, s.OBS_ID, s.LINE_NO, s.CODE_TEST, s.SHORT_TEST, s.RESULT_VAL, s.UNIT AS unit_recorded,
  CASE WHEN gone = 1 THEN 'microbiology' ELSE d.shape END AS shape, {rest}
FROM s LEFT JOIN look d ON gone IS NULL AND {on.replace('s.unit_recorded', 's.unit_clean')}"""


def near_miss_sql() -> str:
    vocabulary = ", ".join(f"({text(w)})" for w in fixed.NEAR_MISS_VOCABULARY)
    return rf""", vocabulary(word) AS (VALUES {vocabulary}),
words AS (SELECT file, result AS value, sum(n_rows)::BIGINT AS n_rows, count(DISTINCT coalesce(code, '<none>')) AS codes
  FROM decided WHERE split_action = 'review' AND NOT regexp_matches(result, '\s') AND length(result) BETWEEN 4 AND 20
  GROUP BY file, result),
scored AS (SELECT w.*, v.word, levenshtein(lower(value), v.word) AS d FROM words w JOIN vocabulary v
  ON abs(length(lower(value)) - length(v.word)) <= {fixed.NEAR_MISS_MAX_DISTANCE})
SELECT file, value, word AS nearest, d::INTEGER AS distance, n_rows, codes FROM scored
WHERE lower(value) NOT IN (SELECT word FROM vocabulary) AND d <= {fixed.NEAR_MISS_MAX_DISTANCE}
QUALIFY row_number() OVER (PARTITION BY file, value ORDER BY d, word) = 1"""


def audit_registry_sql() -> str:
    """Proposals: each numeric (code, recorded unit, name) with a method, factor and molar mass taken from its count."""
    return with_ctes("num", "synonyms") + f""", proposed AS (SELECT code, unit_recorded AS unit_source,
    CASE WHEN n % 2 = 0 THEN 'mg/dL' ELSE 'MG%' END AS unit_target, (n % 11)::VARCHAR AS method,
    CASE WHEN n % 3 = 0 THEN NULL ELSE n::DOUBLE END AS factor, CASE WHEN n % 5 = 0 THEN NULL ELSE n::DOUBLE END AS molar_mass
  FROM (SELECT code, unit_recorded, name, sum(n_rows)::BIGINT AS n FROM num WHERE code IS NOT NULL AND unit_recorded IS NOT NULL
    GROUP BY ALL)),
agreed AS (SELECT DISTINCT {key('unit_as_recorded')} AS k, unit_to_use FROM synonyms)
SELECT code, unit_source, unit_target, 'source unit is not in the agreed spelling' AS problem FROM proposed
  JOIN agreed ON k = {key('unit_source')} AND unit_to_use <> unit_source
UNION ALL SELECT code, unit_source, unit_target, 'target unit is not in the agreed spelling' FROM proposed
  JOIN agreed ON k = {key('unit_target')} AND unit_to_use <> unit_target
UNION ALL SELECT code, unit_source, unit_target, 'unknown method' FROM proposed WHERE method NOT IN ('0','1','4','5','9')
UNION ALL SELECT code, unit_source, unit_target, 'factor is missing' FROM proposed WHERE method IN ('1','4','5','9') AND factor IS NULL
UNION ALL SELECT code, unit_source, unit_target, 'molar mass is missing' FROM proposed WHERE method IN ('4','5') AND molar_mass IS NULL
UNION ALL SELECT code, unit_source, NULL, 'duplicate pair' FROM proposed GROUP BY code, unit_source HAVING count(*) > 1
UNION ALL SELECT NULL, min(unit), max(unit), 'spellings of one unit differ' FROM (
    SELECT unit_source AS unit FROM proposed UNION SELECT unit_target FROM proposed)
  WHERE unit <> '' AND {key('unit')} NOT IN (SELECT k FROM agreed) GROUP BY {key('unit')} HAVING count(DISTINCT unit) > 1"""


def document_sql() -> str:
    """Documents as lab rows: the language is the code, the source the unit; no code has an excluded prefix."""
    return with_ctes("spellings") + f""", cleaned AS (SELECT doc_id, lang AS code, {clean('text')} AS result,
    nullif(trim(source, {text(SPACE)}), '') AS unit_recorded FROM documents),
canon AS (SELECT c.*, nullif(coalesce(s.spelling, c.unit_recorded), '') AS canonical
  FROM cleaned c LEFT JOIN spellings s ON s.unit_key = {key('c.unit_recorded')}),
shaped AS (SELECT doc_id, result, canonical, length(result) AS n_chars, CASE WHEN code LIKE 'MB%' THEN 'microbiology'
  ELSE {shape_case('result')} END AS shape FROM canon),
acted AS (SELECT *, {ACTION} AS split_action FROM shaped)
SELECT 'documents.parquet' AS file, doc_id, n_chars, shape, split_action,
  CASE WHEN split_action = 'split' AND shape NOT IN {in_list(fixed.QUALITATIVE_SHAPES + ['ordinal_plus'])} THEN
    CASE WHEN suffix(result, '%') THEN '%' ELSE canonical END END AS unit FROM acted"""
