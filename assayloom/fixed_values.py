"""Fixed values.

Everything in this file is rule data whose content decides the results: word
lists, spellings, patterns, labels and conversion factors.  Tables that map a
pattern to a label are ordered, the first pattern found wins.  The code that
uses them is in ``rules.py`` and ``functions/``.
"""

# --- result text -------------------------------------------------------------

NARRATIVE_LENGTH = 80
LINE_BREAK = r"(?i)\.br|[\r\n]"
NUMERIC_TRAILING_DOT = r"^([^\p{L}]*[\d+%])\s*\.+$"
STANDALONE_NUMBER = r"(?:^|[^\p{L}\d])\d+(?:\.\d+)?(?:[^\p{L}\d]|$)"
STRAY_PUNCTUATION = "!.,'\"\\[]"
PERCENT_UNIT = "%"

NULL_WORDS = r"none|n/?a"
NOT_REPORTED = r"\*+0+"

# --- numbers -----------------------------------------------------------------

NUMBER_CORE = r"[+-]?(?:(?:\d{1,3}(?:,\d{3})+)|\d+)(?:\.\d+)?(?:[eE][+-]?\d+)?"
NUMBER_LEADING_DOT = r"[+-]?\.\d+(?:[eE][+-]?\d+)?"
NUMBER_SIMPLE = r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)"
RANGE_SEPARATOR = "[-–]"

OPERATOR_TOKENS = [r"<\s*/\s*=", r">\s*/\s*=", "<=", ">=", "<", ">", "="]
OPERATOR_SPELLINGS = [(r"<\s*/\s*=", "<="), (r">\s*/\s*=", ">=")]
COMPARISON_TOKENS = ["<=", ">=", "<", ">", "="]

# (word, operator, label)
VERBAL_OPERATORS = [
    ("over", ">", "Over"),
    ("above", ">", "Above"),
    (r"greater\s+than", ">", "Greater Than"),
    ("under", "<", "Under"),
    ("below", "<", "Below"),
    (r"less\s+than", "<", "Less Than"),
]

# --- words -------------------------------------------------------------------

GLOSS = r"\s*\([^)]+\)"

QUALIFIER_VALUES = [
    (r"non[-\s]?reactive", "Non-Reactive"),
    ("reactive", "Reactive"),
    ("equivocal?", "Equivocal"),
    ("positive|positve|postive", "Positive"),
    ("negative|negativ|nagative|neagtive|negartiv|megative", "Negative"),
]

MODIFIER_RANGES = [
    (r"dimly\s*-\s*moderately", "Dimly-Moderately"),
    (r"moderately\s*-\s*brightly", "Moderately-Brightly"),
    (r"dimly\s*-\s*brightly", "Dimly-Brightly"),
]

MODIFIERS = [
    ("marked(?:ly)?", "Marked"),
    ("slight(?:ly)?", "Slightly"),
    ("moderate(?:ly)?", "Moderate"),
    ("weak(?:ly)?", "Weakly"),
    ("strong(?:ly)?", "Strongly"),
    ("presumptive", "Presumptive"),
    ("culture", "Culture"),
    ("grayzone", "Grayzone"),
    ("dimly", "Dimly"),
    ("brightly", "Brightly"),
]

DETECTION_VALUES = [
    (r"not\s+(?:detected|seen|found)", "Negative"),
    ("undetect(?:ed)?", "Negative"),
    (r"(?:not\s+|non[-\s]?|un)detectable", "Negative"),
    ("(?:detected|seen|found)", "Positive"),
    ("detectable", "Positive"),
    ("borderli(?:ne)?", "Equivocal"),
]

SEVERITY_GRADES = [
    ("rare", "Rare"),
    ("trace|teace|tarce|trece|tracr|ttace|ttrace|tracce|trce|trcace|tace|trae|treca|traec|traxce|trrace|treace",
     "Trace"),
    ("few|feww|fewe|feew|ferw|feqw|fewq|fdew|frew|fwew|fesw|fewf|ffew|gfew|fewz|fbew|efew|faew|fewr|fews|ftew|fezw",
     "Few"),
    ("moderate|moderat|moderte|modurate", "Moderate"),
    ("numerous", "Numerous"),
    ("many", "Many"),
    ("adequated?|adequete", "Adequate"),
    ("decreased?|decreasd|decrased|decraese|decrase", "Decreased"),
    ("increased?", "Increased"),
]

NEAR_MISS_MAX_DISTANCE = 2
NEAR_MISS_MIN_LENGTH = 4
NEAR_MISS_MAX_LENGTH = 20
NEAR_MISS_VOCABULARY = [
    "positive", "negative", "reactive", "equivocal",
    "detected", "undetected", "detectable", "undetectable", "borderline",
    "rare", "trace", "few", "moderate", "numerous", "many",
    "adequate", "decrease", "increase",
    "marked", "slightly", "weakly", "strongly",
]

# --- shapes as patterns ------------------------------------------------------

# shape -> pattern, in the order in which they are tried; names in braces stand for the patterns above
SHAPE_PATTERNS = [
    ("plain_numeric", r"^{number}\s*%?\z"),
    ("operator_numeric", r"^{sign}\s*{number}\s*%?\z"),
    ("numeric_range", r"^{simple}\s*{separator}\s*{simple}\s*%?\z"),
    ("ordinal_plus", r"^\d+\+\z"),
    ("verbal_operator_numeric", r"(?i)^{verbal}\s+{simple}\s*%?\z"),
    ("qualifier_numeric", r"(?i)^(?:{simple}\s*%?\s*)?(?:{any_modifier}\s+)?{quality}{gloss}(?:\s*{simple}\s*%?)?\z"),
    ("qualifier_ordinal", r"(?i)^{quality}\s+\d+\+\z"),
    ("qualifier_comparison", r"(?i)^{quality}\s*{compare}\s*{simple}\s*%?\z|^{compare}\s*{simple}\s*%?\s*{quality}\z"),
    ("mixed_text_numeric", r"{standalone}"),
    ("qualifier_detection", r"(?i)^(?:{modifier}\s+)?{detection}{gloss}\.?\z"),
    ("severity_grade", r"(?i)^{severity}\z"),
    ("short_text", r"\p{{L}}"),
]

# --- shapes and actions ------------------------------------------------------

SHAPES = [
    "missing", "null_literal", "not_reported_sentinel", "narrative_text",
    "plain_numeric", "operator_numeric", "numeric_range", "ordinal_plus",
    "verbal_operator_numeric", "qualifier_numeric", "qualifier_ordinal",
    "qualifier_comparison", "mixed_text_numeric", "qualifier_detection",
    "severity_grade", "short_text", "punctuation_or_junk",
]
MISSING_SHAPES = ["missing", "null_literal", "not_reported_sentinel", "punctuation_or_junk"]
REVIEW_SHAPES = ["narrative_text", "mixed_text_numeric", "short_text"]
NUMERIC_SHAPES = ["plain_numeric", "operator_numeric", "numeric_range", "verbal_operator_numeric"]
QUALITATIVE_SHAPES = ["qualifier_numeric", "qualifier_ordinal", "qualifier_comparison", "qualifier_detection"]
ORDINAL_SHAPES = ["ordinal_plus", "qualifier_ordinal"]

EXCLUDED_CODE_PREFIXES = ["MB"]
EXCLUDED_SHAPE = "microbiology"
REVIEW_TOP_N = 300
NAME_SEPARATOR = " | "
FILE_SEPARATOR = "; "
BLANK_UNIT = "<blank>"

# --- units -------------------------------------------------------------------

# (unit as recorded, unit to use); an empty unit to use means "not a unit"
UNIT_SYNONYMS = [
    ("๐", ""),
    ("K/ul", "10^3/uL"),
    (r"x 10\S\3/cumm", "10^3/uL"),
    (r"x 10\S\3/ul", "10^3/uL"),
    (r"10\S\6/mm\S\3", "10^6/uL"),
    (r"x 10\S\6/cumm", "10^6/uL"),
    (r"x 10\S\6/ul", "10^6/uL"),
    ("UA/mL", "AU/mL"),
    ("aU/ml", "AU/mL"),
    ("BAU/ml", "BAU/mL"),
    ("'c", "C"),
    ("Celsius", "C"),
    ("Log(Copies/mL)", "Log(copies/mL)"),
    ("Log(cp/mL)", "Log(copies/mL)"),
    ("Cell/cumm.", "cells/uL"),
    ("Cells/ul", "cells/uL"),
    ("WBC/ul", "cells/uL"),
    ("Copies", "copies/mL"),
    ("Copies/mL", "copies/mL"),
    ("cp/mL", "copies/mL"),
    ("Hrs.", "hours"),
    ("mlU/mL", "mIU/mL"),
    ("ml", "mL"),
    ("mL/min/1.73 m", "mL/min/1.73m2"),
    ("mL/min/1.73 m2", "mL/min/1.73m2"),
    (r"ml/min/1.73 m\S\2", "mL/min/1.73m2"),
    ("mOsm/Kg", "mOsm/kg"),
    ("mg%", "mg/dL"),
    ("mg.", "mg/dL"),
    ("mg/dL1", "mg/dL"),
    ("mg/24 hr", "mg/day"),
    ("mg/d", "mg/day"),
    ("min.", "min"),
    ("mm/hr.", "mm/hr"),
    ("mmol / 24hr", "mmol/day"),
    ("nM", "nmol/L"),
    ("ug / 24hr", "ug/day"),
    ("micro g/gr", "ug/g"),
    ("ug/g Creatinine", "ug/g creatinine"),
    ("micro mol/L", "umol/L"),
    ("weeks.", "weeks"),
]

CONVERSION_METHODS = ["0", "1", "4", "5", "9"]
METHODS_WITH_FACTOR = ["1", "4", "5", "9"]
METHODS_WITH_MOLAR_MASS = ["4", "5"]

# (code, unit_source, unit_target, method, factor, molar_mass)
UNIT_CONVERSIONS = [
    ("100043", "ug/mL", "g/L", "1", 0.001, None),
    ("100051", "ug/mL", "g/L", "1", 0.001, None),
    ("100065", "mg/mL", "g/L", "1", 1.0, None),
    ("100065", "ng/mL", "g/L", "1", 1e-6, None),
    ("100534", "mg/mL", "g/L", "1", 1.0, None),
    ("100560", "ng/mL", "nmol/L", "5", 1000.0, 288.4),
    ("150660", "mg/dL", "g/dL", "1", 0.001, None),
    ("200008", "g/L", "g/dL", "1", 0.1, None),
    ("200011", "pg/mL", "ng/dL", "1", 0.1, None),
    ("200016", "umol/L", "ug/dL", "4", 0.1, 17.03),
    ("200021", "g/L", "mg/dL", "1", 100.0, None),
    ("200022", "g/L", "mg/dL", "1", 100.0, None),
    ("200030", "mmol/L", "mg/dL", "4", 0.1, 28.0),
    ("200031", "mmol/L", "mg/dL", "4", 0.1, 28.0),
    ("200033", "mmol/L", "mg/dL", "4", 0.1, 40.08),
    ("200035", "mmol/L", "mg/dL", "4", 0.1, 40.08),
    ("200040", "mg/dL", "mmol/L", "5", 10.0, 35.45),
    ("200047", "mmol/L", "mg/dL", "4", 0.1, 386.65),
    ("200048", "mmol/L", "mg/dL", "4", 0.1, 386.65),
    ("200052", "ug/mL", "ng/mL", "1", 1000.0, None),
    ("200058", "umol/L", "mg/dL", "4", 0.0001, 113.12),
    ("200059", "umol/L", "mg/dL", "4", 0.0001, 113.12),
    ("200065", "umol/L", "mg/dL", "4", 0.0001, 584.7),
    ("200066", "umol/L", "mg/dL", "4", 0.0001, 584.7),
    ("200076", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200077", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200078", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200079", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200081", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200082", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200085", "mmol/L", "mg/dL", "4", 0.1, 386.67),
    ("200090", "mmol/L", "mg/dL", "4", 0.1, 30.97),
    ("200091", "mmol/L", "mg/dL", "4", 0.1, 30.97),
    ("200092", "mmol/L", "mg/dL", "4", 0.1, 30.97),
    ("200098", "mg/dL", "mmol/L", "5", 10.0, 90.078),
    ("200099", "mg/dL", "mmol/L", "5", 10.0, 90.078),
    ("200106", "mmol/L", "mg/dL", "4", 0.1, 386.65),
    ("200111", "g/L", "mg/dL", "1", 100.0, None),
    ("200116", "mmol/L", "mg/dL", "4", 0.1, 24.305),
    ("200117", "mmol/L", "mg/dL", "4", 0.1, 24.305),
    ("200118", "mmol/L", "mg/dL", "4", 0.1, 24.305),
    ("200127", "pmol/L", "pg/mL", "9", 8.457, None),
    ("200134", "umol/L", "ug/dL", "4", 0.1, 55.845),
    ("200146", "umol/L", "ug/dL", "4", 0.1, 55.845),
    ("200148", "umol/L", "mg/dL", "4", 0.0001, 584.7),
    ("200149", "umol/L", "mg/dL", "4", 0.0001, 584.7),
    ("200157", "mmol/L", "mg/dL", "4", 0.1, 885.7),
    ("200158", "mmol/L", "mg/dL", "4", 0.1, 885.7),
    ("200159", "ng/mL", "ng/L", "1", 1000.0, None),
    ("200160", "mmol/L", "mg/dL", "4", 0.1, 28.0),
    ("200162", "umol/L", "mg/dL", "4", 0.0001, 168.11),
    ("200163", "umol/L", "mg/dL", "4", 0.0001, 168.11),
    ("200168", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200169", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200170", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200171", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200173", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200174", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200257", "mg/dL", "mg/L", "1", 10.0, None),
    ("200302", "ug/L", "mg/L", "1", 0.001, None),
    ("200309", "umol/L", "mg/dL", "4", 0.0001, 408.6),
    ("200531", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200532", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200533", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200534", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200611", "mmol/L", "mg/dL", "4", 0.1, 40.08),
    ("200613", "mmol/day", "mg/day", "4", 1.0, 40.08),
    ("200616", "mmol/L", "mg/dL", "4", 0.1, 30.97),
    ("200618", "mmol/day", "g/day", "4", 0.001, 30.97),
    ("200621", "mmol/L", "mg/dL", "4", 0.1, 24.305),
    ("200623", "mmol/day", "mg/day", "4", 1.0, 24.305),
    ("200626", "mmol/L", "mg/dL", "4", 0.1, 28.0),
    ("200628", "mmol/day", "g/day", "4", 0.001, 28.0),
    ("200638", "mmol/day", "g/day", "4", 0.001, 113.12),
    ("200643", "mmol/day", "mg/day", "4", 1.0, 168.11),
    ("200651", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200652", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("200681", "mmol/L", "mg/dL", "4", 0.1, 40.08),
    ("200682", "mmol/L", "mg/dL", "4", 0.1, 40.08),
    ("200686", "mmol/L", "mg/dL", "4", 0.1, 24.305),
    ("200687", "mmol/L", "mg/dL", "4", 0.1, 24.305),
    ("200712", "mmol/day", "g/day", "4", 0.001, 113.12),
    ("200714", "umol/L", "mg/dL", "4", 0.0001, 113.12),
    ("201002", "mmol/L", "mg/dL", "4", 0.1, 113.12),
    ("201003", "umol/L", "mg/dL", "4", 0.0001, 168.11),
    ("201004", "mmol/L", "mg/dL", "4", 0.1, 168.11),
    ("250081", "mg/mL", "mg/L", "1", 1000.0, None),
    ("350012", "ug/mL", "mg/L", "1", 1.0, None),
    ("350035", "ug/mL", "mg/L", "1", 1.0, None),
    ("350084", "ug/L", "ng/mL", "1", 1.0, None),
    ("350269", "mg/L", "ug/mL", "1", 1.0, None),
    ("350339", "mmol/L", "ug/L", "4", 1000.0, 6.941),
    ("H119", "mmol/L", "mg/dL", "4", 0.1, 180.0),
    ("Lac", "mg/dL", "mmol/L", "5", 10.0, 90.078),
]

# Names of the columns that are added to the rows.
SPLIT_COLUMNS = [
    "shape", "split_action", "operator", "number", "range_low", "range_high",
    "unit", "value", "qualifier",
]
STANDARD_COLUMNS = ["number_std", "range_low_std", "range_high_std", "unit_std", "conversion_status"]
