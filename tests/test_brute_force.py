"""Random texts judged by Spark and by a slow, separate reading of the rules in Python."""

import random

import regex

from assayloom import fixed_values as fixed

PIECES = (
    ["Positive", "negative", "Non-Reactive", "reactive", "equivoca", "megative", "weakly", "Dimly", "moderately", "brightly", "-", " - ",
     "not detected", "Detected", "undetectable", "found", "borderline", "few", "Trace", "teace", "increased", "Moderate", "over",
     "Less than", "greater  than", "above", "<", ">", "<=", "</=", "> / =", "=", "+", "%", " %", ".", ",", "5", "12", "1,234", ".5",
     "3.", "-7", "1e5", "0", "3+", "*", "*000", "none", "N/A", "(x)", "(positive)", "(5)", "(", ")", "\n", ".br", "ตรวจ", "๕", "–", "!", "'",
     "culture", "word", "JAK2", ":", "/"]
)


def texts(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        parts = [rng.choice(PIECES) for _ in range(rng.randint(1, 4))]
        out.append("".join(p + rng.choice(["", " ", " "]) for p in parts))
    return out


def words(table):
    return "|".join(row[0] for row in table)


SIMPLE, QUALITY, MODIFIER = fixed.NUMBER_SIMPLE, f"(?:{words(fixed.QUALIFIER_VALUES)})", f"(?:{words(fixed.MODIFIERS)})"
ANY = f"(?:{words(fixed.MODIFIER_RANGES)}|{words(fixed.MODIFIERS)})"
NUMBER = f"(?:{fixed.NUMBER_CORE}|{fixed.NUMBER_LEADING_DOT})"
COMPARE = "(?:<=|>=|<|>|=)"
GLOSS = f"(?:{fixed.GLOSS})?"
TOKEN = f"(?:{'|'.join(fixed.OPERATOR_TOKENS)})"


def clean(raw):
    t = raw.strip()
    t = regex.sub(r"^([^\p{L}]*[\d+%])\s*\.+\Z", r"\1", t)
    t = regex.sub(r"""^[!.,'"\\\[\]]+(\p{L}+)\Z""", r"\1", t)
    return regex.sub(r"""^(\p{L}+)[!.,'"\\\[\]]+\Z""", r"\1", t)


def shape(v):
    full = lambda p: regex.fullmatch(p, v, regex.I)
    if v == "":
        return "missing"
    if full("none|n/?a"):
        return "null_literal"
    if full(r"\*+0+"):
        return "not_reported_sentinel"
    if len(v) > 80 or "\n" in v or "\r" in v or ".br" in v.lower():
        return "narrative_text"
    if full(rf"{NUMBER}\s*%?"):
        return "plain_numeric"
    if full(rf"{TOKEN}\s*{NUMBER}\s*%?"):
        return "operator_numeric"
    if full(rf"{SIMPLE}\s*[-–]\s*{SIMPLE}\s*%?"):
        return "numeric_range"
    if full(r"\d+\+"):
        return "ordinal_plus"
    if full(rf"(?:{words(fixed.VERBAL_OPERATORS)})\s+{SIMPLE}\s*%?"):
        return "verbal_operator_numeric"
    if full(rf"(?:{SIMPLE}\s*%?\s*)?(?:{ANY}\s+)?{QUALITY}{GLOSS}(?:\s*{SIMPLE}\s*%?)?"):
        return "qualifier_numeric"
    if full(rf"{QUALITY}\s+\d+\+"):
        return "qualifier_ordinal"
    if full(rf"{QUALITY}\s*{COMPARE}\s*{SIMPLE}\s*%?|{COMPARE}\s*{SIMPLE}\s*%?\s*{QUALITY}"):
        return "qualifier_comparison"
    if regex.search(fixed.STANDALONE_NUMBER, v):
        return "mixed_text_numeric"
    if full(rf"(?:{MODIFIER}\s+)?(?:{words(fixed.DETECTION_VALUES)}){GLOSS}\.?"):
        return "qualifier_detection"
    if full(words(fixed.SEVERITY_GRADES)):
        return "severity_grade"
    return "short_text" if regex.search(r"\p{L}", v) else "punctuation_or_junk"


def number_of(text):
    try:
        return float(text) if text.isascii() else None
    except ValueError:
        return None


def first(pattern, text, group=0):
    m = regex.search(pattern, text)
    return m.group(group) if m else None


def typed(v, kind):
    plain = regex.sub(fixed.GLOSS, "", v).lower()
    out = dict.fromkeys(["operator", "number", "range_low", "range_high", "value", "qualifier"])

    def label(table, form):
        return next((row[-1] for row in table if regex.search(form.format(row[0]), plain)), None)

    if kind in ("plain_numeric", "operator_numeric", "verbal_operator_numeric"):
        bare = regex.sub(rf"^{TOKEN}\s*", "", v)
        bare = regex.sub(rf"(?i)^(?:{words(fixed.VERBAL_OPERATORS)})\s*", "", bare)
        out["number"] = number_of(bare.replace(",", "").rstrip("%").strip())
    if kind == "operator_numeric":
        out["operator"] = regex.sub(r"\s*/\s*", "", first(rf"^{TOKEN}", v))
    if kind == "verbal_operator_numeric":
        word = next(r for r in fixed.VERBAL_OPERATORS if regex.search(rf"\b{r[0]}\b", plain))
        out["operator"], out["qualifier"] = word[1], word[2]
    if kind in fixed.ORDINAL_SHAPES:
        out["operator"], out["number"] = "+", number_of(first(r"(\d+)\+", v, 1))
    if kind == "qualifier_comparison":
        out["operator"] = first(COMPARE, plain)
    if kind in ("qualifier_numeric", "qualifier_comparison") and first(SIMPLE, plain):
        out["number"] = number_of(first(SIMPLE, plain))
    if kind == "numeric_range":
        m = regex.match(rf"({SIMPLE})\s*[-–]\s*({SIMPLE})", v)
        out["range_low"], out["range_high"] = number_of(m[1]), number_of(m[2])
    if kind == "qualifier_detection":
        out["value"] = label(fixed.DETECTION_VALUES, rf"^(?:{MODIFIER}\s+)?(?:{{}})\.?$")
    elif kind in fixed.QUALITATIVE_SHAPES:
        out["value"] = label(fixed.QUALIFIER_VALUES, "{}")
    if kind in ("qualifier_numeric", "qualifier_detection"):
        out["qualifier"] = label(fixed.MODIFIER_RANGES + fixed.MODIFIERS, r"\b(?:{})\b")
    if kind == "severity_grade":
        out["qualifier"] = label(fixed.SEVERITY_GRADES, r"^(?:{})$")
    return out


def test_random_texts(judge):
    raw = texts(6000, seed=7)
    seen = set()
    for text, got in zip(raw, judge([(t, None, None) for t in raw])):
        v = clean(text)
        kind = shape(v)
        seen.add(kind)
        assert got["shape"] == kind, (text, kind, got["shape"])
        for column, want in typed(v, kind).items():
            assert got[column] == want, (text, kind, column, want, got[column])
    assert seen == set(fixed.SHAPES)


def test_signature_skips_no_pattern_that_matches(spark):
    """Shapes with and without the signature, also for words of one's own."""
    from dataclasses import replace

    from pyspark.sql import functions as F

    from assayloom.functions.shape import shape as shape_of, signature
    from assayloom.rules import TextRules, always_has_letter

    own = replace(
        TextRules(), null_words="[0-9]x?|-", line_break="@", verbal_operators=((r"\+\+", ">", "Up"), ("over", ">", "Over")),
        qualifier_values=(("[+]{2}", "High"), ("5?x?", "Maybe"), ("positive", "Positive")), severity_grades=(("~|few", "Few"),),
        detection_values=((r"\p{Nd}{3}", "Code"), ("seen", "Positive")))
    values = [t.strip() for t in texts(6000, 11)] + ["++ 5", "++", "5", "x", "~", "345", "5 3+", "\u0e55", "a@b", "-", "7x", "5x 4+", "<5 ++", "E", "e5", "1e", "*0"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", signature(F.col("v"), 81).alias("b"))
    for rules in (TextRules(), own):
        both = df.select("v", shape_of(F.col("v"), rules).alias("slow"), shape_of(F.col("v"), rules, F.col("b")).alias("fast"))
        assert both.filter("not slow <=> fast").collect() == []
    assert own.lettered() == set() and len(TextRules().lettered()) == 7
    sure = ["over", r"less\s+than", "non[-x]?reactive", "(?:a|b)c?", "borderli(?:ne)?", "a|b"]
    unsure = ["a?", "a|5", "[ab]", "(a)", r"\d", "(?:a|5)", "(?:ab)*", "x{0,2}", r"\x41", "[a[b]c]", "(?:[(]a)", ""]
    assert [always_has_letter(p) for p in sure + unsure] == [True] * len(sure) + [False] * len(unsure)
