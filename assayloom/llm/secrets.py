"""Secrets in texts, and weak parts of credentials that only count together.

Base spans are found by three patterns.  Weak parts (identifiers, short secrets,
endpoints) are frequent in clean texts, so they are reported only when a
complementary part stands within ``REACH`` code points in the same scope, a
paragraph of one document.  The link is an interval join: each part is dealt to
the blocks of ``REACH`` code points that it touches, a block keeps the smallest
start and the largest end of each role, and a weak part looks up the blocks that
its interval touches.  So the work grows with the number and length of the parts,
never with pairs.  All of it is DataFrame work.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Saved, column

REACH = 200

#: The base patterns, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # the runs of 16 or more among all runs
ASSIGN_LENGTH, ACCESS_LENGTH = 12, 18

#: Weak parts.
IDENTIFIER = r"""\b(?i:access_?key_?id|client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
LONG_SECRET = r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"""\b(?:[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+|[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?\b)"""
SHORT_VALUE = 4

KINDS = ["assign", "access", "hex", "weak_access", "weak_secret", "endpoint"]
#: Role of each kind that can be part of a credential, and the roles that complement it.
ROLES = {"assign": "secret", "access": "identifier", "weak_access": "identifier", "weak_secret": "secret", "endpoint": "endpoint"}
COMPLEMENTS = {"identifier": ["secret"], "secret": ["identifier", "endpoint"], "endpoint": ["secret"]}

SPAN = "array<struct<start:int,rank:int,end:int,value:int>>"


def _matches(text: Column, pattern: str, group: int) -> Column:
    """Matches, what lies between them, and the lengths of a group; all null if there is no match."""
    return F.when(text.rlike(pattern), F.struct(
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("length"),
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length).alias("value")))


def _spans(found: Column, kind: str) -> Column:
    """Spans of the matches: ``start``, ``rank`` of the kind, ``end``, ``value`` (length of the group)."""
    def step(state: Column, i: Column) -> Column:
        start = state["at"] + F.get(found["gap"], i)
        end = start + F.get(found["length"], i)
        one = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.get(found["value"], i).alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    walked = F.aggregate(F.sequence(F.lit(0), F.size(found["length"]) - 1), start, step, lambda s: s["out"])
    return F.when(found.isNotNull(), walked).otherwise(F.array().cast(SPAN))


def _ranked(spans: Column, kind: str) -> Column:
    rank = F.lit(KINDS.index(kind))
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end"), s["value"].alias("value")))


def written(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))))


def find_parts(docs: DataFrame, text: str) -> DataFrame:
    """Add ``base`` (sorted base spans) and ``parts`` (all spans that may be part of a credential, with their scope)."""
    body = F.coalesce(column(docs, text), F.lit(""))
    patterns = {"assign": (ASSIGN, 2), "access": (ACCESS, 0), "hex": (HEX, 0), "_id": (IDENTIFIER, 0), "_long": (LONG_SECRET, 0),
                "_endpoint": (ENDPOINT, 0), "_break": (r"\n[ \t\r]*\n", 0)}
    rows = docs.withColumns({f"_m_{k}": _matches(body, p, g) for k, (p, g) in patterns.items()})
    kind = {"_id": "weak_access", "_long": "weak_secret", "_endpoint": "endpoint", "_break": "hex"}
    rows = rows.withColumns({f"_s_{k}": _spans(F.col(f"_m_{k}"), kind.get(k, k)) for k in patterns})
    rows = rows.drop(*[f"_m_{k}" for k in patterns])
    strong = F.filter("_s_assign", lambda s: s["value"] >= ASSIGN_LENGTH)
    access = F.filter("_s_access", lambda s: s["end"] - s["start"] >= ACCESS_LENGTH)
    short = F.filter("_s_assign", lambda s: s["value"].between(SHORT_VALUE, ASSIGN_LENGTH - 1))
    cut = F.filter("_s_access", lambda s: (s["end"] - s["start"]).between(12, ACCESS_LENGTH - 1))
    rows = rows.withColumns({"_strong": strong, "_access": access, "_short": _ranked(short, "weak_secret"), "_cut": _ranked(cut, "weak_access")})
    free = F.filter("_s__long", lambda w: ~F.exists("_strong", lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])))
    scope = lambda s: F.size(F.filter("_s__break", lambda b: b["start"] < s["start"]))
    parts = F.concat("_strong", "_access", "_cut", "_s__id", "_short", free, "_s__endpoint")
    weak = F.size("_cut") + F.size("_s__id") + F.size("_short") + F.size("_s__long") + F.size("_s__endpoint") > 0
    parts = F.when(weak & (F.size(parts) > 1), F.transform(parts, lambda s: F.struct(
        scope(s).alias("scope"), s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"))))
    return rows.withColumns({"base": F.sort_array(F.concat("_strong", "_access", "_s_hex")), "parts": parts}).drop(
        *[f"_s_{k}" for k in patterns], "_strong", "_access", "_short", "_cut")


def linked_parts(parts: DataFrame, reach: int = REACH, whole: bool = False) -> DataFrame:
    """Weak parts with a complement: ``key``, ``start``, ``rank``, ``end``, each once.

    ``parts`` has ``key``, ``scope``, ``start``, ``rank``, ``end``.  With ``whole``
    the code points between two parts count, whichever of them comes first;
    without it a complement is known by its start alone.

    The interval of a weak part is wider than a block, so the smallest start and
    the largest end of a block can not lie on two sides of it.
    """
    role = F.create_map(*[F.lit(x) for k, r in ROLES.items() for x in (KINDS.index(k), r)])
    beside = F.create_map(*[x for r, c in COMPLEMENTS.items() for x in (F.lit(r), F.array(*map(F.lit, c)))])
    rows = parts.withColumn("role", role[F.col("rank")])
    to = F.col("end") if whole else F.col("start")
    touched = rows.withColumn("to", to).withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / reach), F.floor(F.col("to") / reach))))
    blocks = touched.groupBy("key", "scope", "role", "block").agg(F.min("start").alias("first"), F.max("to").alias("last"))
    weak = rows.filter(F.col("rank") >= KINDS.index("weak_access")).withColumns({"low": F.col("start") - reach, "high": F.col("end") + reach})
    near = F.sequence(F.floor(F.col("low") / reach), F.floor(F.col("high") / reach))
    probes = weak.withColumn("role", F.explode(beside[F.col("role")])).withColumn("block", F.explode(near))
    met = probes.join(blocks, ["key", "scope", "role", "block"]).filter("last >= low and first <= high")
    return met.select("key", "start", "rank", "end").distinct()


def scan_secrets(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), reach: int = REACH) -> DataFrame:
    """Columns of ``keep``, ``base`` and ``spans`` (arrays of ``start``, ``rank``, ``end``, ``value``) of every row.

    - A null or empty text has no spans.
    - Null or repeated ids do not matter, rows are told apart by their place in a saved table.
    - Equal parts at one place count once; spans may overlap, as those of different kinds do.
    - Columns of ``keep`` must differ from ``base`` and ``spans``; other columns are left out.
    - No rows give no rows.
    """
    given = docs.select(column(docs, text).alias("_text"), *[column(docs, c) for c in keep])
    # only texts with a match of some pattern are saved, the others have nothing to report
    some = reduce(lambda a, b: a | b, [F.coalesce(F.col("_text"), F.lit("")).rlike(p) for p in (ASSIGN, ACCESS, HEX, IDENTIFIER, LONG_SECRET, ENDPOINT)])
    found = find_parts(given.filter(some), "_text").select(F.monotonically_increasing_id().alias("_key"), *keep, "base", "parts")
    rows = Saved(found, "parts")
    none = F.array().cast(SPAN)
    clean = given.filter(~some).select(*keep, none.alias("base"), none.alias("spans"))
    parts = rows.df.filter("parts is not null").select(F.col("_key").alias("key"), F.inline("parts"))
    linked = linked_parts(parts, reach, whole=True).groupBy("key").agg(
        F.collect_list(F.struct("start", "rank", "end", F.lit(None).cast("int").alias("value"))).alias("more"))
    linked = Saved(linked.withColumnRenamed("key", "_key"), "linked")
    spans = F.sort_array(F.concat("base", F.coalesce("more", F.array().cast(SPAN))))
    return rows.df.join(linked.df, "_key", "left").select(*keep, "base", spans.alias("spans")).unionByName(clean)


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every run of overlapping spans replaced by ``mark``; ``spans`` is sorted by start."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        more = F.when(s["start"] >= state["at"], F.concat(state["out"], between, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), more.alias("out"))

    done = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
