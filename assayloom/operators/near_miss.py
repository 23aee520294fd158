"""Single words in review that are close to a known word.  A report, never a decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom import fixed_values as fixed
from assayloom.functions.text import matches
from assayloom.rules import TextRules


def nearest_word(word: Column, rules: TextRules) -> Column:
    """Struct ``(distance, nearest)`` of the closest vocabulary word, null when none is close.

    The vocabulary is a short list of rule words, so each value looks through
    it in place; words whose length is too different are not compared.
    """
    limit = rules.max_distance
    vocabulary = F.array(*[F.lit(w.lower()) for w in rules.vocabulary])
    similar = F.filter(vocabulary, lambda w: F.abs(F.length(w) - F.length(word)) <= limit)
    scored = F.transform(
        similar, lambda w: F.struct(F.levenshtein(word, w, limit).alias("distance"), w.alias("nearest"))
    )
    return F.array_min(F.filter(scored, lambda s: s["distance"] >= 0))


def candidate_words(decisions: DataFrame) -> DataFrame:
    """Single-word review values of each file with their rows and number of codes (no code counts as one)."""
    length = F.length("result")
    single = (
        F.col("excluded_by").isNull()
        & (F.col("split_action") == "review")
        & length.between(fixed.NEAR_MISS_MIN_LENGTH, fixed.NEAR_MISS_MAX_LENGTH)
        & ~matches(F.col("result"), r"\s")
    )
    return (
        decisions.filter(single)
        .groupBy("file", F.col("result").alias("value"), "code")
        .agg(F.sum("n_rows").alias("n_rows"))
        .groupBy("file", "value")
        .agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("codes"))
    )


def without_letters(word: Column, most: int) -> Column:
    """The word and all that is left of it without one letter, two letters, up to ``most``."""
    def one_less(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(w))
        shorter = F.transform(places, lambda i: F.concat(F.left(w, i - 1), F.substring(w, i + 1, F.length(w))))
        return F.when(F.length(w) > 0, shorter).otherwise(F.array().cast("array<string>"))

    level = every = F.array(word)
    for _ in range(most):
        level = F.array_distinct(F.flatten(F.transform(level, one_less)))
        every = F.concat(every, level)
    return F.array_distinct(every)


def nearest_words(words: DataFrame, vocabulary: DataFrame, limit: int) -> DataFrame:
    """``word``, ``best`` (``distance, nearest``) of the closest vocabulary word, for words that have one within ``limit`` edits.

    Two words within that many edits have a rest in common when each may lose as
    many letters, so words meet in a join on the hash of such rests.  Only pairs
    that meet are compared, exactly; the vocabulary may be as large as the words.
    ``words`` and ``vocabulary`` have one column ``word``.
    """
    def rests(table: DataFrame, name: str) -> DataFrame:
        each = table.select(F.col("word").alias(name)).filter(F.col(name).isNotNull()).distinct()
        return each.select(name, F.explode(F.transform(without_letters(F.col(name), limit), lambda r: F.xxhash64(r))).alias("_rest"))

    longest = fixed.NEAR_MISS_MAX_LENGTH + limit
    known = vocabulary.filter(F.length("word") <= longest)
    met = rests(words.filter(F.length("word") <= longest), "word").join(rests(known, "_other"), "_rest").select("word", "_other").distinct()
    near = met.withColumn("_distance", F.levenshtein("word", "_other", limit)).filter(F.col("_distance") >= 0)
    best = F.min(F.struct(F.col("_distance").alias("distance"), F.col("_other").alias("nearest")))
    return near.groupBy("word").agg(best.alias("best"))


def near_misses_among(decisions: DataFrame, vocabulary: DataFrame, limit: int = fixed.NEAR_MISS_MAX_DISTANCE) -> DataFrame:
    """As :func:`near_misses`, for a vocabulary that is a table (``word``) of any size."""
    found = candidate_words(decisions).withColumn("word", F.lower("value"))
    best = nearest_words(found.select("word"), vocabulary.select(F.lower("word").alias("word")), limit)
    return found.join(best.filter(F.col("best.distance") > 0), "word").select(
        "file", "value", "best.nearest", "best.distance", "n_rows", "codes")


def near_misses(decisions: DataFrame, rules: TextRules = TextRules()) -> DataFrame:
    """Words at most ``max_distance`` edits from a vocabulary word; exact words are left out."""
    best = nearest_word(F.lower("value"), rules)
    return (
        candidate_words(decisions)
        .withColumn("best", best)
        .filter(F.col("best.distance") > 0)
        .select("file", "value", "best.nearest", "best.distance", "n_rows", "codes")
    )
