"""Language identification: trigrams and fusion against plain Python, accuracy on held-out texts."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from assayloom.llm.language import SLOTS, identify, trigrams
from assayloom.llm.queries import op8_language_evidence


def test_trigrams():
    texts = [None, "", "a", "ab", "ABC", "a  b\tc", "x" * 1000, "é", "éa"]
    slot, offsets = trigrams(pa.array(texts))
    for i, text in enumerate(texts):
        data = " ".join((text or "").lower().split()).encode()
        # each text ends in a blank
        data += b" " if data else b""
        want = [((a << 16 | b << 8 | c) * 0x9E3779B1 & 0xFFFFFFFF) >> 16 for a, b, c in zip(data, data[1:], data[2:])]
        assert slot[offsets[i] : offsets[i + 1]].tolist() == want, text
    assert SLOTS == 1 << 16


def test_accuracy_without_declarations(spark):
    """Half of the documents declare their language, those of the other half are found."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("true", F.col("lang"))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    rows = identify(docs, keep=["doc_id", "true"]).collect()
    hidden = [r for r in rows if r["doc_id"] % 2]
    assert sum(r["language"] == r["true"] for r in hidden) > 0.96 * len(hidden)
    assert sum(r["accepted"] for r in rows) > 0.98 * len(rows)


def test_query_keeps_documents(spark):
    rows = op8_language_evidence(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and sum(r["accepted"] for r in rows) >= 199


def test_evidence(documents):
    """Words of one language only; a mixed text follows its declaration or its host."""
    rnd = random.Random(1)
    words = {lang: ["".join(rnd.choice(letters) for _ in range(6)) for _ in range(50)] for lang, letters in
             {"de": "abcdef", "en": "ghijkl", "es": "mnopqr", "fr": "stuvwx"}.items()}
    text = lambda lang, n=30: " ".join(rnd.choice(words[lang]) for _ in range(n))
    rows = [(100 * i + j, text(lang), lang, f"{lang}.site.{lang}") for i, lang in enumerate(words) for j in range(40)]
    both = words["de"][0] + " " + words["fr"][0]
    rows += [(1000, both, "de", "x"), (1001, both, "FR-be", "x"), (1002, both, None, "de.site.de"), (1003, both, None, "new.host.fr"), (1004, text("en"), "de", "q"),
             (1005, None, "de", "de.site.de"), (1006, "", "de", None), (1007, "ab", "de", None), (1008, "日本語の文章です " * 20, None, None),
             (None, text("es"), None, None), (1009, text("es", 30_000), "??", "y"), (1009, text("es"), "xx", "y")]
    got = {r["doc_id"]: r for r in identify(documents(rows)).collect()}
    for i, lang in enumerate(words):
        assert all(got[100 * i + j]["language"] == lang and got[100 * i + j]["accepted"] for j in range(40))
    assert [got[i]["language"] for i in (1000, 1001, 1002, 1003, 1004)] == ["de", "fr", "de", "fr", "en"]
    assert not any(got[i]["accepted"] for i in (1005, 1006, 1008))
    assert got[None]["language"] == got[1009]["language"] == "es"
    assert identify(documents([])).collect() == []
    clash = documents(rows).withColumn("prior", F.lit(1)).withColumn("text_language", F.lit("x"))
    assert identify(clash).count() == len(rows)


def test_pages_by_markup_and_address(spark):
    """The same operator over raw pages: text of the markup, its language attribute, host and suffix of the address."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select(
        "page_id", F.regexp_replace("html", r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>", " ").alias("text"),
        F.regexp_extract("html", r'<html[^>]*\blang="([^"]*)"', 1).alias("lang"), F.regexp_extract("url", r"://([^/?#]*)", 1).alias("source"))
    rows = identify(pages, keep=["page_id", "lang"]).collect()
    assert len(rows) == 250 and sum(r["language"] == r["lang"] for r in rows) > 0.97 * len(rows)
    assert np.isclose(max(r["probability"] for r in rows), 1.0, atol=1e-3)
