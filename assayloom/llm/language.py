"""Language identification by Bayesian fusion of evidence.

Four sources of evidence are combined for every text: the likelihood of its
letters under a trigram model of each language, the language that its markup
declares, the suffix of its address, and its host.  How far a declaration can be
trusted is estimated from all rows; priors are counted by host, smoothed towards
those of the address suffix, and these towards the whole corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Saved, column, small_batches
from .words import slices, words_of

LANGUAGES = ("de", "en", "es", "fr")
#: The class of texts that are like none of the languages, and its share before any evidence.
UNKNOWN, UNKNOWN_SHARE = "unknown", 0.001
#: Slots of the trigram tables: the size of the model, whatever the corpus.
SLOTS = 1 << 16
SLICE_BYTES = 1 << 20
#: Trigrams of a text overlap and repeat: as evidence they count like this many independent ones at most.
EVIDENCE = 200
#: Rows that the next wider level counts for at a host and at a suffix.
HOST_WEIGHT, SUFFIX_WEIGHT = 20.0, 50.0
#: Least probability of a text that is kept.
SURE = 0.5


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the byte trigrams of each text and the offsets of the texts; A to Z in lower case, white space as one blank."""
    words = words_of(texts, lower_ascii=True)
    data = words.data.astype(np.uint32)
    begin = np.append(words.start, len(data))[words.first]
    count = np.maximum(np.diff(begin) - 2, 0)
    offsets = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=offsets[1:])
    if len(data) < 3:
        return np.zeros(0, np.int64), offsets
    code = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    slot = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    keep = np.ones(len(slot), bool)
    for edge in begin[1:-1]:
        keep[max(edge - 2, 0) : edge] = False
    # texts of one or two bytes have none of their own
    return slot[keep][: offsets[-1]].astype(np.int64), offsets


def count_trigrams(docs: DataFrame, languages: Sequence[str]) -> DataFrame:
    """``language``, ``slot``, ``n`` over all texts with one of the languages declared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), SLOTS), np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                slot, offsets = trigrams(part["text"])
                declared = part["known"].fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(declared, np.diff(offsets))
                use = row >= 0
                counts += np.bincount(row[use] * SLOTS + slot[use], minlength=counts.size).reshape(counts.shape)
        where, slot = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(where.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(counts[where, slot])], ["language", "slot", "n"])

    rows = docs.filter(F.col("known").isNotNull()).select("known", "text")
    return rows.mapInArrow(run, "language int, slot int, n long").groupBy("language", "slot").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, languages: Sequence[str]) -> np.ndarray:
    """Log-probability of each slot in each language, and for unknown texts the same one everywhere."""
    counts = np.zeros((len(languages) + 1, SLOTS))
    # at most one row for each language and slot
    for r in count_trigrams(docs, languages).collect():
        counts[r["language"], r["slot"]] = r["n"]
    counts += 0.5
    return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def with_likelihoods(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """Add ``likelihood`` (log, one for each class) and ``trigrams`` (their number)."""
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.T))
    classes = len(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                slot, offsets = trigrams(part["text"])
                n = np.diff(offsets)
                total = np.zeros((len(n), classes))
                some = np.flatnonzero(n)
                if len(some):
                    total[some] = np.add.reduceat(table[slot], offsets[some], axis=0, dtype=np.float64)
                total *= np.minimum(1.0, EVIDENCE / np.maximum(n, 1))[:, None]
                bounds = pa.array(np.arange(len(n) + 1, dtype=np.int32) * classes)
                lists = pa.ListArray.from_arrays(bounds, pa.array(total.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(n)], [*part.schema.names, "likelihood", "trigrams"])

    schema = docs.withColumn("likelihood", F.lit(None).cast("array<double>")).withColumn("trigrams", F.lit(None).cast("long")).schema
    return docs.mapInArrow(run, schema)


def softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    parts = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(parts, lambda x: x / total)


def _sums(classes: int, of: Column) -> list[Column]:
    return [F.sum(F.get(of, F.lit(i))).alias(f"p{i}") for i in range(classes)]


def _logs(numbers: Sequence[float]) -> Column:
    return F.array(*[F.lit(math.log(x)) for x in numbers])


def identify(docs: DataFrame, text: str = "text", declared: str | None = "lang", host: str | None = "source", suffix: Column | None = None,
             keep: Sequence[str] = ("doc_id",), languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """Columns of ``keep`` and ``language``, ``probability``, ``text_language``, ``accepted`` of every row.

    ``declared`` is the column with the language of the markup, ``host`` the one
    with the host; ``suffix`` an expression, by default what follows the last dot
    of the host.

    - A null or empty text, or one of a single byte, has no evidence of its own and is not accepted.
    - A null declaration says nothing; one that names no language of the list is a value of its own.
    - A null host is a host, without a suffix.
    - Ties go to the language that stands first in the list.
    - Repeated rows stay repeated; columns of ``keep`` must differ from those added, others are left out; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    classes = [*languages, UNKNOWN]
    none = F.lit(None).cast("string")
    spoken = F.lower(F.regexp_extract(column(docs, declared).cast("string"), r"^\s*([A-Za-z]+)", 1)) if declared else none
    site = F.coalesce(column(docs, host).cast("string"), F.lit("")) if host else F.lit("")
    known = F.array_position(F.array(*map(F.lit, languages)), spoken)
    given = docs.select(
        column(docs, text).alias("text"), F.when(known > 0, (known - 1).cast("int")).alias("known"),
        F.when(spoken.isNull(), F.lit(len(classes))).when(known > 0, (known - 1).cast("int")).otherwise(F.lit(len(languages))).alias("declared"),
        site.alias("host"), (F.regexp_extract(site, r"\.([^.]+)$", 1) if suffix is None else F.coalesce(suffix, F.lit(""))).alias("suffix"),
        *[column(docs, c).alias(f"keep_{i}") for i, c in enumerate(keep) if c != text])
    model = fit(given, languages)
    start = _logs([(1 - UNKNOWN_SHARE) / len(languages)] * len(languages) + [UNKNOWN_SHARE])

    # what the texts alone say, summed by host and by declaration
    light = with_likelihoods(given.select("text", "host", "suffix", "declared"), model).filter("trigrams > 0")
    alone = softmax(F.zip_with("likelihood", start, lambda a, b: a + b))
    sums = light.withColumn("alone", alone).groupBy("suffix", "host", "declared").agg(*_sums(len(classes), F.col("alone")))
    sums = Saved(sums, "evidence")
    names = [f"p{i}" for i in range(len(classes))]
    total = [F.sum(p).alias(p) for p in names]
    # one row for each declaration, at most one more than there are classes
    by_claim = {r["declared"]: [r[p] for p in names] for r in sums.df.groupBy("declared").agg(*total).collect()}
    overall = [sum(v[i] for v in by_claim.values()) + (UNKNOWN_SHARE if i == len(languages) else 1.0) for i in range(len(classes))]
    overall = [x / sum(overall) for x in overall]
    said = {d: v for d, v in by_claim.items() if d < len(classes)}
    trust = F.lit(None).cast("array<double>")
    for d, row in said.items():
        of_class = [sum(v[i] for v in said.values()) for i in range(len(classes))]
        share = [(row[i] + 1.0) / (of_class[i] + len(classes)) for i in range(len(classes))]
        trust = F.when(F.col("declared") == d, _logs(share)).otherwise(trust)

    weight = lambda cols: sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    wide = sums.df.groupBy("suffix").agg(*total)
    wide = wide.select("suffix", *[((F.col(p) + SUFFIX_WEIGHT * overall[i]) / (weight(names) + SUFFIX_WEIGHT)).alias(f"s{i}") for i, p in enumerate(names)])
    hosts = sums.df.groupBy("suffix", "host").agg(*total).join(wide, "suffix")
    prior = F.array(*[F.log((F.col(p) + HOST_WEIGHT * F.col(f"s{i}")) / (weight(names) + HOST_WEIGHT)) for i, p in enumerate(names)])
    priors = Saved(hosts.select("suffix", "host", prior.alias("prior")), "priors")

    rows = with_likelihoods(given, model).join(priors.df, ["suffix", "host"], "left")
    flat = F.array(*[F.lit(0.0)] * len(classes))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    fused = add(add("likelihood", F.coalesce("prior", _logs(overall))), F.coalesce(trust, flat))
    rows = rows.withColumns({"fused": softmax(fused), "alone": softmax(add("likelihood", start))})
    named = F.array(*map(F.lit, classes))
    best = lambda p: F.element_at(named, F.array_position(p, F.array_max(p)).cast("int"))
    rows = rows.withColumns({"language": best(F.col("fused")), "probability": F.array_max("fused"), "text_language": best(F.col("alone"))})
    accepted = (F.col("trigrams") > 0) & (F.col("language") != UNKNOWN) & (F.col("probability") >= SURE)
    return rows.select(
        *[F.col("text" if c == text else f"keep_{i}").alias(c) for i, c in enumerate(keep)], "language", "probability", "text_language", accepted.alias("accepted"))
