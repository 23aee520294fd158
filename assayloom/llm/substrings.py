"""Repeated windows of words, counted exactly by super-k-mers.

Each window of ``k`` words has a minimiser, the smallest hash of its runs of
``MER`` words.  Consecutive windows with one minimiser travel as one packed
string to the bucket of that minimiser.  Equal windows have equal minimisers, so
they meet there, and the bucket tells windows apart by sorting their words: ranks
of single words give ranks of three, nine and 27 words, and two of those make a
window.  No hash decides whether two windows are equal; digests of 128 bits only
name whole packed strings and texts where results are joined back.

Minimisers that are frequent in the corpus, as those of a passage in many
documents, are ranked behind all others.  Windows that reach out of such a
passage then go to the buckets of their own words; those inside it are equal and
are combined before the shuffle.

A packed string whose minimiser begins no other one holds no repeated window and
need not travel.  Minimisers are counted over all texts first; those that come
again are marked in a bit table of fixed size that goes to every task.  Two
minimisers may share a bit, then a string travels without need; none that is
needed stays behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Saved, column, in_groups, release_shuffles, small_batches, whole_groups
from .words import MIX_1, Words, mix, slices, spans, words_of

WINDOW = 35
#: Words of the runs that are candidates for the minimiser; half a window at most.
MER = 8
#: Windows of a packed string.
MOST_WINDOWS = 256
#: A minimiser is frequent if it begins more than this share of all packed strings, so at most 100,000 are.
FREQUENT, LEAST_FREQUENT = 1e-5, 500
#: Size of the table of minimisers that come again, 16 MB for any corpus: 64-bit words, and words of one row on the way to the driver.
TABLE_WORDS, ROW_WORDS = 1 << 21, 1 << 13
SLICE_BYTES = 1 << 21
#: Packed strings that are sorted together.
BUCKET_ROWS = 12_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LAST = np.uint64(1 << 63)


def word_hashes(words: Words) -> np.ndarray:
    """A polynomial of the bytes of each word, all from one running sum."""
    n = len(words.data)
    power = np.full(n, _BASE)
    power[:1] = 1
    power = np.cumprod(power, dtype=np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words.data.astype(np.uint64) * power, dtype=np.uint64, out=total[1:])
    undo = np.full(n, _UNDO)
    undo[:1] = 1
    undo = np.cumprod(undo, dtype=np.uint64)
    length = (words.end - words.start).astype(np.uint64)
    return mix((total[words.end] - total[words.start]) * undo[words.start] + length * MIX_1)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each ``width`` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


class Runs:
    """Runs of consecutive windows with one minimiser: ``key``, first word ``at``, number of windows ``count``, ``doc``.

    ``again`` tells whether the minimiser stands in the run more than once.
    """

    def __init__(self, words: Words, window: int, frequent: np.ndarray):
        empty = np.zeros(0, np.int64)
        self.key, self.at, self.count, self.doc = np.zeros(0, np.uint64), empty, empty, empty
        self.again = np.zeros(0, bool)
        mer = min(MER, window // 2 + 1)
        width = window - mer + 1
        if len(words.start) < window:
            return
        hashes = word_hashes(words)
        mers = np.zeros(len(hashes) - mer + 1, np.uint64)
        for i in range(mer):
            mers = mers * _BASE + hashes[i : len(hashes) - mer + 1 + i]
        mers = mix(mers) & ~_LAST
        if len(frequent):
            mers = np.where(np.isin(mers, frequent), mers | _LAST, mers)
        least = _sliding(mers, width, np.minimum)
        doc = np.repeat(np.arange(len(words.count)), words.count)
        start = np.flatnonzero(doc[: len(least)] == doc[window - 1 :])
        if not len(start):
            return
        key = least[start]
        new = np.ones(len(start), bool)
        new[1:] = (key[1:] != key[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        # cut long runs
        nth = np.arange(len(start)) - np.repeat(first, np.diff(np.append(first, len(start))))
        first = np.flatnonzero(nth % MOST_WINDOWS == 0)
        self.key, self.at, self.doc = key[first], start[first], doc[start[first]]
        self.count = np.diff(np.append(first, len(start)))
        # places that are the minimiser of some window: no window around them has a larger minimum
        around = _sliding(np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)]), width, np.maximum)
        chosen = np.flatnonzero(around == mers)
        low = np.searchsorted(chosen, self.at)
        n = np.searchsorted(chosen, self.at + self.count + width - 1) - low
        same = mers[chosen[spans(low, n)]] == np.repeat(self.key, n)
        hits = np.zeros(len(n) + 1, np.int64)
        np.cumsum(same, out=(total := np.zeros(len(same) + 1, np.int64))[1:])
        np.cumsum(n, out=hits[1:])
        self.again = total[hits[1:]] - total[hits[:-1]] > 1

    def only(self, use: np.ndarray) -> Runs:
        """Keep some of the runs."""
        self.key, self.at, self.count, self.doc, self.again = self.key[use], self.at[use], self.count[use], self.doc[use], self.again[use]
        return self

    def packed(self, words: Words, window: int) -> pa.Array:
        """The words of each run as one string."""
        begin, end = words.start[self.at], words.end[self.at + self.count + window - 2]
        length = end - begin
        offsets = np.zeros(len(length) + 1, np.int32)
        np.cumsum(length, out=offsets[1:])
        return pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(words.data[spans(begin, length)])])


def _digests(packed: pa.Array) -> pa.Array:
    return pa.array([xxhash.xxh3_128_digest(x) for x in packed.to_pylist()], pa.binary())


def _signed(key: np.ndarray) -> pa.Array:
    return pa.array(key.view(np.int64))


def minimisers_again(texts: DataFrame, window: int, frequent: np.ndarray) -> Saved:
    """``key`` and ``n``: minimisers of more than one packed string, or that stand in one more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                runs = Runs(words_of(part["text"]), window, frequent)
                key, at = np.unique(runs.key, return_inverse=True)
                n = np.bincount(at, weights=1 + runs.again, minlength=len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([_signed(key), pa.array(n)], ["key", "n"])

    counts = texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return Saved(counts.filter(F.col("n") > 1), "minimisers")


def frequent_minimisers(counts: DataFrame) -> np.ndarray:
    """Minimisers of very many packed strings; a bounded number, see ``FREQUENT``."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.filter(F.col("n") > max(LEAST_FREQUENT, total * FREQUENT)).select("key").collect()
    return np.sort(np.array([r["key"] for r in rows], np.int64).view(np.uint64))


def bit_table(keys: DataFrame) -> np.ndarray:
    """A bit for each ``key``; the driver gets at most ``TABLE_WORDS`` words, in rows of ``ROW_WORDS``."""
    size = TABLE_WORDS.bit_length() - 1
    word = F.col("key").bitwiseAND(F.lit(TABLE_WORDS - 1))
    bit = F.shiftright("key", size).bitwiseAND(F.lit(63)).cast("int")
    words = keys.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits"))
    words = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).withColumn("row", F.expr(f"word div {ROW_WORDS}"))

    def fill(table: pa.Table) -> pa.RecordBatch:
        row, at = np.unique(table["row"].to_numpy(), return_inverse=True)
        dense = np.zeros((len(row), ROW_WORDS), np.int64)
        dense[at, table["word"].to_numpy() % ROW_WORDS] = table["bits"].to_numpy()
        return pa.RecordBatch.from_arrays([pa.array(row), pa.array([r.tobytes() for r in dense], pa.binary())], ["row", "dense"])

    out = np.zeros((TABLE_WORDS // ROW_WORDS, ROW_WORDS), np.uint64)
    for r in in_groups(words, "row", fill, "row long, dense binary", ROW_WORDS).collect():
        out[r["row"]] = np.frombuffer(r["dense"], np.uint64)
    return out.reshape(-1)


def marked(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the bit of each key is set."""
    size = np.uint64(len(table).bit_length() - 1)
    return (table[key & np.uint64(len(table) - 1)] >> ((key >> size) & np.uint64(63))) & np.uint64(1) == 1


def packed_runs(texts: DataFrame, window: int, frequent: np.ndarray, table: np.ndarray) -> DataFrame:
    """``key`` with a bit in ``table``, ``run`` (packed string), ``n`` (how often, added up within a part of a task), ``again``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words = words_of(part["text"])
                runs = Runs(words, window, frequent)
                runs = runs.only(marked(table, runs.key))
                packed = runs.packed(words, window).dictionary_encode()
                code = packed.indices.to_numpy()
                _, first = np.unique(code, return_index=True)
                n = np.bincount(code, minlength=len(first))
                yield pa.RecordBatch.from_arrays(
                    [_signed(runs.key[first]), packed.dictionary, pa.array(n), pa.array(runs.again[first])], ["key", "run", "n", "again"])

    return texts.mapInArrow(run, "key long, run binary, n long, again boolean")


def _classes(values: np.ndarray, count: int, offsets: list[int]) -> np.ndarray:
    """Classes of the tuples of values at some offsets."""
    length = len(values) - offsets[-1]
    if length <= 0:
        return np.zeros(0, np.int64)
    code = values[:length].copy()
    size = count
    for o in offsets[1:]:
        if size * count >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
            size = int(code.max()) + 1
        code = code * count + values[o : o + length]
        size *= count
    return np.unique(code, return_inverse=True)[1]


def window_classes(values: np.ndarray, window: int) -> np.ndarray:
    """Equal numbers for equal windows of values, by sorting."""
    done = 1
    while done < window:
        wide = min(window, 3 * done)
        offsets = [0, done, 2 * done] if wide == 3 * done else [0, wide - done] if wide <= 2 * done else [0, done, wide - done]
        values = _classes(values, int(values.max(initial=0)) + 1, offsets)
        done = wide
    return values


def repeated_parts(runs: DataFrame, window: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``digest`` of a packed string and ``low``, ``high``: words of it that repeated windows cover."""

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch["run"].dictionary_encode().indices.to_numpy()
            first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
            n = np.add.reduceat(batch["n"].to_numpy(), first) if len(first) else np.zeros(0, np.int64)
            kept = batch.take(pa.array(first))
            yield pa.RecordBatch.from_arrays([kept["key"], kept["run"], pa.array(n), kept["again"]], ["key", "run", "n", "again"])

    def count(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        key, n = table["key"].to_numpy(), table["n"].to_numpy()
        _, bucket, rows = np.unique(key, return_inverse=True, return_counts=True)
        use = (rows[bucket] > 1) | (n > 1) | table["again"].to_numpy()
        if not use.any():
            return None
        table = table.filter(pa.array(use)).combine_chunks()
        n, packed = table["n"].to_numpy(), table["run"].chunk(0)
        words = words_of(pa.Array.from_buffers(pa.string(), len(packed), packed.buffers(), offset=packed.offset))
        offsets = np.append(words.start, len(words.data)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(words.start), [None, pa.py_buffer(offsets), pa.py_buffer(words.data)]).dictionary_encode()
        kind = window_classes(coded.indices.to_numpy().astype(np.int64), window)
        windows = np.maximum(words.count - window + 1, 0)
        at = spans(words.first[:-1], windows)
        times = np.bincount(kind[at], weights=np.repeat(n, windows))
        again = at[times[kind[at]] > 1]
        if not len(again):
            return None
        # merge the words of neighbouring windows of a run
        run = np.searchsorted(words.first, again, side="right") - 1
        apart = np.r_[True, (again[1:] > again[:-1] + window) | (run[1:] != run[:-1])]
        first = np.flatnonzero(apart)
        last = np.append(first[1:], len(again)) - 1
        run = run[first]
        low, high = again[first] - words.first[run], again[last] + window - words.first[run]
        return pa.RecordBatch.from_arrays([_digests(packed.take(pa.array(run))), pa.array(low), pa.array(high)], ["digest", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(combined(batches), "key", bucket_rows):
            out = count(table)
            if out is not None:
                yield out

    dealt = runs.repartition("key").sortWithinPartitions("key", "run")
    return dealt.mapInArrow(run, "digest binary, low long, high long")


def run_places(texts: DataFrame, window: int, frequent: np.ndarray, table: np.ndarray) -> DataFrame:
    """``text_key``, ``digest`` of each of its packed strings, ``at`` (words before it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words = words_of(part["text"])
                runs = Runs(words, window, frequent)
                runs = runs.only(marked(table, runs.key))
                at = runs.at - words.first[runs.doc]
                yield pa.RecordBatch.from_arrays(
                    [part["text_key"].take(pa.array(runs.doc)), _digests(runs.packed(words, window)), pa.array(at)], ["text_key", "digest", "at"])

    return texts.mapInArrow(run, "text_key binary, digest binary, at long")


def kept_words(rows: DataFrame) -> DataFrame:
    """Texts without the words ``low`` to ``high`` of each of ``parts``: ``id``, ``n_words``, ``n_removed``, ``kept``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words = words_of(part["text"])
                parts = part["parts"]
                pairs = parts.flatten()
                n = parts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                base = np.repeat(words.first[:-1], n)
                edge = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(edge, base + pairs.field("low").to_numpy(), 1)
                np.add.at(edge, base + pairs.field("high").to_numpy(), -1)
                keep = np.cumsum(edge)[:-1] == 0
                length = (words.end - words.start + 1) * keep
                data = words.data[spans(words.start[keep], length[keep])].tobytes()
                ends = np.concatenate([[0], np.cumsum(length)])[words.first]
                kept = [data[a : b - 1].decode() if b > a else "" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                left = np.concatenate([[0], np.cumsum(keep)])[words.first]
                yield pa.RecordBatch.from_arrays(
                    [part["id"], pa.array(words.count), pa.array(words.count - np.diff(left)), pa.array(kept, pa.string())],
                    ["id", "n_words", "n_removed", "kept"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words long, n_removed long, kept string")


def remove_repeated_windows(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW,
                            bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``id_column``, ``n_words``, ``n_removed``, ``kept`` (the words that stay, joined by one space) of every row.

    A word goes if a window of ``window`` words over it also starts anywhere else,
    in the same document or another row.

    - A null or empty text has no words; a text shorter than a window keeps all.
    - Repeated rows are rows of their own, so their windows repeat. Null ids are ids like others.
    - Other columns are left out; no rows give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    body = F.coalesce(column(docs, text), F.lit(""))
    texts = docs.select(body.alias("text"))
    counts = minimisers_again(texts, window, np.zeros(0, np.uint64))
    frequent = frequent_minimisers(counts.df)
    if len(frequent):  # other minimisers take their place
        counts.discard()
        counts = minimisers_again(texts, window, frequent)
    table = bit_table(counts.df)
    counts.discard()
    release_shuffles(spark)
    found = Saved(repeated_parts(packed_runs(texts, window, frequent, table), window, bucket_rows), "repeated")
    release_shuffles(spark)
    key = F.unhex(F.md5("text"))
    places = run_places(texts.withColumn("text_key", key), window, frequent, table)
    parts = places.join(found.df, "digest").select("text_key", (F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.col("high")).alias("high"))
    parts = parts.distinct().groupBy("text_key").agg(F.collect_list(F.struct("low", "high")).alias("parts"))
    parts = Saved(parts, "parts")
    found.discard()
    release_shuffles(spark)
    rows = docs.select(column(docs, id_column).alias("id"), body.alias("text")).withColumn("text_key", key)
    rows = rows.join(parts.df, "text_key", "left").select("id", "text", "parts")
    return kept_words(rows).withColumnRenamed("id", id_column)
