"""Cross-entropy difference of a target and a background language model.

Both models are bigram models over one vocabulary, smoothed in the same way: the
background counts all documents, the target those with good labels.  A token's
loss is its negative log-probability; a document's score is the mean difference
of its losses, so low scores mark texts that are more like the target.

Every word and every bigram of the corpus counts, however rare; both are known by
64-bit hashes.  Most bigrams stand in the corpus once, and what such a one adds to
the loss follows from its two words and from whether its document is good.  So each
token gets the loss of a bigram that comes once, and bigrams that come again add
the difference to their own loss: only these are kept in a table, and single ones
meet nothing in the join.  Frequent words and bigrams (bounded lists) are sent to
every executor, the others are joined.  Which ones are on the lists changes no result.

Texts stay where they are (see ``flag_good`` for very many labels) and are cut into
words again in each pass.  Bigrams are counted and joined in ``PARTS`` shares of
their hashes, one after another, so only one share is on its way at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import EXCLUDED_BY
from ..operators.scope import LINK, OrderFilter, flag_scope, order_words, wrong_hits
from ..rules import LabColumns, ScopeRules
from ..sources.store import fits_broadcast
from .substrings import word_hashes
from .tables import Saved, column, small_batches
from .words import Words, mix, slices, words_of

#: Weight of a word's own probability after a context, in tokens, and added to each word's count.
CONTEXT_WEIGHT, WORD_WEIGHT = 50.0, 0.5
#: A bigram is frequent from this share of all tokens, so at most 500,000 are; a word from a quarter of it.
FREQUENT = 2e-6
SLICE_BYTES = 1 << 22
#: Shares of the bigrams that are counted and joined one after another.
PARTS = 2
#: Rows of bigrams that meet in one task, about.
TASK_ROWS = 1_000_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_PART_SHIFT = 33


def flag_good(docs: DataFrame, good: DataFrame) -> DataFrame:
    """Add ``good``: whether the ``id`` of a row is one of the distinct ``id`` of ``good``.

    Documents stay where they are: the ids are sent if they are few; otherwise a
    filter of them that has a size bound, and the other ids that pass it.  If these
    are too many too, only documents that pass the filter move.
    """
    roles = LabColumns(code="id", link="id", name=None)
    rules = ScopeRules(prefixes=())
    ids = Saved(good.select(F.col("id").cast("string").alias(LINK)), "good", lean=True)
    send, filtered = fits_broadcast(ids.df), None
    if not send:
        words = Saved(order_words(ids.df, ids.df.count()), "good-words", lean=True)
        others = Saved(wrong_hits(docs, roles, ids.df, words.df), "other-ids", lean=True)
        filtered = OrderFilter(words.df, others.df if fits_broadcast(others.df) else None)
    flagged = flag_scope(docs, roles, rules, ids.df, send, filtered)
    return flagged.withColumn("good", F.col(EXCLUDED_BY).isNotNull()).drop(EXCLUDED_BY)


def _ends(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word whether it is the first and whether it is the last of its text."""
    first, last = np.zeros(len(words.start), bool), np.zeros(len(words.start), bool)
    some = words.count > 0
    first[words.first[:-1][some]] = True
    last[words.first[1:][some] - 1] = True
    return first, last


def _bigrams(word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that follow another one in their text, and their bigrams."""
    at = np.flatnonzero(~first)
    return at, mix(word[at - 1] * _STEP + word[at] + np.uint64(1))


def _of_part(bigram: np.ndarray, part: int) -> np.ndarray:
    return (bigram >> np.uint64(_PART_SHIFT)) % np.uint64(PARTS) == part


def _good(part: pa.RecordBatch, words: Words) -> np.ndarray:
    """For each word whether its document is good."""
    return np.repeat(part["good"].to_numpy(zero_copy_only=False).astype(bool), words.count)


def count_words(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` in all texts, ``good`` in those of the target, ``after`` and ``good_after`` without the last words of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words = words_of(part["text"], lower_ascii=True)
                good, last = _good(part, words), _ends(words)[1]
                found, place = np.unique(word_hashes(words), return_inverse=True)
                counts = [np.bincount(place[some], minlength=len(found)) for some in (slice(None), good, ~last, good & ~last)]
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), *map(pa.array, counts)], NAMES)

    counted = docs.select("text", "good").mapInArrow(run, ", ".join(f"{name} long" for name in NAMES))
    return counted.groupBy("word").agg(*[F.sum(name).alias(name) for name in NAMES[1:]])


NAMES = ["word", "n", "good", "after", "good_after"]


def count_again(docs: DataFrame, part: int, tasks: int) -> DataFrame:
    """``bigram``, its second ``word``, ``n`` in all texts, ``good`` in those of the target: bigrams of a part that come twice or more."""
    names = ["bigram", "word", "n", "good"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                words = words_of(rows["text"], lower_ascii=True)
                word = word_hashes(words)
                at, bigram = _bigrams(word, _ends(words)[0])
                mine = _of_part(bigram, part)
                at = at[mine]
                found, first, place = np.unique(bigram[mine], return_index=True, return_inverse=True)
                good = np.bincount(place[_good(rows, words)[at]], minlength=len(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(word[at[first]].view(np.int64)),
                     pa.array(np.bincount(place, minlength=len(found))), pa.array(good)], names)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        bigram, word, n, good = (table[name].to_numpy() for name in names)
        order = np.argsort(bigram)
        bigram = bigram[order]
        first = np.flatnonzero(np.append(True, bigram[1:] != bigram[:-1]))
        n, good = np.add.reduceat(n[order], first), np.add.reduceat(good[order], first)
        again = n > 1
        first = first[again]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bigram[first], word[order[first]], n[again], good[again])], names)

    schema = ", ".join(f"{name} long" for name in names)
    return docs.select("text", "good").mapInArrow(run, schema).repartition(tasks, "bigram").mapInArrow(total, schema)


class Model:
    """Losses from counts, as columns or arrays: of the background, of the target in good documents, of the target in others."""

    def __init__(self, tokens: int, good_tokens: int, n_words: int):
        added = WORD_WEIGHT * n_words
        self.tokens, self.good_tokens = tokens + added, good_tokens + added

    def shares(self, n, good):
        return (n + WORD_WEIGHT) / self.tokens, (good + WORD_WEIGHT) / self.good_tokens

    def own(self, log, n, good) -> tuple:
        """What a word adds after another one, if their bigram comes once."""
        every, some = (CONTEXT_WEIGHT * share for share in self.shares(n, good))
        return -log(every + 1.0), -log(some + 1.0), -log(some)

    def first(self, log, n, good) -> tuple:
        """The loss of the first word of a text."""
        every, some = self.shares(n, good)
        return -log(every), -log(some), -log(some)

    def before(self, log, after, good_after) -> tuple:
        """What a word adds to the loss of the next one."""
        some = log(good_after + CONTEXT_WEIGHT)
        return log(after + CONTEXT_WEIGHT), some, some

    def again(self, log, n, good, word_n, word_good) -> tuple:
        """What a bigram adds that comes again."""
        every, some = (CONTEXT_WEIGHT * share for share in self.shares(word_n, word_good))
        once = self.own(log, word_n, word_good)
        return -log(n + every) - once[0], -log(good + some) - once[1], -log(good + some) - once[2]


def with_words(again: DataFrame, words: DataFrame, bar: float) -> DataFrame:
    """``bigram``, ``n``, ``good``, ``word_n``, ``word_good``; frequent words are sent, so no word makes a hot task."""
    counts = words.select("word", F.col("n").alias("word_n"), F.col("good").alias("word_good"))
    often = F.broadcast(counts.filter(F.col("word_n") >= bar))
    near = again.join(often, "word")
    far = again.join(often.select("word"), "word", "left_anti").join(counts.filter(F.col("word_n") < bar), "word")
    return near.unionByName(far).drop("word")


def _losses(values: tuple) -> list[Column]:
    return [value.alias(name) for value, name in zip(values, LOSSES, strict=True)]


LOSSES = ["background", "good_target", "other_target"]


class Listed:
    """A sorted list of hashes; ``start`` has the place of the first one of each slot of leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, np.uint64(0))  # the last one is never met
        bits = len(keys).bit_length() + 2
        self.shift = np.uint64(64 - bits)
        self.start = np.append(np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift), len(keys)).astype(np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys, and which are there."""
        slot = keys >> self.shift
        place, upto = self.start[slot], self.start[slot + np.uint64(1)]
        there = (self.keys[place] == keys) & (place < upto)
        more = np.flatnonzero(~there & (upto - place > 1))
        if len(more):
            place[more] = np.searchsorted(self.keys[:-1], keys[more])
            there[more] = self.keys[place[more]] == keys[more]
        return place, there & (place < upto)


def _arrays(table: pa.Table) -> list[np.ndarray]:
    """Columns of a collected table, sorted by the first one, which holds hashes."""
    key, *others = (table[name].to_numpy() for name in table.column_names)
    order = np.argsort(key.view(np.uint64))
    return [key.view(np.uint64)[order], *[values[order] for values in others]]


def document_words(docs: DataFrame, words: pa.Table, bigrams: pa.Table, model: Model) -> DataFrame:
    """Rows of documents and of their rare words.

    A row of a document has ``doc``, ``id``, ``n_tokens`` and the sums of what its frequent
    words and bigrams add; a row of a rare word has ``doc``, ``word``, and whether
    the word is the first or the last of the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast((_arrays(words), _arrays(bigrams)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (often, n, good, after, good_after), (frequent, *adds) = shared.value
        own, start, before = model.own(np.log, n, good), model.first(np.log, n, good), model.before(np.log, after, good_after)
        inside = [a + b for a, b in zip(own, before, strict=True)]
        begins = [a - b for a, b in zip(start, own, strict=True)]
        often, frequent = Listed(often), Listed(frequent)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                cut = words_of(part["text"], lower_ascii=True)
                word = word_hashes(cut)
                first, last = _ends(cut)
                doc = np.repeat(np.arange(len(cut.count)), cut.count)
                place, known = often.find(word)
                at, bigram = _bigrams(word, first)
                spot, there = frequent.find(bigram)
                sums = [np.zeros(len(cut.count)) for _ in LOSSES]  # the background, the target if the document is good, and if not
                # a word inside a text, what is other at its ends, and bigrams
                for of, where, values in ((known, place, inside), (known & first, place, begins), (known & last, place, [-x for x in before]), (there, spot, adds)):
                    of = np.flatnonzero(of)
                    where, text = where[of], doc[at[of]] if values is adds else doc[of]
                    for total, value in zip(sums, values, strict=True):
                        total += np.bincount(text, value[where], len(total))
                target = np.where(part["good"].to_numpy(zero_copy_only=False).astype(bool), sums[1], sums[2])
                rare = np.flatnonzero(~known)
                none, no_word = len(rare), len(cut.count)
                yield pa.RecordBatch.from_arrays(
                    [part["doc"], part["id"], pa.array(cut.count), pa.array(sums[0]), pa.array(target), pa.nulls(no_word, pa.int64()),
                     pa.nulls(no_word, pa.bool_()), pa.nulls(no_word, pa.bool_())], ROW)
                yield pa.RecordBatch.from_arrays(
                    [part["doc"].take(pa.array(doc[rare])), pa.nulls(none, part["id"].type), pa.nulls(none, pa.int64()), pa.nulls(none, pa.float64()),
                     pa.nulls(none, pa.float64()), pa.array(word[rare].view(np.int64)), pa.array(first[rare]), pa.array(last[rare])], ROW)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("doc", "id", "text", "good").mapInArrow(
        run, f"doc long, id {kind}, n_tokens long, background double, target double, word long, first boolean, last boolean")


ROW = ["doc", "id", "n_tokens", "background", "target", "word", "first", "last"]


def document_bigrams(docs: DataFrame, bigrams: pa.Table, part: int) -> DataFrame:
    """``doc``, ``bigram``: a row for each bigram of a part in a text that is not on the list."""
    shared = docs.sparkSession.sparkContext.broadcast(_arrays(bigrams.select(["bigram"])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Listed(shared.value[0])
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                words = words_of(rows["text"], lower_ascii=True)
                at, bigram = _bigrams(word_hashes(words), _ends(words)[0])
                mine = np.flatnonzero(_of_part(bigram, part))
                mine = mine[~frequent.find(bigram[mine])[1]]
                doc = np.repeat(np.arange(len(words.count)), words.count)[at[mine]]
                yield pa.RecordBatch.from_arrays([rows["doc"].take(pa.array(doc)), pa.array(bigram[mine].view(np.int64))], ["doc", "bigram"])

    return docs.select("doc", "text").mapInArrow(run, "doc long, bigram long")


def _sums(rows: DataFrame, name: str, background: Column, target: Column) -> Saved:
    """Sums of a document, whether it comes once or more."""
    return Saved(rows.groupBy("doc").agg(F.sum(background).alias("background"), F.sum(target).alias("target")), name, lean=True)


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, good: str = "quality = 1 and toxic = 0", id_column: str = "doc_id",
                             text: str = "text", frequent: float = FREQUENT) -> DataFrame:
    """``id_column``, ``n_tokens``, ``target_loss``, ``background_loss``, ``difference`` of every row.

    The target is made of the documents whose id has a row in ``labels`` for which ``good`` holds.

    - A null or empty text has no tokens and null losses.
    - A null id has no label; of several labels one good one is enough; repeated rows count repeatedly.
    - Without good labels all words are alike to the target.
    - Other columns are left out; no rows give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(column(docs, id_column).alias("id"), column(docs, text).alias("text"))
    chosen = labels.filter(good).select(column(labels, id_column).alias("id")).filter("id is not null").distinct()
    # rows of one id and text share a key and a score; the last bit of the key tells whether the document is good
    key = F.xxhash64("id", F.lit(0), "text").bitwiseAND(F.lit(-2)).bitwiseOR(F.col("good").cast("long"))
    flagged = flag_good(rows, chosen).withColumn("doc", key)
    is_good = F.col("doc").bitwiseAND(F.lit(1)) == 1

    words = Saved(count_words(flagged), "words", lean=True)
    total = words.df.agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.count(F.lit(1)).alias("words")).first()
    tokens = total["n"] or 0
    model = Model(tokens, total["good"] or 0, total["words"])
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // (PARTS * TASK_ROWS)))
    word_bar, bar = max(2.0, frequent / 4 * tokens), max(2.0, frequent * tokens)
    often = words.df.filter(F.col("n") >= word_bar).toArrow()  # at most 4 / frequent rows

    counted = [Saved(count_again(flagged, part, tasks), "bigrams", lean=True) for part in range(PARTS)]
    again = Saved(with_words(reduce(DataFrame.unionByName, [c.df for c in counted]), words.df, word_bar), "again", lean=True)
    for each in counted:
        each.discard()
    added = again.df.select("bigram", "n", *_losses(model.again(F.log, *map(F.col, ("n", "good", "word_n", "word_good")))))
    listed = added.filter(F.col("n") >= bar).select("bigram", *LOSSES).toArrow()  # at most 1 / frequent rows

    found = Saved(document_words(flagged, often, listed, model), "documents", lean=True)
    n, of_good, after, good_after = map(F.col, ("n", "of_good", "after", "good_after"))
    rare = words.df.withColumnRenamed("good", "of_good").filter(n < word_bar)
    met = found.df.filter(F.col("word").isNotNull()).select("doc", "word", "first", "last").repartition(tasks, "word").join(
        rare.repartition(tasks, "word").hint("shuffle_hash"), "word")
    own, first, before = model.own(F.log, n, of_good), model.first(F.log, n, of_good), model.before(F.log, after, good_after)
    value = [F.when(F.col("first"), first[i]).otherwise(own[i]) + F.when(F.col("last"), 0.0).otherwise(before[i]) for i in range(3)]
    sums = [_sums(met, "rare-words", value[0], F.when(is_good, value[1]).otherwise(value[2]))]
    words.discard()
    for part in range(PARTS):
        mine = F.pmod(F.shiftrightunsigned("bigram", _PART_SHIFT), F.lit(PARTS)) == part
        theirs = added.filter(mine & (F.col("n") < bar)).drop("n").repartition(tasks, "bigram")
        met = document_bigrams(flagged, listed, part).repartition(tasks, "bigram").join(theirs.hint("shuffle_hash"), "bigram")
        target = F.when(is_good, F.col("good_target")).otherwise(F.col("other_target"))
        sums.append(_sums(met, "rare-bigrams", F.col("background"), target))
    again.discard()

    every = found.df.filter(F.col("n_tokens").isNotNull()).select("doc", "id", "n_tokens", "background", "target")
    more = reduce(DataFrame.unionByName, [s.df for s in sums]).groupBy("doc").agg(
        F.sum("background").alias("rare_background"), F.sum("target").alias("rare_target"))
    copies = every.groupBy("doc").agg(F.count(F.lit(1)).alias("copies"))
    scored = every.join(more.join(copies, "doc"), "doc", "left")

    def mean(name: str) -> Column:
        whole = F.col(name) + F.coalesce(F.col(f"rare_{name}") / F.col("copies"), F.lit(0.0))
        return F.when(F.col("n_tokens") > 0, whole / F.col("n_tokens")).alias(f"{name}_loss")

    scored = scored.select("id", "n_tokens", mean("target"), mean("background"))
    return scored.select(
        F.col("id").alias(id_column), "n_tokens", "target_loss", "background_loss", (F.col("target_loss") - F.col("background_loss")).alias("difference"))
