"""Pack tokenized documents into sequences by minimum bin slack.

A bin is filled by a subset-sum program over the lengths that are left: a bitset
holds the reachable sums, the fullest one is taken, and its pieces are removed.
Pieces of one length are alike, so the program works on the number of pieces of
each length: a table with one entry for each length up to the capacity, whatever
the corpus.  A combination is used as often as its lengths last.  Which piece
gets which place is worked out on Spark from its rank among those of its length.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Saved, column, running_total, small_batches
from .words import slices, spans, words_of

CAPACITY = 2048
#: Text that is tokenized at a time.
SLICE_BYTES = 1 << 21
#: Distinct words whose ids a task remembers before it starts anew.
KNOWN_WORDS = 500_000
#: Words of lower-case letters that no normalization touches, with the space after them; so many are tokenized as one text.
PLAIN, TOGETHER = re.compile("[a-zß-öø-ÿ]+ "), 400

#: ASCII punctuation that begins a new word after an ASCII letter.  The vocabulary cuts there too; the signs
#: of its special tokens and the apostrophe, which can belong to the letters after it, need no rule of their own.
_SIGNS = np.zeros(256, bool)
_SIGNS[[ord(c) for c in "!#$%&()*+,-./:;=?@[]^_`{}~"]] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True


class WordIds:
    """Ids of words, each distinct word tokenized once.

    The vocabulary cuts texts at white space and between letters and other signs,
    and nothing it does reaches across, so the ids of a text are those of its words.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.offsets = array("I"), array("q", [0])

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of each word, and the offsets and ids of all known words."""
        if len(self.known) > KNOWN_WORDS:
            self.clear()
        known = self.known
        places = [known.get(w, -1) for w in words]
        new = [i for i, p in enumerate(places) if p < 0]
        plain = [i for i in new if PLAIN.fullmatch(words[i])]
        rest = [i for i in new if not PLAIN.fullmatch(words[i])]
        for at in range(0, len(plain), TOGETHER):
            some = plain[at : at + TOGETHER]
            coded = np.array(self.encode(["".join([words[i] for i in some])])[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends[coded]) + 1
            if len(ends) != len(some) or ends[-1] != len(coded):  # the vocabulary does not mark where words end
                rest += some
                continue
            for i in some:
                places[i] = known[words[i]] = len(known)
            self.offsets.extend((ends + len(self.ids)).tolist())
            self.ids.frombytes(coded.tobytes())
        for i, coded in zip(rest, self.encode([words[i] for i in rest])):
            places[i] = known[words[i]] = len(known)
            self.ids.extend(coded.ids)
            self.offsets.append(len(self.ids))
        return np.array(places, np.int64), np.array(self.offsets, np.int64), np.array(self.ids, np.uint32)

    def encode(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)


def word_cuts(data: np.ndarray) -> np.ndarray:
    cut = np.zeros(len(data), bool)
    cut[1:] = _LETTERS[data[:-1]] & _SIGNS[data[1:]]
    return cut


def lower_letters(data: np.ndarray) -> None:
    """Turn A to Z into lower case in place, as the vocabulary does: not before a byte that may combine with them."""
    alone = np.ones(len(data), bool)
    alone[:-1] = data[1:] < 128
    data[(data >= 65) & (data <= 90) & alone] += 32


def encode(texts: pa.Array, coder: WordIds, end: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, each followed by ``end``, and the offsets of each text."""
    words = words_of(texts, cuts=word_cuts)
    if b"<|" not in words.data.tobytes():
        lower_letters(words.data)
    n = len(words.start)
    offsets = np.append(words.start, len(words.data)).astype(np.int32)
    coded = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(words.data)]).dictionary_encode()
    places, at, ids = coder(coded.dictionary.to_pylist())
    place = places[coded.indices.to_numpy()]
    count = at[place + 1] - at[place]
    total = np.zeros(n + 1, np.int64)
    np.cumsum(count, out=total[1:])
    per_text = total[words.first[1:]] - total[words.first[:-1]]
    out = np.full(len(per_text) + int(total[-1]), end, np.uint32)
    out[np.arange(int(total[-1])) + np.repeat(np.arange(len(per_text)), per_text)] = ids[spans(at[place], count)]
    offsets = np.zeros(len(per_text) + 1, np.int64)
    np.cumsum(per_text + 1, out=offsets[1:])
    return out, offsets


PIECES = "piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document: ``id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked, ``ids``."""
    from tokenizers import Tokenizer

    # of a fixed size: the vocabulary file
    shared = docs.sparkSession.sparkContext.broadcast(Tokenizer.from_file(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        coder = WordIds(shared.value)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, offsets = encode(part["text"], coder)
                n = np.diff(offsets)
                cuts = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), cuts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start = piece * capacity
                length = np.minimum(n[doc] - start, capacity)
                begin = offsets[:-1][doc] + start
                raw = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * b : 4 * (b + s)]) for b, s in zip(begin.tolist(), length.tolist())]
                out = [part["id"].take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    bounds = np.append(begin, len(ids)).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    small_batches(docs.sparkSession)
    rows = docs.select(column(docs, id_column).alias("id"), column(docs, text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, {PIECES}" + ", ids array<int>" * with_ids)


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """Lengths and how often each, for the largest sum up to ``room``; larger lengths are tried first."""
    reach, mask, steps = 1, (1 << room + 1) - 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left:
            copies = min(copies, left)
            steps.append((length, copies, reach))
            reach |= reach << length * copies & mask
            left -= copies
            copies *= 2
        if reach >> room:
            break
    total = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, copies, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + copies
            total -= length * copies
    return sorted(used.items(), reverse=True)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Combinations of lengths and the number of bins of each.

    Each bin takes the longest piece that is left and the fullest combination of
    the others beside it.
    """
    counts = {x: n for x, n in histogram.items() if n}
    plan = []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        beside = dict(fullest(counts, capacity - longest))
        counts[longest] += 1
        beside[longest] = beside.get(longest, 0) + 1
        times = min(counts[x] // n for x, n in beside.items())
        for x, n in beside.items():
            counts[x] -= n * times
            if not counts[x]:
                del counts[x]
        plan.append((sorted(beside.items(), reverse=True), times))
    return plan


def pack_pieces(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length``; ``order`` names all columns that tell pieces apart."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    # for each length the first rank of each combination that uses it, and what follows from it
    ranks: dict[int, int] = dict.fromkeys(histogram, 0)
    table, bin_ = [], 0
    for combination, times in plan_bins(histogram, capacity):
        offset = 0
        for length, copies in combination:
            table.append((length, ranks[length], copies, bin_, offset))
            ranks[length] += copies * times
            offset += length * copies
        bin_ += times
    table.sort()
    # bounded by the capacity: some thousand combinations of lengths
    shared = spark.sparkContext.broadcast(np.array(table, np.int64).reshape(-1, 5))
    sizes = spark.createDataFrame([(int(x), int(n)) for x, n in histogram.items()], "length long, _n long")
    ranked = running_total(pieces.withColumn("_one", F.lit(1)).join(F.broadcast(sizes), "length"), "length", "_one", order, "_rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, copies, bin_, offset = shared.value.T
        key = length << np.int64(44) | first
        for batch in batches:
            size, rank = batch["length"].to_numpy(), batch["_rank"].to_numpy()
            at = np.searchsorted(key, size << np.int64(44) | rank, side="right") - 1
            turn = rank - first[at]
            rest = [c for c in batch.schema.names if c != "_rank"]
            columns = [batch[c] for c in rest]
            columns += [pa.array(bin_[at] + turn // copies[at]), pa.array(offset[at] + turn % copies[at] * size)]
            yield pa.RecordBatch.from_arrays(columns, [*rest, "sequence_id", "offset"])

    ranked = ranked.drop("_one")
    long = F.lit(0).cast("long")
    schema = ranked.drop("_rank").withColumn("sequence_id", long).withColumn("offset", long).schema
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """``id_column``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` of every piece.

    - A null or empty text is one piece of length 1, the closing id.
    - Null and repeated ids are ids like others; repeated rows are packed one by one.
    - Other columns are left out; no rows give no rows.
    """
    pieces = Saved(token_pieces(docs, tokenizer_path, id_column, text, capacity), "pieces")
    packed = pack_pieces(pieces.df, ["id", "piece", "start", "length", "ids_crc32"], capacity)
    return packed.select(
        F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def token_sequences(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text: str = "text",
                    capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids``."""
    pieces = Saved(token_pieces(docs, tokenizer_path, id_column, text, capacity, with_ids=True), "pieces")
    packed = pack_pieces(pieces.df, ["id", "piece", "start", "length", "ids_crc32"], capacity)
    runs = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("runs"))
    return runs.select("sequence_id", F.flatten(F.transform("runs", lambda r: r["ids"])).alias("ids"))
