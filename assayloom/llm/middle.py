"""Fill-in-middle documents: prefix and suffix first, the middle last.

A text is a sequence of units (a run of letters, or any other code point) and is
cut after two unit counts.  To find the cuts, the text is seen as blocks of a fixed
number of bytes.  A Fenwick tree over the blocks holds the units and the code
points that start in each; a binary-lifting descent finds the block that holds a
cut, and only that block is searched for the exact place.

Texts stay whole and are never moved between tasks.  Only the two places come back
from Python; texts are put together by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .tables import column, small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of a block.
BLOCK_BYTES = 512


class FenwickTree:
    """Prefix sums of two counts over blocks; entry ``i`` covers the blocks of its lowest set bit."""

    def __init__(self, units: np.ndarray, chars: np.ndarray):
        self.tree = np.zeros((len(units) + 1, 2), np.int64)
        self.tree[1:, 0], self.tree[1:, 1] = units, chars
        step = 1
        while 2 * step < len(self.tree):
            # entries of the next level take in the entry in the middle of their range
            at = np.arange(2 * step, len(self.tree), 2 * step)
            self.tree[at] += self.tree[at - step]
            step *= 2

    def descend(self, units: int) -> tuple[int, int, int]:
        """Most leading blocks that hold at most ``units`` units: their number, units left over, their code points."""
        at, chars = 0, 0
        step = 1 << (len(self.tree).bit_length() - 1)
        while step:
            to = at + step
            if to < len(self.tree) and self.tree[to, 0] <= units:
                at, units, chars = to, units - int(self.tree[to, 0]), chars + int(self.tree[to, 1])
            step >>= 1
        return at, units, chars


class Units:
    """Starts of units and of code points in the bytes of one text."""

    def __init__(self, text: np.ndarray, block: int = BLOCK_BYTES):
        letter = ((text | 32) - np.uint8(97)) < 26
        self.block = block
        self.chars = (text & 0xC0) != 0x80
        self.starts = self.chars & ~letter
        self.starts[:1] |= letter[:1]
        self.starts[1:] |= letter[1:] & ~letter[:-1]
        self.count, self.length = int(self.starts.sum()), int(self.chars.sum())
        edges = np.arange(0, len(text), block)
        self.tree = FenwickTree(*(np.add.reduceat(mask, edges, dtype=np.int64) if len(text) else edges
                                  for mask in (self.starts, self.chars)))

    def chars_before(self, units: int) -> int:
        """Code points of the first so many units."""
        if units >= self.count:
            return self.length
        block, rest, chars = self.tree.descend(units)
        low = block * self.block
        inside = self.starts[low : low + self.block]
        place = np.flatnonzero(inside)[rest]
        return chars + int(self.chars[low : low + place].sum())


def text_bytes(texts: pa.Array) -> Iterator[np.ndarray]:
    """Bytes of each text, without a copy; a null text has none."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide, len(texts) + 1 + texts.offset)[texts.offset :]
    data = texts.buffers()[2]
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    valid = texts.is_valid().to_numpy(zero_copy_only=False)
    for low, high, there in zip(offsets[:-1].tolist(), offsets[1:].tolist(), valid.tolist()):
        yield every[low:high] if there else every[:0]


_PLACES = StructType([StructField(name, LongType()) for name in ("n", "first", "second")])


@F.arrow_udf(_PLACES)
def cut_places(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    """Units of a text, and the code points before the smaller and the larger of two random cuts."""
    out = np.zeros((3, len(texts)), np.int64)
    for i, (text, a, b) in enumerate(zip(text_bytes(texts), one.to_pylist(), two.to_pylist())):
        units = Units(text)
        low, high = sorted((a % (units.count + 1), b % (units.count + 1)))
        out[:, i] = units.count, units.chars_before(low), units.chars_before(high)
    return pa.StructArray.from_arrays([pa.array(x) for x in out], ["n", "first", "second"])


def _draw(digest: Column, turn: int) -> Column:
    return F.conv(F.substring(digest, 8 * turn - 7, 8), 16, 10).cast("long")


def fill_in_middle(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: str = "1",
                   plain_percent: int = 10, suffix_first_percent: int = 20, keep: list[str] | None = None) -> DataFrame:
    """``id_column``, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output`` of every row.

    ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle)
    or ``plain`` for a text that stays as it is: some of all, those without a
    character, and those in which one of the marks occurs.  Cuts and form come
    from a digest of the id, so reruns agree and rows of one id and text agree.

    - A null text is an empty one; a null id is hashed as an empty text.
    - Units count in code points: a run of ASCII letters, or any other code point.
    - ``prefix_chars`` and ``middle_chars`` are null where the form is plain.
    - Repeated rows each give a row; columns in ``keep`` are passed on, others are left out.
    - No rows give no rows.
    """
    small_batches(documents.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(column(documents, id_column).cast("string"), F.lit(""))), 256)
    rows = documents.select(
        column(documents, id_column).alias("_id"), F.coalesce(column(documents, text_column), F.lit("")).alias("_text"),
        digest.alias("_digest"), *[column(documents, c).alias(f"_keep_{c}") for c in keep or []])
    rows = rows.withColumns({f"_h{i}": _draw(F.col("_digest"), i) for i in (1, 2, 3, 4)})
    text = F.col("_text")
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | marked | (F.col("_h3") % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.col("_h4") % 100 < suffix_first_percent, "spm").otherwise("psm")
    rows = rows.select("*", form.alias("_form"), cut_places("_text", "_h1", "_h2").alias("_cut"))
    first, second = F.col("_cut.first").cast("int"), F.col("_cut.second").cast("int")
    prefix = F.substring(text, F.lit(1), first)
    middle = F.substring(text, first + 1, second - first)
    suffix = F.substring(text, second + 1, F.length(text))
    output = (
        F.when(F.col("_form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col("_form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(text)
    )
    cut = F.col("_form") != "plain"
    return rows.select(
        F.col("_id").alias(id_column), F.col("_cut.n").alias("n"), F.col("_form").alias("form"),
        F.when(cut, F.col("_cut.first")).alias("prefix_chars"),
        F.when(cut, F.col("_cut.second") - F.col("_cut.first")).alias("middle_chars"),
        output.alias("output"), *[F.col(f"`_keep_{c}`").alias(c) for c in keep or []])


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from.

    No mark occurs in the text, and a mark can not begin inside another one, so
    each mark is found where it was put.
    """
    def between(left: str, right: str | None) -> Column:
        tail = F.substring_index(output, left, -1)
        return F.substring_index(tail, right, 1) if right else tail

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
