"""Words of many texts at once, as positions in one buffer of bytes.

A word is a run of bytes other than space and 0x09 to 0x0D, so positions in
UTF-8 bytes and in code points cut the same words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The same words for the regular expressions of Spark.
WORD = r"[^\x20\x09-\x0D]+"


@dataclass
class Words:
    """Words of texts: word ``i`` is ``data[start[i]:end[i]]``, text ``d`` has the words ``first[d]`` to ``first[d + 1]``.

    Words of a text are separated by exactly one space in ``data``.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, null as empty, and the offsets of each."""
    texts = pc.fill_null(texts, pa.scalar("", texts.type))
    size = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], size)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, lower_ascii: bool = False, cuts: Callable[[np.ndarray], np.ndarray] | None = None) -> Words:
    """Cut texts into words; ``lower_ascii`` turns A to Z into lower case.

    ``cuts`` may mark further bytes where a new word begins.
    """
    data, offsets = utf8(texts)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    solid = ~blank
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True  # the first byte of a text follows nothing
    begins = solid.copy()
    begins[1:] &= blank[:-1] | fresh[1:-1]
    ends = solid.copy()
    ends[:-1] &= blank[1:] | fresh[1:-1]
    if cuts is not None:
        more = cuts(data) & solid & ~begins
        begins |= more
        ends[:-1] |= more[1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    length = end - start
    new_start = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length + 1, out=new_start[1:])
    out = np.full(new_start[-1], 32, np.uint8)
    out[np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)] = data[solid]
    if lower_ascii:
        out[(out >= 65) & (out <= 90)] += 32
    return Words(out, new_start[:-1], new_start[:-1] + length, first)


def slices(batch: pa.RecordBatch, text: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has at most ``most_bytes`` of text, or one row."""
    if not batch.num_rows:
        return
    length = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(length)
    at = 0
    while at < batch.num_rows:
        upto = total[at] - length[at] + most_bytes
        to = max(at + 1, int(np.searchsorted(total, upto, side="right")))
        yield batch.slice(at, to - at)
        at = to


def spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions of the spans, one span after another."""
    begin = np.cumsum(length) - length
    return np.arange(int(length.sum())) + np.repeat(start - begin, length)


#: Odd multipliers of a well-known 64-bit finalizer.
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))
