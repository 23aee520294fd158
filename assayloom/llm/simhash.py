"""Near duplicates by SimHash, found with Burkhard-Keller trees.

A text's fingerprint has a bit set where over half of its shingle hashes have
it set.  Fingerprints are dealt to shards by blocks of their bits: if two differ
in at most ``radius`` bits, and there are more blocks than that, they agree in a
whole block and meet in its shard.  Each shard is a tree whose children are keyed
by their Hamming distance to the parent; a query follows the edges within the
radius of its own distance only (triangle inequality).  A tree is built where its
shard is read and goes to the queries of that shard, not to every executor: the
trees of all shards grow with the corpus and have no size bound for a broadcast.

Wide fingerprints (several 64-bit words, remixed from the same shingle hashes)
measure the cosine of the shingle sets, hence their similarity, closely.  For
them the blocks find a pair with high probability instead of surely.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Saved, block_pairs, column, connected_components, in_groups, small_batches
from .words import Words, mix, slices, words_of

#: Text that is turned into numbers at a time.
SLICE_BYTES = 1 << 19
#: Fingerprints of a tree; larger shards are cut into several trees.
TREE_ROWS = 20_000
#: Pairs of query and node that are looked at together.
FRONTIER = 1 << 19

# byte -> its eight bits, one in each byte of a 64-bit number, first bit first
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).copy().view(np.uint64)[:, 0]


def shingle_hashes(words: Words, size: int, repeats: bool) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of each run of ``size`` words, a shorter text as one run; offsets by text."""
    n = words.count
    runs = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    first = np.zeros(len(n) + 1, np.int64)
    np.cumsum(runs, out=first[1:])
    text = np.repeat(np.arange(len(n)), runs)
    begin = words.first[:-1][text] + np.arange(first[-1]) - first[:-1][text]
    last = np.minimum(begin + size, words.first[1:][text]) - 1
    data, digest = words.data.tobytes(), xxhash.xxh64_intdigest
    pairs = zip(words.start[begin].tolist(), words.end[last].tolist())
    hashes = np.fromiter((digest(data[s:e], 42) for s, e in pairs), np.uint64, int(first[-1]))
    if not repeats and len(hashes):
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        hashes = hashes[new]
        np.cumsum(np.bincount(text[new], minlength=len(n)), out=first[1:])
    return hashes, first


def fingerprints(hashes: np.ndarray, first: np.ndarray, words: int) -> np.ndarray:
    """Majority bits of the hashes of each text, as ``8 * words`` bytes; no hash: all zero."""
    n = np.diff(first)
    out = np.zeros((len(n), 8 * words), np.uint8)
    if not len(hashes):
        return out
    # at most 255 hashes are added in a byte, then the sums of such runs
    cuts = -(-n // 255)
    text = np.repeat(np.arange(len(n)), cuts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    at = first[text] + 255 * nth
    some = np.flatnonzero(n)
    for w in range(words):
        h = hashes if w == 0 else mix(hashes + np.uint64((w * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        each = h.astype(">u8").view(np.uint8).reshape(-1, 8)
        sums = np.add.reduceat(_SPREAD[each], at, axis=0).view(np.uint8).reshape(len(at), 64).astype(np.int64)
        ones = np.add.reduceat(sums, (np.cumsum(cuts) - cuts)[some], axis=0)
        out[some, 8 * w : 8 * w + 8] = np.packbits(2 * ones > n[some, None], axis=1)
    return out


def with_fingerprint(docs: DataFrame, text: str, name: str, shingle: int, repeats: bool = True, words: int = 1) -> DataFrame:
    """Add the fingerprint of ``text`` as binary column ``name``; other columns pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                cut = words_of(part.column(text), lower_ascii=True)
                prints = fingerprints(*shingle_hashes(cut, shingle, repeats), words)
                rest = [c for c in part.schema.names if c != text]
                data = pa.array([x.tobytes() for x in prints], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), data], [*rest, name])

    small_batches(docs.sparkSession)
    schema = docs.drop(text).withColumn(name, F.lit(None).cast("binary")).schema
    return docs.mapInArrow(run, schema)


def tree_links(prints: np.ndarray, shard: np.ndarray, radius: int) -> np.ndarray:
    """Fingerprints (rows of 64-bit words) joined by distances up to ``radius`` within their shard.

    ``shard`` numbers the shard of each row.  Returns for each row the first row
    of its component.  All trees are built and searched together, level by level.
    """
    count, width = len(prints), 64 * prints.shape[1] + 1

    def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1, dtype=np.int64)

    _, root = np.unique(shard, return_index=True)
    root = root[np.searchsorted(shard[root], shard)] if np.all(shard[:-1] <= shard[1:]) else _first_of(shard)
    # build: a row walks down from its root, the first one on a free edge becomes the child there
    edges, children = [], []
    row = np.flatnonzero(root != np.arange(count))
    at = root[row]
    while len(row):
        edge = at * width + distance(row, at)
        free, chosen, where = np.unique(edge, return_index=True, return_inverse=True)
        edges.append(free)
        children.append(row[chosen])
        at = row[chosen][where]
        stay = at != row
        row, at = row[stay], at[stay]
    edge = np.concatenate(edges) if edges else np.zeros(0, np.int64)
    child = np.concatenate(children) if children else np.zeros(0, np.int64)
    order = np.argsort(edge)
    edge, child = edge[order], child[order]

    label = np.arange(count)
    todo = [(np.arange(count)[i : i + FRONTIER], root[i : i + FRONTIER]) for i in range(0, count, FRONTIER)]
    while todo:
        query, node = todo.pop()
        d = distance(query, node)
        _join(label, query[d <= radius], node[d <= radius])
        low = np.searchsorted(edge, node * width + np.maximum(d - radius, 0))
        high = np.searchsorted(edge, node * width + np.minimum(d + radius, width - 1), side="right")
        n = high - low
        # the next level in parts of bounded size, last part first
        ends = np.cumsum(n)
        i = 0
        while i < len(n):
            j = max(i + 1, int(np.searchsorted(ends, ends[i] - n[i] + FRONTIER, side="right")))
            if n[i:j].any():
                step = np.arange(int(n[i:j].sum())) + np.repeat(low[i:j] - (np.cumsum(n[i:j]) - n[i:j]), n[i:j])
                todo.append((np.repeat(query[i:j], n[i:j]), child[step]))
            i = j
    return label


def _first_of(shard: np.ndarray) -> np.ndarray:
    _, first, where = np.unique(shard, return_index=True, return_inverse=True)
    return first[where]


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the components of a and b; a label is the first row of its component."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def fingerprint_links(prints: DataFrame, radius: int, words: int = 1, block_bits: int | None = None,
                      tree_rows: int = TREE_ROWS) -> DataFrame:
    """Links ``a``, ``b`` that connect the fingerprints within ``radius`` of each other.

    ``prints`` has one column ``print``, distinct.  Without ``block_bits`` the
    bits are cut into ``radius + 1`` blocks and no pair is missed.  Links are
    those of a spanning forest of each shard, not all pairs.
    """
    bits = 64 * words
    size = block_bits or bits // (radius + 1)
    blocks = bits // size if block_bits else radius + 1
    bounds = [(i * size, bits if i == blocks - 1 and not block_bits else (i + 1) * size) for i in range(blocks)]
    long = [F.conv(F.hex(F.substring("print", 8 * w + 1, 8)), 16, -10).cast("long") for w in range(words)]

    def block(low: int, high: int):
        """Bits low to high of the print, counted from its first bit, across at most two words."""
        key, at = F.lit(0).cast("long"), low
        while at < high:
            word, to = at // 64, min(high, (at // 64 + 1) * 64)
            part = F.shiftrightunsigned(long[word], 64 * (word + 1) - to).bitwiseAND((1 << (to - at)) - 1 if to - at < 64 else -1)
            key, at = F.shiftleft(key, to - at) + part, to
        return key

    keys = F.array(*[F.xxhash64(F.lit(i), block(*b)) for i, b in enumerate(bounds)])
    rows = prints.select("print", F.explode(keys).alias("shard"))
    dealt = block_pairs(rows, "shard", F.col("print"), tree_rows, "shards", single=True)

    def link(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        raw = table["print"].chunk(0)
        values = np.frombuffer(b"".join(raw.to_pylist()), np.uint64).reshape(-1, words)
        _, shard = np.unique(table["_group"].to_numpy(), return_inverse=True)
        label = tree_links(values, shard, radius)
        linked = np.flatnonzero(label != np.arange(len(label)))
        if not len(linked):
            return None
        return pa.RecordBatch.from_arrays([raw.take(pa.array(label[linked])), raw.take(pa.array(linked))], ["a", "b"])

    return in_groups(dealt.select("_group", "print"), "_group", link, "a binary, b binary", 50_000)


def simhash_components(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2,
                       repeats: bool = True, words: int = 1, block_bits: int | None = None,
                       tree_rows: int = TREE_ROWS, keep: Sequence[str] = ()) -> DataFrame:
    """``id_column``, ``fingerprint`` (hex) and ``component_id`` (smallest id reachable) of every row.

    - A null or empty text has no words, its fingerprint is zero and links like any other.
    - A null id stays null; it never is the smallest unless a component has no other.
    - Repeated rows stay repeated.  Other columns are left out, so their names can not clash.
    - With ``keep``, these columns and ``root``, the smallest fingerprint of the component, are passed on.
    - No rows give no rows.
    """
    source = docs.select(column(docs, id_column).alias("id"), column(docs, text).alias("text"),
                         *[column(docs, c).alias(f"_keep_{c}") for c in keep])
    rows = Saved(with_fingerprint(source, "text", "print", shingle, repeats, words), "fingerprints")
    roots = component_roots(rows.df, radius, words, block_bits, tree_rows)
    least = roots.df.groupBy("root").agg(F.min("first").alias("least"))
    labels = Saved(roots.df.join(least, "root").select("print", "least", "root"), "labels")
    roots.discard()
    more = [*[F.col(f"`_keep_{c}`").alias(c) for c in keep], *(["root"] if keep else [])]
    return rows.df.join(labels.df, "print").select(
        F.col("id").alias(id_column), F.lower(F.hex("print")).alias("fingerprint"), F.col("least").alias("component_id"), *more)


def component_roots(rows: DataFrame, radius: int, words: int, block_bits: int | None, tree_rows: int = TREE_ROWS) -> Saved:
    """``print``, ``first`` (smallest id), ``root`` (smallest print reachable) of the fingerprints of rows with ``id`` and ``print``."""
    classes = Saved(rows.groupBy("print").agg(F.min("id").alias("first")), "classes")
    found = connected_components(fingerprint_links(classes.df.select("print"), radius, words, block_bits, tree_rows))
    roots = classes.df.join(found.withColumnRenamed("node", "print"), "print", "left")
    roots = Saved(roots.select("print", "first", F.coalesce("component", "print").alias("root")), "roots")
    classes.discard()
    return roots


def drop_near_duplicates(docs: DataFrame, keep: Sequence[str], id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns ``keep`` of one row for each component of :func:`simhash_components`, with its shingles and radius.

    The row with the smallest id of a component stays, of several with that id
    the one with the smallest digest of its text.  Null ids come last.  Of rows
    with the same id and text the one with the smallest other columns stays.
    Texts without words have one fingerprint and are one component.  Other
    columns are left out; no rows give no rows.
    """
    digest = F.unhex(F.md5(F.coalesce(column(docs, text), F.lit(""))))
    found = simhash_components(docs.select(column(docs, id_column).alias("id"), column(docs, text).alias("text"), digest.alias("digest")), "id",
                               keep=["digest"])
    best = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    chosen = found.groupBy("root").agg(F.min(best).alias("best"))
    chosen = Saved(chosen.select(F.col("best.id").alias("_id"), F.col("best.digest").alias("_digest")), "chosen", lean=True)
    # texts move once, to the chosen ones
    full = docs.select(column(docs, id_column).alias("_id"), digest.alias("_digest"), F.struct(
        *[column(docs, c).alias(f"_{i}") for i, c in enumerate(keep)]).alias("_row"))
    same = (full["_digest"] == chosen.df["_digest"]) & full["_id"].eqNullSafe(chosen.df["_id"])
    left = full.join(chosen.df, same, "left_semi").groupBy("_digest", "_id").agg(F.min("_row").alias("_row"))
    return left.select(*[F.col(f"_row._{i}").alias(c) for i, c in enumerate(keep)])
