"""Digests of the content of a table that do not depend on the order of its rows.

A row has a 64-bit hash; the digest of a group is the number of its rows and the
sum of their hashes, wide enough not to overflow.  A changed value, a lost row and
a row that is written twice each change it.  Sums merge, so one pass with partial
sums in each task is enough.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, VariantType

#: A hash is added up in pieces of so many bits, each sum is a long.
PIECE_BITS, PIECES = 16, 4
#: Columns whose nulls are marked in one number.
MASK_BITS = 30


def _hashable(column: Column, kind: DataType) -> Column:
    """Maps and variants have no hash of their own."""
    if isinstance(kind, MapType | VariantType) or "map<" in kind.simpleString():
        return F.to_json(F.struct(column.alias("v")))
    return column


def row_hash(columns: Sequence[Column], kinds: Sequence[DataType] | None = None) -> Column:
    """Hash of a row.  Hashing skips nulls, so where they are is hashed too."""
    values = [_hashable(c, k) for c, k in zip(columns, kinds)] if kinds else list(columns)
    masks = []
    for low in range(0, len(columns), MASK_BITS):
        bits = [F.when(c.isNull(), 1 << i).otherwise(0) for i, c in enumerate(columns[low : low + MASK_BITS])]
        masks.append(reduce(lambda a, b: a + b, bits))
    return F.xxhash64(*values, *masks)


def hash_sums(hash_: Column, times: Column | None = None, name: str = "digest") -> list[Column]:
    """Aggregates for the sum of the hashes, each counted ``times`` times."""
    pieces = [F.shiftrightunsigned(hash_, PIECE_BITS * i).bitwiseAND(F.lit((1 << PIECE_BITS) - 1)) for i in range(PIECES)]
    return [F.sum(piece if times is None else piece * times).alias(f"_{name}_{i}") for i, piece in enumerate(pieces)]


def whole_sum(name: str = "digest") -> Column:
    """One number from the sums of the pieces."""
    total = None
    for i in range(PIECES):
        part = F.col(f"_{name}_{i}").cast("decimal(38,0)") * F.lit(1 << (PIECE_BITS * i)).cast("decimal(20,0)")
        total = part if total is None else total + part
    return total.cast("decimal(38,0)").alias(name)


def content_digest(rows: DataFrame, columns: Sequence[Column], group: Column) -> DataFrame:
    """``file``, ``n_rows``, ``digest`` of the columns of each group."""
    kinds = [field.dataType for field in rows.select(*columns).schema]
    hashed = rows.select(group.alias("file"), row_hash(columns, kinds).alias("_hash"))
    sums = hashed.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), *hash_sums(F.col("_hash")))
    return sums.select("file", "n_rows", whole_sum())
