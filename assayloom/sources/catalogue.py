"""Catalogue of lab files: rows and layout of each, read from the footers by tasks.

Whatever the number of files, one job reads all footers, and Spark is asked for the
schema of one file of each layout.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Footers that are read by one task, about.
FILES_OF_A_TASK = 64
#: Schemas that are asked for side by side.
SCHEMAS_AT_ONCE = 16
#: Where Spark keeps the types of a column that parquet itself does not know.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

CATALOGUE = pa.schema([("path", pa.string()), ("n_rows", pa.int64()), ("layout", pa.string())])


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths of the files; only their names are read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    return sorted(listed.toArrow()["path"].to_pylist())


def literal_path(path: str) -> str:
    """The path with its glob signs taken literally."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def file_of(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _footer(path: str) -> tuple[int | None, str | None]:
    """Rows and layout of a file; nothing when its store can only be read by Spark."""
    import pyarrow.fs as fs
    import pyarrow.parquet as pq

    try:
        if path.startswith("file:"):
            store, inside = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
        else:
            store, inside = fs.FileSystem.from_uri(quote(path, safe=":/@=+,"))
        with store.open_input_file(inside) as handle:
            footer = pq.ParquetFile(handle).metadata
        types = (footer.metadata or {}).get(SPARK_SCHEMA, b"")
        return footer.num_rows, hashlib.sha256(str(footer.schema).split("\n", 1)[1].encode() + types).hexdigest()
    except (OSError, ValueError, NotImplementedError, pa.ArrowException):
        return None, None


def file_catalogue(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path``, ``n_rows``, ``layout``: files of one layout have the same columns and types.

    ``n_rows`` and ``layout`` are null for a file whose footer only Spark can read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(path, *_footer(path)) for path in batch["path"].to_pylist()]
            yield pa.RecordBatch.from_pylist([dict(zip(CATALOGUE.names, row)) for row in found], schema=CATALOGUE)

    listed = spark.createDataFrame(pa.table({"path": pa.array(list(paths), pa.string())}))
    tasks = -(-len(paths) // FILES_OF_A_TASK)
    return listed.repartition(tasks, "path").mapInArrow(run, "path string, n_rows long, layout string")


def _folders(path: str) -> tuple:
    """Folders such as year=2020 are columns too; numbers are of one kind."""
    parts = [part.partition("=") for part in path.split("/")[:-1] if "=" in part]
    return tuple((name, "0" if re.fullmatch(r"\d{1,9}", value) else value) for name, _, value in parts)


def schemas_of(spark: SparkSession, catalogue: pa.Table, options: dict[str, str]) -> dict[str, StructType]:
    """Schema of each path of the collected catalogue, asked for once a layout."""
    kinds: dict[tuple, list[str]] = {}
    for path, layout in zip(catalogue["path"].to_pylist(), catalogue["layout"].to_pylist()):
        kinds.setdefault((layout or path, _folders(path) if options else ()), []).append(path)

    def schema(paths: list[str]) -> StructType:
        return spark.read.options(**options).parquet(literal_path(paths[0])).schema

    with ThreadPoolExecutor(SCHEMAS_AT_ONCE) as pool:
        found = list(pool.map(schema, kinds.values()))
    by_path = {path: known for known, paths in zip(found, kinds.values()) for path in paths}
    return {path: by_path[path] for path in sorted(by_path)}


def file_rows(spark: SparkSession, catalogue: pa.Table) -> DataFrame:
    """``file``, ``n_rows`` of each file name, also of files without rows."""
    counts = spark.createDataFrame(catalogue.select(["path", "n_rows"]))
    return counts.select(F.substring_index("path", "/", -1).alias("file"), "n_rows").groupBy("file").agg(F.sum("n_rows").alias("n_rows"))
