"""Saved intermediate tables and size checks before a broadcast.

A table that several jobs read is written once to the shared folder of the
cluster.  That also cuts its lineage: when an executor is lost, its readers go
back to the files and not to the source scan.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Largest table that is sent to every executor.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors can reach.

    It is the one the session names in ``spark.checkpoint.dir``; without a scheme it
    belongs to the session's default file system, as for Spark itself.  If none is
    named, a session on plain ``local[...]``, where driver and executors are one
    process, takes a temporary folder, and another one a folder in the warehouse,
    unless the warehouse is on the disk of one of several machines.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if re.fullmatch(r"local(\[[^\]]*\])?", master) is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not master.startswith("local-cluster") and re.match(r"(file:|(?![A-Za-z][A-Za-z0-9+.-]*:))", warehouse):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
        return f"{warehouse}/assayloom-{spark.conf.get('spark.app.id')}"
    app = spark.conf.get("spark.app.id")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="assayloom-")
    return _local_folders[app]


def new_name(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex[:12]}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{new_name(name)}"


def _on_store(spark: SparkSession, path: str):
    """The path and its store."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discard(spark: SparkSession, path: str) -> None:
    """Remove a saved table that nothing reads any more."""
    where, store = _on_store(spark, path)
    store.delete(where, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    where, store = _on_store(spark, path)
    return store.exists(where)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    where, store = _on_store(spark, path)
    return [status.getPath().getName() for status in store.listStatus(where)] if store.exists(where) else []


def staged_path(path: str) -> str:
    """Where a folder is written before it is visible: readers skip names that begin with an underscore."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_staged-{name}"


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Give a finished folder its name."""
    to, store = _on_store(spark, path)
    if not store.rename(_on_store(spark, staged)[0], to):
        raise OSError(f"cannot rename {staged} to {path}")


def save_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write the table to the shared folder and read it from there."""
    path = path or new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _size(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Aggregates ``n`` and ``bytes`` of the columns as a broadcast would hold them (8 bytes per value that is not text)."""
    texts = [c for c in columns if df.schema[c].dataType.typeName() == "string"]
    width = reduce(add, [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)).cast("long") for c in texts], F.lit(8 * len(columns)).cast("long"))
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0).cast("long")).alias("bytes")]


def save_measured(df: DataFrame, path: str, columns: Sequence[str] = ()) -> tuple[DataFrame, tuple[int, int]]:
    """Write the table, read it from there, and give the rows and bytes of some of its columns, taken while it was written.

    A task that is done again may count its rows twice, so the size is never too small.
    """
    seen = Observation()
    df.observe(seen, *_size(df, columns or df.columns)).write.parquet(path)
    saved, size = df.sparkSession.read.schema(df.schema).parquet(path), seen.get
    if "n" not in size:  # an empty table may be written without its plan
        return saved, size_of(saved.select(*columns) if columns else saved)
    return saved, (size["n"], size["bytes"])


def size_of(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a table as a broadcast would hold it."""
    row = df.agg(*_size(df, df.columns)).first()
    return row["n"], row["bytes"]


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure the table.  Call it on a saved table, this runs a job."""
    n, size = size_of(df)
    return n <= max_rows and size <= max_bytes
