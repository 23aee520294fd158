"""Session settings that matter for the speed of this package, not for its results."""

from __future__ import annotations

from pyspark.sql import SparkSession

# (setting, Spark's default, what to use instead)
SETTINGS = [
    # The chains of patterns make large generated methods, and the JVM never
    # compiles a method above 8000 bytes.  With this limit Spark splits them.
    ("spark.sql.codegen.hugeMethodLimit", "65535", "8000"),
    # A task that reads a few source files writes them side by side, in the
    # order of the scan, instead of sorting its rows by file.
    ("spark.sql.maxConcurrentOutputFileWriters", "0", "16"),
]


def prepare(spark: SparkSession) -> SparkSession:
    """Change settings that still have Spark's default."""
    for name, default, better in SETTINGS:
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, better)
    return spark
