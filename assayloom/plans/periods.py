"""Decisions of a growing folder, kept file by file, so that a new file is scanned alone.

A store holds, for each lab file, its decisions with their counts, the orders it
excludes, and hashes of all its orders.  Counts of different files add up, so a run
over n + 1 files needs the rows of one.  Files depend on each other only through
the orders: when an update makes an order excluded that was not, or the other way
round, the files that may hold it are scanned again, and no others.

Tables are written in batches and never changed.  The manifest names the batch of
each file; it is written last and under its own number, so a run that breaks off
leaves the store as it was.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.operators.keys import source
from assayloom.operators.scope import LINK, linked_orders
from assayloom.operators.units import UnitRules
from assayloom.plans.run import Harmonization
from assayloom.rules import RuleSet
from assayloom.sources.catalogue import file_of
from assayloom.sources.lab import open_lab
from assayloom.sources.store import list_folder, new_name, publish, staged_path

#: A store with more batches than this is written anew as one.
MOST_BATCHES = 16

MANIFEST = pa.schema([("file", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("modified", pa.int64()),
                      ("rules", pa.string()), ("batch", pa.string())])


@dataclass(frozen=True)
class Update:
    """What an update did: files that were scanned, files that are gone, and the decisions of all files."""

    scanned: list[str]
    gone: list[str]
    decisions: DataFrame


def _listed(spark: SparkSession, folder: str, pattern: str, files: Sequence[str]) -> dict[str, dict]:
    """Name, path, length and time of each file; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    found = found.select("path", "length", F.unix_micros("modificationTime").alias("modified")).toArrow().to_pylist()
    by_name = {file_of(row["path"]): row for row in found}
    if len(by_name) < len(found):
        raise ValueError(f"files in {folder} must have different names")
    missing = set(files) - by_name.keys()
    if missing:
        raise FileNotFoundError(f"not in {folder}: {sorted(missing)}")
    return {name: by_name[name] for name in files} if files else by_name


def rules_digest(rules: RuleSet, units: UnitRules) -> str:
    """Changes with every word, pattern, spelling and factor."""
    parts = [repr(rules)]
    for table in (units.spellings, units.conversions):
        hashed = table.select(F.xxhash64(*table.columns, F.to_json(F.struct(*table.columns))).cast("decimal(38,0)").alias("h"))
        parts.append(str(hashed.agg(F.count("h"), F.sum("h")).first()))
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


class Periods:
    """The store of one folder of lab files under one set of rules.

    ``rules.columns`` name the roles; the link rule is the one of the rules.  Files
    are known by their names, which must differ.  A file whose length or time
    changed is a new one; other rules make all files new.
    """

    def __init__(self, spark: SparkSession, store: str, rules: RuleSet = RuleSet(), units: UnitRules | None = None):
        self.spark, self.store, self.rules = spark, store.rstrip("/"), rules
        self.units = units or UnitRules.default(spark)
        self.digest = rules_digest(rules, self.units)

    # --- the store -----------------------------------------------------------

    def _manifests(self) -> list[int]:
        names = [re.fullmatch(r"manifest-(\d+)", name) for name in list_folder(self.spark, self.store)]
        return sorted(int(m[1]) for m in names if m)

    def manifest(self) -> dict[str, dict]:
        """Entry of each file, of the last update that came to its end."""
        done = self._manifests()
        if not done:
            return {}
        rows = self.spark.read.parquet(f"{self.store}/manifest-{done[-1]}").toArrow().to_pylist()
        return {row["file"]: row for row in rows}

    def _write_manifest(self, entries: Sequence[dict]) -> None:
        number = (self._manifests() or [0])[-1] + 1
        path = f"{self.store}/manifest-{number}"
        table = self.spark.createDataFrame(pa.Table.from_pylist(list(entries), schema=MANIFEST))
        table.coalesce(1).write.mode("overwrite").parquet(staged_path(path))
        publish(self.spark, staged_path(path), path)

    def _table(self, name: str, entries: Sequence[dict]) -> DataFrame | None:
        """Rows of a table that belong to the entries."""
        batches: dict[str, list[str]] = {}
        for entry in entries:
            batches.setdefault(entry["batch"], []).append(entry["file"])
        out = None
        for batch, files in batches.items():
            rows = self.spark.read.parquet(f"{self.store}/{batch}/{name}").filter(F.col("of_file").isin(files))
            out = rows if out is None else out.unionByName(rows)
        return out

    def decisions(self) -> DataFrame | None:
        """Decisions of all files, as :attr:`Harmonization.decisions`; reports can read them."""
        found = self._table("decisions", list(self.manifest().values()))
        return None if found is None else found.drop("of_file")

    # --- updates -------------------------------------------------------------

    def update(self, folder: str, files: Sequence[str] = (), pattern: str = "*.parquet*") -> Update:
        """Bring the store to the files of the folder; only what changed is scanned."""
        listed = _listed(self.spark, folder, pattern, files)
        if not listed:
            raise ValueError(f"no file in {folder} matches {pattern}")
        old = self.manifest()

        def same(name: str) -> bool:
            return name in old and old[name]["rules"] == self.digest and all(
                old[name][k] == listed[name][k] for k in ("path", "length", "modified"))

        kept = [name for name in listed if same(name)]
        fresh = [name for name in listed if name not in kept]
        gone = [name for name in old if name not in listed]
        if not fresh and not gone:
            return Update([], [], self.decisions())

        kept_entries, linked = [old[name] for name in kept], None
        again: list[str] = []
        batch = new_name("batch")
        rows = columns = None
        if fresh:
            rows, columns = self._scan(folder, fresh)
        if self.rules.scope.exclude_linked and self.rules.columns.link:
            after = self._orders(kept_entries)
            if fresh:
                self._write(linked_orders_of(rows, columns, self.rules), batch, "orders")
                mine = self.spark.read.parquet(f"{self.store}/{batch}/orders").select(LINK)
                after = mine if after is None else after.unionByName(mine)
            before = self._orders([e for e in old.values() if e["rules"] == self.digest])
            again = self._touched(kept_entries, before, after)
            linked = None if after is None else after.distinct()
        if again:
            rows, columns = self._scan(folder, [*fresh, *again])
            if linked is not None:
                self._write(linked_orders_of(rows, columns, self.rules), batch, "orders", replace=True)
                linked = self._orders([e for e in kept_entries if e["file"] not in again])
                mine = self.spark.read.parquet(f"{self.store}/{batch}/orders").select(LINK)
                linked = (mine if linked is None else linked.unionByName(mine)).distinct()
        scanned = [*fresh, *again]
        if scanned:
            if linked is not None:
                self._write(orders_seen(rows, columns), batch, "seen")
            with Harmonization(rows, RuleSet(self.rules.text, self.rules.scope, columns), self.units, linked=linked) as job:
                self._write(job.decisions.withColumn("of_file", F.col("file")), batch, "decisions")
        entries = [e for e in kept_entries if e["file"] not in again]
        entries += [{"file": name, **listed[name], "rules": self.digest, "batch": batch} for name in scanned]
        if len({e["batch"] for e in entries}) > MOST_BATCHES:
            entries = self._compacted(entries)
        self._write_manifest(entries)
        return Update(sorted(scanned), sorted(gone), self.decisions())

    def _scan(self, folder: str, files: list[str]):
        table = open_lab(self.spark, folder, sorted(files), columns=self.rules.columns)
        return table.rows, table.columns

    def _write(self, table: DataFrame, batch: str, name: str, replace: bool = False) -> None:
        # rows of a file lie together, so the others are not read when some are wanted
        writer = table.sortWithinPartitions("of_file").write
        (writer.mode("overwrite") if replace else writer).parquet(f"{self.store}/{batch}/{name}")

    def _orders(self, entries: Sequence[dict]) -> DataFrame | None:
        found = self._table("orders", entries)
        return None if found is None else found.select(LINK)

    def _touched(self, kept: Sequence[dict], before: DataFrame | None, after: DataFrame | None) -> list[str]:
        """Kept files that may hold an order which is excluded now and was not, or was and is not."""
        if not kept:
            return []
        parts = [a.distinct().join(b.distinct(), LINK, "left_anti") if b is not None else a
                 for a, b in ((after, before), (before, after)) if a is not None]
        changed = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        changed = changed.select(F.xxhash64(LINK).alias("order_hash")).distinct()
        seen = self._table("seen", kept)
        hit = seen.join(changed, "order_hash", "left_semi").select("of_file").distinct()
        return sorted(row["of_file"] for row in hit.collect())

    def _compacted(self, entries: list[dict]) -> list[dict]:
        """All batches in one."""
        batch = new_name("batch")
        for name in ("decisions", "orders", "seen"):
            if name == "decisions" or (self.rules.scope.exclude_linked and self.rules.columns.link):
                self._write(self._table(name, entries), batch, name)
        return [entry | {"batch": batch} for entry in entries]


def linked_orders_of(rows: DataFrame, columns, rules: RuleSet) -> DataFrame:
    """``of_file`` and the orders that a row with an excluded code of that file has."""
    return linked_orders(rows.withColumn("of_file", source(columns.file)), columns, rules.scope, ["of_file"])


def orders_seen(rows: DataFrame, columns) -> DataFrame:
    """``of_file``, ``order_hash`` of every order of every file."""
    link = source(columns.link).cast("string")
    return rows.filter(link.isNotNull()).select(source(columns.file).alias("of_file"), F.xxhash64(link).alias("order_hash")).distinct()
