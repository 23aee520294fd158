"""A store of decisions that grows by files, against runs over all files."""

import os
import time

import pytest
from test_checked import lab_file

from assayloom import Harmonization, Periods, RuleSet, ScopeRules, read_lab
from assayloom.plans import periods, reports


def month(first, codes, n=30):
    """Rows of orders from ``first`` on; ``codes`` of some orders."""
    return [(str(i), codes.get(i, "200106"), "LDL", f"{i % 7}.5", "mmol/L") for i in range(first, first + n)]


def decisions(df):
    return sorted(map(str, reports.decisions_table(df).select(sorted(df.drop("excluded_by").columns)).collect())) + sorted(
        map(str, df.filter("excluded_by is not null").select("file", "excluded_by", "n_rows").collect()))


def whole(spark, folder, rules=RuleSet()):
    rows, columns = read_lab(spark, str(folder))
    with Harmonization(rows, RuleSet(rules.text, rules.scope, columns)) as job:
        return decisions(job.decisions)


@pytest.fixture
def folder(tmp_path):
    lab_file(tmp_path / "in" / "m1.parquet", month(0, {3: "MB1"}))
    lab_file(tmp_path / "in" / "m2.parquet", month(100, {}))
    return tmp_path / "in"


def test_a_new_file_is_scanned_alone(spark, folder, tmp_path):
    store = Periods(spark, str(tmp_path / "store"))
    assert store.decisions() is None
    first = store.update(str(folder))
    assert first.scanned == ["m1.parquet", "m2.parquet"] and decisions(first.decisions) == whole(spark, folder)
    # the new file has rows of an order that an old file excluded
    lab_file(folder / "m3.parquet", month(200, {201: "MB2"}) + month(3, {}, 1))
    second = store.update(str(folder))
    assert (second.scanned, second.gone) == (["m3.parquet"], []) and decisions(second.decisions) == whole(spark, folder)
    assert reports.excluded_counts(second.decisions).filter("file = 'm3.parquet'").first()["excluded_linked_rows"] == 1
    third = store.update(str(folder))
    assert (third.scanned, third.gone) == ([], []) and decisions(third.decisions) == decisions(second.decisions)
    # another object on the same store goes on from it
    assert decisions(Periods(spark, str(tmp_path / "store")).decisions()) == decisions(second.decisions)


def test_files_that_share_a_newly_excluded_order_are_scanned_again(spark, folder, tmp_path):
    store = Periods(spark, str(tmp_path / "store"))
    store.update(str(folder))
    lab_file(folder / "m3.parquet", month(105, {105: "MB2"}, 1) + month(300, {}))
    update = store.update(str(folder))
    assert update.scanned == ["m2.parquet", "m3.parquet"] and decisions(update.decisions) == whole(spark, folder)
    # and when the order is in scope again
    os.remove(folder / "m3.parquet")
    update = store.update(str(folder))
    assert (update.scanned, update.gone) == (["m2.parquet"], ["m3.parquet"]) and decisions(update.decisions) == whole(spark, folder)


def test_changed_files_and_rules(spark, folder, tmp_path):
    store = Periods(spark, str(tmp_path / "store"))
    store.update(str(folder))
    time.sleep(0.01)
    lab_file(folder / "m2.parquet", month(100, {}, 31))
    assert store.update(str(folder)).scanned == ["m2.parquet"]
    assert decisions(store.decisions()) == whole(spark, folder)
    rules = RuleSet(scope=ScopeRules(exclude_linked=False))
    other = Periods(spark, str(tmp_path / "store"), rules)
    update = other.update(str(folder))
    assert update.scanned == ["m1.parquet", "m2.parquet"] and decisions(update.decisions) == whole(spark, folder, rules)


def test_many_batches_become_one(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(periods, "MOST_BATCHES", 1)
    store = Periods(spark, str(tmp_path / "store"))
    store.update(str(folder))
    lab_file(folder / "2020.parquet", month(400, {}))
    store.update(str(folder))
    assert len({e["batch"] for e in store.manifest().values()}) == 1
    lab_file(folder / "m4.parquet", month(500, {505: "MB1"}))
    update = store.update(str(folder))
    assert update.scanned == ["m4.parquet"] and decisions(update.decisions) == whole(spark, folder)


def test_a_run_that_breaks_off_leaves_the_store_as_it_was(spark, folder, tmp_path, monkeypatch):
    store = Periods(spark, str(tmp_path / "store"))
    before = decisions(store.update(str(folder)).decisions)
    lab_file(folder / "m3.parquet", month(200, {}))

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(store, "_write_manifest", broken)
    with pytest.raises(RuntimeError, match="lost"):
        store.update(str(folder))
    monkeypatch.undo()
    assert decisions(store.decisions()) == before
    assert store.update(str(folder)).scanned == ["m3.parquet"]


def test_names_and_missing_files(spark, folder, tmp_path):
    store = Periods(spark, str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError, match="m9"):
        store.update(str(folder), ["m9.parquet"])
    with pytest.raises(ValueError, match="no file"):
        store.update(str(folder), pattern="*.csv")
    assert store.update(str(folder), ["m1.parquet"]).scanned == ["m1.parquet"]
