"""Content digests, staged output, and the file catalogue."""

import glob
import os
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from assayloom import Harmonization, LabColumns, RuleSet, harmonize_folder, open_lab, read_lab
from assayloom.operators.digest import content_digest
from assayloom.plans import checked
from assayloom.plans.checked import ContentMismatch, content_check, write_checked
from assayloom.sources import sinks

NAMES = ["OBS_ID", "CODE_TEST", "SHORT_TEST", "RESULT_VAL", "UNIT"]
ROWS = [("f", "1", "MB1", None, "x", None), ("f", "1", "A", None, "5", "g")] + [
    (f, str(i), "200106", "LDL", f"{i}.5", "mmol/L") for f in ("f", "g") for i in range(2, 40)] + [("g", None, None, None, None, "")]


def lab_file(path, rows, names=NAMES):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=pa.schema([(n, pa.string()) for n in names])), path)


@pytest.fixture
def study(job):
    with job(ROWS) as j:
        rows = j.harmonized().cache()
        columns = [c for c in rows.columns if c not in checked.NEW_COLUMNS]
        yield j, rows, lambda written: {r["file"]: tuple(r)[3:] for r in content_check(j, written, columns).collect()}


def test_right_rows_agree(study):
    _, rows, check = study
    assert check(rows.repartition(7)) == {"f": (True, True, True), "g": (True, True, True)}


@pytest.mark.parametrize("column", ["RESULT_VAL", "OBS_ID", "number", "unit_std", "shape", "conversion_status"])
def test_a_changed_value_fails(study, column):
    _, rows, check = study
    one = (F.col("file") == "f") & (F.col("OBS_ID") == "7")
    other = F.lit(8.25) if column == "number" else F.lit("other")
    got = check(rows.withColumn(column, F.when(one, other).otherwise(F.col(column))))
    assert got["g"] == (True, True, True) and got["f"][0] and not all(got["f"])
    if column not in checked.NEW_COLUMNS:
        assert not got["f"][1]
    else:
        assert got["f"][1:] == (True, False)


def test_a_lost_a_doubled_and_an_exchanged_row_fail(study):
    _, rows, check = study
    is_seven = (F.col("file") == "f") & (F.col("OBS_ID") == "7")
    assert check(rows.filter(~is_seven))["f"] == (False, False, False)
    assert check(rows.unionByName(rows.filter(is_seven)))["f"] == (False, False, False)
    # as many rows, one in place of another
    eight = rows.filter((F.col("file") == "f") & (F.col("OBS_ID") == "8"))
    assert check(rows.filter(~is_seven).unionByName(eight))["f"] == (True, False, False)
    # numbers of two rows exchanged: each is right for another row
    seven_eight = F.when(F.col("OBS_ID") == "7", 8.5).when(F.col("OBS_ID") == "8", 7.5)
    swapped = rows.withColumn("number", F.when(F.col("file") == "f", F.coalesce(seven_eight, "number")).otherwise(F.col("number")))
    assert check(swapped)["f"] == (True, True, False)
    # a value that moves between empty columns
    moved = rows.withColumns({"SHORT_TEST": F.coalesce("SHORT_TEST", F.lit("x")), "RESULT_VAL": F.when(F.col("RESULT_VAL") != "x", F.col("RESULT_VAL"))})
    assert not check(moved)["f"][1]
    assert check(rows.filter("file = 'f'"))["g"] == (False, False, False)


def test_digest_of_any_type_and_order(spark):
    rows = [(1, 1.5, [1, None], {"a": 1}, None), (2, float("nan"), None, None, "x"), (2, float("nan"), None, None, "x"), (None, None, [], {}, "")]
    df = spark.createDataFrame(rows, "i int, d double, l array<int>, m map<string,int>, s string")
    whole = lambda t: content_digest(t, [F.col(c) for c in t.columns], F.lit("f")).first()["digest"]
    assert whole(df) == whole(df.repartition(4)) != whole(df.dropDuplicates(["i", "s"]))
    assert len({whole(df.withColumn(c, F.lit(None).cast(df.schema[c].dataType))) for c in df.columns}) == 5


def test_rows_appear_when_they_are_proven(spark, job, tmp_path, monkeypatch):
    out = str(tmp_path / "rows")
    with job(ROWS) as j:
        assert all(all(tuple(r)[3:]) for r in write_checked(j, out, compression="gzip").collect())
        assert sorted(os.listdir(tmp_path)) == ["rows"] and glob.glob(f"{out}/file=f/*.gz.parquet")
        with pytest.raises(FileExistsError):
            write_checked(j, out)
        write = sinks.write_harmonized
        monkeypatch.setattr(sinks, "write_harmonized", lambda rows, *a: write(rows.withColumn("number", F.col("number") + 1), *a))
        with pytest.raises(ContentMismatch, match="2 files differ(?s:.)*'file': 'f'(?s:.)*'decisions_match': False"):
            write_checked(j, str(tmp_path / "bad"))
        assert sorted(os.listdir(tmp_path)) == ["_staged-bad", "rows"]
        checked.discard_staged(j, str(tmp_path / "bad"))
        monkeypatch.undo()
        # without the columns of the value
        kept = write_checked(j, str(tmp_path / "few"), keep=["OBS_ID"])
        assert all(all(tuple(r)[3:]) for r in kept.collect())
        assert spark.read.parquet(str(tmp_path / "few")).columns[:2] == ["OBS_ID", "shape"]
    assert sorted(os.listdir(tmp_path)) == ["few", "rows"]


def test_a_run_leaves_no_saved_table(spark, tmp_path, monkeypatch):
    from assayloom.sources import store

    monkeypatch.setattr(store, "shared_folder", lambda spark: str(tmp_path / "shared"))
    lab_file(tmp_path / "in" / "a.parquet", [r[1:] for r in ROWS if r[0] == "f"])
    lab_file(tmp_path / "in" / "empty.parquet", [])
    got = {r["file"]: r for r in harmonize_folder(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()}
    assert os.listdir(tmp_path / "shared") == []
    assert (got["a.parquet"]["rows_written"], got["a.parquet"]["row_count_match"]) == (40, True)
    assert (got["empty.parquet"]["total_rows"], got["empty.parquet"]["row_count_match"], got["empty.parquet"]["split_pct"]) == (0, True, None)


def jobs_of(spark, work):
    group = f"count-{id(work)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_five_thousand_files(spark, tmp_path):
    few, many = tmp_path / "few", tmp_path / "many"
    lab_file(few / "f0.parquet", [("0", "A", "n", "5", "g")])
    lab_file(few / "g0.parquet", [("0", "A", "n", "5", "g", "x")], [*NAMES, "ward"])
    many.mkdir()
    for i in range(2500):
        shutil.copy(few / "f0.parquet", many / f"f{i}.parquet")
        shutil.copy(few / "g0.parquet", many / f"g{i}.parquet")
    found = {}

    def open_(folder):
        found[folder] = open_lab(spark, str(folder))

    assert jobs_of(spark, lambda: open_(many)) <= jobs_of(spark, lambda: open_(few)) + 2
    table = found[many]
    assert table.files.agg(F.count("file"), F.sum("n_rows")).first() == (5000, 5000)
    assert table.rows.agg(F.count_distinct("file"), F.count("ward")).first() == (5000, 2500)


def test_catalogue_without_readable_footers(spark, tmp_path, monkeypatch):
    """A store that only Spark can read: its schemas are asked for file by file."""
    from assayloom.sources import lab
    from assayloom.sources.catalogue import file_catalogue

    for name in "ab":
        lab_file(tmp_path / f"{name}.parquet", [(name, "A", "n", "5", "g")])
    unread = lambda spark, paths: file_catalogue(spark, paths).select(
        "path", F.lit(None).cast("long").alias("n_rows"), F.lit(None).cast("string").alias("layout"))
    monkeypatch.setattr(lab, "file_catalogue", unread)
    rows, _ = read_lab(spark, str(tmp_path))
    assert sorted(r["OBS_ID"] for r in rows.collect()) == ["a", "b"]


def test_folders_that_are_columns(spark, tmp_path):
    for year in ("2019", "2020"):
        lab_file(tmp_path / f"year={year}" / f"lab{year}.parquet", [(year, "A", "n", "5", "g")])
    rows, columns = read_lab(spark, str(tmp_path))
    out = Harmonization(rows, RuleSet(columns=columns)).harmonized().orderBy("year").collect()
    assert [(r["year"], r["OBS_ID"], r["file"]) for r in out] == [(2019, "2019", "lab2019.parquet"), (2020, "2020", "lab2020.parquet")]
    assert isinstance(columns, LabColumns)
