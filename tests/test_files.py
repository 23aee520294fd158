"""Lab files in, harmonized files and reports out."""

import csv
import glob

import pytest
from pyspark.sql import functions as F

from assayloom import Harmonization, LabColumns, RuleSet, harmonize_folder, read_lab
from assayloom.operators.attach import attach
from assayloom.operators.scope import linked_orders
from assayloom.plans import reports
from assayloom.sources import sinks
from assayloom.sources.store import save_table

NAMES = ["OBS_ID", "CODE_TEST", "SHORT_TEST", "RESULT_VAL", "UNIT"]
JANUARY = [("1", "MB1", "Culture", "No growth", None), ("1", None, "x", "Clear", None)] + [
    (str(i), "200106", "LDL", f"{i}.5", "mmol/L") for i in range(2, 60)]
FEBRUARY = [("70", "200106", "LDL, direct", "Trace", ""), ("71", "200106", None, "teacee", "mg/dL"), ("1", "200106", "LDL", "3", "mmol/L")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    import pyarrow as pa
    import pyarrow.parquet as pq

    out = tmp_path_factory.mktemp("lab")
    for name, rows in (("lab_01.parquet.gzip", JANUARY), ("lab_02.parquet.gzip", FEBRUARY)):
        table = pa.Table.from_pylist([dict(zip(NAMES, r)) for r in rows], schema=pa.schema([(n, pa.string()) for n in NAMES]))
        pq.write_table(table, out / name, compression="gzip", row_group_size=10)
    (out / "notes.txt").write_text("not a lab file")
    return str(out)


def test_read_by_pattern_and_by_name(spark, folder):
    rows, columns = read_lab(spark, folder)
    assert columns.position == "source_row"
    assert {r["file"]: r["count"] for r in rows.groupBy("file").count().collect()} == {
        "lab_01.parquet.gzip": len(JANUARY), "lab_02.parquet.gzip": len(FEBRUARY)}
    got = rows.filter("file like 'lab_01%'").orderBy("source_row").select(*NAMES).collect()
    assert [tuple(r) for r in got] == JANUARY
    one, _ = read_lab(spark, folder, ["lab_02.parquet.gzip"])
    assert one.count() == len(FEBRUARY)


def test_missing_file_and_column(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_lab(spark, folder, ["lab_09.parquet.gzip"])
    with pytest.raises(ValueError, match="ORDER"):
        read_lab(spark, folder, columns=LabColumns(link="ORDER"))


def test_files_with_different_schemas(spark, tmp_path):
    spark.createDataFrame([(1, 200106, "5", "mmol/L", "n", 1)], "OBS_ID int, CODE_TEST int, RESULT_VAL string, UNIT string, SHORT_TEST string, extra int") \
        .coalesce(1).write.parquet(str(tmp_path / "a.parquet"))
    spark.createDataFrame([("2", "200106", 6.0, "mmol/L", "n")], "OBS_ID string, CODE_TEST string, RESULT_VAL double, UNIT string, SHORT_TEST string") \
        .coalesce(1).write.parquet(str(tmp_path / "b.parquet"))
    parts = [p.split(str(tmp_path) + "/")[1] for p in glob.glob(str(tmp_path / "*" / "part-*"))]
    rows, columns = read_lab(spark, str(tmp_path), parts)
    out = Harmonization(rows, RuleSet(columns=columns)).harmonized().orderBy("OBS_ID").collect()
    assert [(r["OBS_ID"], r["number"], r["extra"]) for r in out] == [("1", 5.0, 1), ("2", 6.0, None)]


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_prefix_filter_reaches_the_scan(spark, folder):
    rows, columns = read_lab(spark, folder)
    text = plan(linked_orders(rows, columns))
    pushed = text[text.index("PushedFilters"):text.index("ReadSchema")]
    assert "StringStartsWith(CODE_TEST,MB)" in pushed
    assert "ReadSchema: struct<OBS_ID:string,CODE_TEST:string" in text and "RESULT_VAL" not in text
    out = linked_orders(rows, columns).collect()
    assert [r[0] for r in out] == ["1"]


def test_run_writes_everything(spark, folder, tmp_path):
    out = str(tmp_path / "run")
    distribution = harmonize_folder(spark, folder, out, clustered=True, compression="gzip").orderBy("file").collect()
    assert [(r["file"], r["total_rows"], r["rows_written"], r["row_count_match"]) for r in distribution] == [
        ("lab_01.parquet.gzip", len(JANUARY), len(JANUARY), True), ("lab_02.parquet.gzip", len(FEBRUARY), len(FEBRUARY), True)]
    assert [r["excluded_rows"] for r in distribution] == [2, 1]
    assert glob.glob(f"{out}/harmonized/file=lab_01.parquet.gzip/*.gz.parquet")
    written = spark.read.option("basePath", f"{out}/harmonized").parquet(f"{out}/harmonized/file=lab_01.parquet.gzip")
    assert written.count() == len(JANUARY)
    for name in ("distribution_comparison", "code_dictionary", "units_not_registered", "conversions_applied", "review/near_vocab"):
        assert any(rows_of(path) for path in glob.glob(f"{out}/{name}/*.csv")) or name == "units_not_registered", name
    near = [r for path in glob.glob(f"{out}/review/near_vocab/*.csv") for r in rows_of(path)]
    assert [(r["value"], r["nearest"], r["distance"]) for r in near] == [("teacee", "trace", "2")]
    top = [r for path in glob.glob(f"{out}/review/review_top/file=lab_02*/*.csv") for r in rows_of(path)]
    assert [r["result"] for r in top] == ["teacee"]


def rows_of(path):
    with open(path, encoding="utf-8", newline="") as handle:
        return list(csv.DictReader(handle))


@pytest.mark.parametrize("clustered", [False, True])
def test_source_order(spark, folder, tmp_path, clustered):
    rows, columns = read_lab(spark, folder)
    job = Harmonization(rows.repartition(5) if clustered else rows, RuleSet(columns=columns))
    path = str(tmp_path / "out")
    sinks.write_harmonized(job.harmonized(), path, columns.position, clustered)
    read = []
    for part in sorted(glob.glob(f"{path}/file=lab_01*/part-*")):
        positions = [r[0] for r in spark.read.parquet(part).select("source_row").collect()]
        assert positions == sorted(positions)
        read += positions
    assert sorted(read) == list(range(len(JANUARY)))
    if clustered:
        assert read == sorted(read)


def test_unclustered_write_moves_no_row(spark, folder):
    rows, columns = read_lab(spark, folder)
    job = Harmonization(rows, RuleSet(columns=columns))
    assert "BroadcastHashJoin" in plan(job.harmonized())
    saved = save_table(job.lookup, "lookup")  # the distinct of the lookup itself is a shuffle, of values and not of rows
    looked_up = attach(job.keyed_rows(), F.broadcast(saved), "microbiology")
    for df in (looked_up, job.harmonized_in_place()):
        text = plan(df)
        assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text
        assert "SortMergeJoin" not in text and "NestedLoop" not in text and "CartesianProduct" not in text


def test_decisions_are_written_by_rows(spark, folder, tmp_path):
    rows, columns = read_lab(spark, folder)
    decisions = reports.decisions_table(Harmonization(rows, RuleSet(columns=columns)).decisions)
    path = str(tmp_path / "d")
    sinks.write_decisions(decisions, path, "csv")
    got = []
    for part in sorted(glob.glob(f"{path}/file=lab_01*/part-*")):
        got += [int(r["n_rows"]) for r in rows_of(part)]
    assert got == sorted(got, reverse=True) and len(got) == decisions.filter(F.col("file").like("lab_01%")).count()


def test_csv_keeps_missing_and_empty_texts_apart(spark, tmp_path):
    df = spark.createDataFrame([("", None, 1), (None, "", 2), ('x"y', "1,2\nz", 3), ("\\", " s ", 4), (None, None, 5)], "p string, q string, n long")
    path = str(tmp_path / "t")
    sinks.write_report(df, path)
    got = sorted(tuple(r) for r in sinks.read_csv_table(spark, path, df.schema).select("n", "p", "q").collect())
    assert got == [(1, "", None), (2, None, ""), (3, 'x"y', "1,2\nz"), (4, "\\", " s "), (5, None, None)]


def lab_file(path, rows, names):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=pa.schema([(n, pa.string()) for n in names])), path)


def test_files_may_differ_and_have_any_name(spark, tmp_path):
    folder = tmp_path / "sp ace" / "[x]"
    lab_file(folder / "lab 1+%.parquet", [("1", "A", "n", "5", "g")], NAMES)
    lab_file(folder / "lab{2}.parquet", [("2", "A", "n", "6", "g", "east")], [*NAMES, "ward"])
    rows, columns = read_lab(spark, str(folder).replace("[", "\\[").replace("]", "\\]"))
    assert columns.position in rows.columns
    assert sorted((r["file"], r["OBS_ID"], r["ward"]) for r in rows.collect()) == [("lab 1+%.parquet", "1", None), ("lab{2}.parquet", "2", "east")]


@pytest.mark.parametrize("gone", ["OBS_ID", "RESULT_VAL"])
def test_every_file_needs_the_columns_with_a_role(spark, tmp_path, gone):
    lab_file(tmp_path / "a.parquet", [("1", "A", "n", "5", "g")], NAMES)
    for name in "bc":
        lab_file(tmp_path / f"{name}.parquet", [("2", "A", "n", "g")], [n for n in NAMES if n != gone])
    with pytest.raises(ValueError, match=rf"2 of 3 lab files(?s:.)*b\.parquet(?s:.)*{gone}(?s:.)*c\.parquet"):
        read_lab(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no file"):
        read_lab(spark, str(tmp_path), pattern="*.csv")


def test_file_names_that_look_like_numbers(spark, tmp_path):
    from assayloom.plans.run import write_run

    rows = spark.createDataFrame([("0011", "1", "A", "n", "5", "g"), ("0012", "2", "A", "n", "6", "g")], ["file", *NAMES])
    got = write_run(Harmonization(rows), str(tmp_path / "out")).collect()
    assert sorted((r["file"], r["rows_written"], r["row_count_match"]) for r in got) == [("0011", 1, True), ("0012", 1, True)]


def test_filter_of_orders_moves_no_row(spark, tmp_path):
    """One linked order owns a third of all rows; most orders are not linked, some pass the filter by chance."""
    from assayloom.operators import scope

    many = [(str(i % 9000) if i % 3 else "7", "MB1" if i % 30 == 0 or i % 9000 > 6000 else "A" if i % 3 else None, "n", "5", "g") for i in range(12000)]
    many += [(None, "A", "n", "5", "g"), (None, "MB2", "n", "5", "g"), ("", "A", "n", "5", "g")]
    lab_file(tmp_path / "a.parquet", many, NAMES)
    rows, columns = read_lab(spark, str(tmp_path))
    sent = Harmonization(rows, RuleSet(columns=columns))
    kept = Harmonization(rows, RuleSet(columns=columns), broadcast_rows=0)
    assert kept.order_filter is not None and kept.order_filter.others.count() > 0
    flags = lambda j: [(r["source_row"], r["_lab_excluded_by"]) for r in j.keyed_rows().collect()]
    assert flags(kept) == sorted(flags(kept)) == sorted(flags(sent), key=lambda r: r[0])
    text = plan(kept.keyed_rows())
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text
    nothing = scope.linked_orders(rows.limit(0), columns)
    assert scope.wrong_hits(rows, columns, nothing, scope.order_words(nothing, 0)).count() == 0


def test_shuffled_link_rule_shuffles(spark, folder):
    from assayloom import ScopeRules
    from assayloom.operators import scope

    rows, columns = read_lab(spark, folder)
    job = Harmonization(rows, RuleSet(columns=columns))
    shuffled = scope.flag_scope(job.source, columns, ScopeRules(), job.linked)
    shuffled.collect()
    assert "SortMergeJoin" in plan(shuffled)
    look = ["file", "source_row", "_lab_excluded_by"]
    assert sorted(map(tuple, shuffled.select(*look).collect()), key=str) == sorted(map(tuple, job.keyed_rows().select(*look).collect()), key=str)
