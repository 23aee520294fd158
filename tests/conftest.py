from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from assayloom import Harmonization, RuleSet, UnitRules  # noqa: E402

SCHEMA = "file string, OBS_ID string, CODE_TEST string, SHORT_TEST string, RESULT_VAL string, UNIT string"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def units(spark):
    return UnitRules.default(spark)


@pytest.fixture(scope="session")
def lab(spark):
    """Build lab rows from (file, link, code, name, result, unit)."""
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def job(lab, units):
    return lambda rows, **kw: Harmonization(lab(rows), kw.pop("rules", RuleSet()), units, **kw)


@pytest.fixture(scope="session")
def judge(job):
    """Decisions of (result, unit, code) values, by their place in the list."""

    def run(values):
        rows = [("f", str(i), code, None, result, unit) for i, (result, unit, code) in enumerate(values)]
        out = job(rows).harmonized_in_place().collect()
        by_place = {int(r["OBS_ID"]): r.asDict() for r in out}
        return [by_place[i] for i in range(len(values))]

    return run
