"""The shared folder of a session."""

from __future__ import annotations

import pytest

from assayloom.sources import store

HDFS = {"spark.sql.warehouse.dir": "hdfs://store/warehouse", "spark.app.id": "app-1"}
FILE = {"spark.sql.warehouse.dir": "file:/mnt/warehouse", "spark.app.id": "app-1"}


class Session:
    def __init__(self, **conf):
        self.conf = {key.replace("__", "."): value for key, value in conf.items()}


def folder(master: str, conf: dict, named: str | None = None) -> str:
    return store.shared_folder(Session(spark__master=master, **conf, **({store.CHECKPOINT_DIR: named} if named else {})))


@pytest.mark.parametrize("master", ["local[2]", "local-cluster[2,1,1024]", "spark://host:7077", "yarn"])
@pytest.mark.parametrize("named", ["/mnt/shared", "file:///mnt/shared", "hdfs://store/shared"])
def test_a_named_folder_is_taken_with_or_without_a_scheme(master, named):
    assert folder(master, FILE, named + "/") == named


def test_without_a_name_a_cluster_takes_the_warehouse_it_can_reach():
    assert folder("yarn", HDFS) == "hdfs://store/warehouse/assayloom-app-1"
    assert folder("local-cluster[2,1,1024]", FILE) == "file:/mnt/warehouse/assayloom-app-1"
    for path in ("file:/mnt/warehouse", "/mnt/warehouse"):
        with pytest.raises(RuntimeError, match="all executors"):
            folder("spark://host:7077", FILE | {"spark.sql.warehouse.dir": path})


def test_a_saved_table_below_a_path_without_a_scheme(spark, tmp_path, monkeypatch):
    found = folder("local-cluster[2,1,1024]", FILE, str(tmp_path / "shared"))
    monkeypatch.setattr(store, "shared_folder", lambda _: found)
    saved = store.save_table(spark.range(3).toDF("n"), "rows")
    assert sorted(r["n"] for r in saved.collect()) == [0, 1, 2]
    assert [p.name.split("-")[0] for p in (tmp_path / "shared").iterdir()] == ["rows"]
