"""What the package may and may not use."""

import re
from pathlib import Path

import pytest

from riskspark.sources import workdir

ROOT = Path(__file__).parent.parent / "riskspark"
#: the corpus package has rules of its own
SOURCES = sorted(p for p in ROOT.glob("**/*.py") if p.relative_to(ROOT).parts[0] != "llm")


@pytest.mark.parametrize(
    "pattern",
    [r"\budf\(", r"pandas_udf", r"applyInPandas", r"mapInPandas", r"\.rdd\b", r"localCheckpoint", r"crossJoin", r"\btempfile\b"],
)
def test_not_used(pattern):
    assert [p.name for p in SOURCES if re.search(pattern, p.read_text())] == []


def test_intermediate_tables_go_to_the_shared_folder(spark):
    folder = workdir.shared_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert workdir.scratch_path(spark, "x") != workdir.scratch_path(spark, "x")


def test_without_the_setting_the_warehouse_stands_in():
    settings = {"spark.sql.warehouse.dir": "file:/shared/warehouse/"}
    assert workdir.work_root(lambda name, *default: settings.get(name, *default)) == "file:/shared/warehouse/_work"
    settings["spark.checkpoint.dir"] = "hdfs:///work/"
    assert workdir.work_root(lambda name, *default: settings.get(name, *default)) == "hdfs:///work"


def test_discarded_tables_leave_the_shared_folder(spark):
    kept, gone = (workdir.stage_table(spark.range(3).toDF("x"), "part") for _ in range(2))
    (path,) = {name.rsplit("/", 1)[0].removeprefix("file://") for name in gone.inputFiles()}
    workdir.discard(gone, spark.range(1), gone)
    assert not Path(path).exists()
    assert kept.count() == 3
