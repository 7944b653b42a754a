"""Session defaults, the shared folder, and dropping what was written to it."""

import os
from types import SimpleNamespace

import pytest

from wellspring import session
from wellspring.operators import drop_table, drop_temporaries, materialize, snapshot
from wellspring.operators.scans import fresh_path
from wellspring.plans.registry import QUERIES
from wellspring.survey import Survey


def test_no_local_folder_on_a_cluster():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=context)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        context.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(spark)
    spark.conf.get = lambda k, d=None: "hdfs://store/shared/"
    assert session.shared_dir(spark) == "hdfs://store/shared"


def test_temporaries_and_snapshots_can_be_dropped(spark):
    df = spark.range(3)
    temp = materialize(df, "drop_me")
    kept = snapshot(df, "drop_me_too")
    folder = os.path.dirname(kept.inputFiles()[0].removeprefix("file://"))
    assert temp.count() == kept.count() == 3
    mine = os.path.dirname(os.path.dirname(fresh_path(df, "x", temporary=True).removeprefix("file:")))
    assert os.path.isdir(mine) and drop_temporaries(spark) and not os.path.exists(mine)
    assert drop_table(spark, session.table_path(spark, "drop_me_too", os.path.basename(folder)))
    assert not os.path.exists(folder)
    with pytest.raises(ValueError):
        drop_table(spark, "/somewhere/else")


def test_unreadable_optional_table_is_an_error(spark, tmp_path):
    survey = Survey.from_test_tables(spark, "/root/testdata/sf0.001")
    from wellspring.survey import TABLES
    from wellspring.sources.schemas import SURVEY_SCHEMAS
    for name in TABLES:
        if name in SURVEY_SCHEMAS and name != "water_quality":
            spark.createDataFrame([], SURVEY_SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}")
    assert Survey.from_parquet(spark, str(tmp_path)).water_quality is None and survey.water_quality is not None
    (tmp_path / "water_quality").mkdir()
    (tmp_path / "water_quality" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        Survey.from_parquet(spark, str(tmp_path)).water_quality.count()


def test_point_lookup_reaches_both_scans(spark, sf_small):
    plan = QUERIES["join_point_lookup"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan" in x]
    for table, column in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        own = [x for x in scans if column in x]
        assert own and all(f"EqualTo({column},42)" in x for x in own), table
