"""The command-line runner, in-process (it reuses the test session)."""

from wellspring.__main__ import main


def test_list(capsys):
    assert main(["--list"]) == 0
    keys = capsys.readouterr().out.split()
    assert "town_source_share" in keys and len(keys) >= 60


def test_run_to_parquet(spark, sf_small, tmp_path):
    out = str(tmp_path / "results")
    assert main(["count_by_type", "served_by_type", sf_small, "--out", out]) == 0
    got = spark.read.parquet(f"{out}/count_by_type")
    assert got.count() == 6
    assert spark.read.parquet(f"{out}/served_by_type").count() == 6
    assert spark.range(3).count() == 3  # the session is still usable


def test_sql_over_survey_views(spark, sf_small, tmp_path):
    out = str(tmp_path / "sql")
    sql = "select source_type, count(*) as n from combined_analysis_table group by source_type"
    assert main(["--sql", sql, sf_small, "--out", out]) == 0
    got = {r.source_type: r.n for r in spark.read.parquet(f"{out}/sql").collect()}
    assert sum(got.values()) == 874  # combined view rows at sf0.001
    for name in ("combined_analysis_table", "Incorrect_records", "queue_log", "water_quality"):
        assert spark.catalog.tableExists(name)
