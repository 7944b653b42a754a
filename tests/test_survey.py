"""The Survey facade: same answers as the registered queries, from either
the test tables or survey tables stored as Parquet."""

from dataclasses import replace

import pytest

import __spark_entry__ as E
from wellspring.survey import TABLES, Survey


def _same(a, b):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    cols = sorted(a.columns)
    return (sorted(a.columns) == sorted(b.columns)
            and sorted(map(tuple, a.select(cols).collect()), key=key)
            == sorted(map(tuple, b.select(cols).collect()), key=key))


@pytest.fixture(scope="module")
def survey(spark, sf_small):
    return Survey.from_test_tables(spark, sf_small)


@pytest.mark.parametrize("method,key", [
    ("town_share", "town_source_share"),
    ("province_share", "province_source_share"),
    ("headline_shares", "headline_shares"),
    ("mistakes_per_employee", "mistakes_per_employee"),
    ("queue_heatmap", "queue_heatmap"),
    ("cleaning_check", "verify_clean"),
    ("work_order_violations", "work_orders_violations"),
])
def test_methods_match_registered_queries(spark, sf_small, survey, method, key):
    assert _same(getattr(survey, method)(), E.queries()[key](spark, sf_small))


def test_source_ranks_match_the_registered_query(spark, sf_small, survey):
    assert _same(survey.source_ranks(), E.queries()["priority_ranks"](spark, sf_small).drop("brand"))


def test_every_method_runs(survey, tmp_path):
    for name in ["contradictions", "mislabelled", "corrected_pollution", "employees_with_email",
                 "people_by_type", "people_share_by_type", "type_ranks", "location_type_share",
                 "top_sources", "survey_span", "mean_queue", "queue_by_weekday", "queue_by_hour",
                 "audit_accuracy", "incorrect_records", "suspects", "suspect_evidence",
                 "combined_view", "broken_tap_ratio", "work_orders"]:
        getattr(survey, name)().limit(1).collect()
    assert survey.ranks_of([3, 5]).count() == 2
    published = survey.publish_work_orders(path=str(tmp_path / "progress"))
    assert survey.progress(published).filter("level = 3").first().work_orders == published.count()


def test_from_parquet_survey_tables(spark, survey, tmp_path):
    root = tmp_path / "survey"
    for name in TABLES:
        if name == "water_quality":
            continue
        getattr(survey, name).write.parquet(str(root / name))
    stored = Survey.from_parquet(spark, str(root))
    assert stored.water_quality is None
    assert _same(stored.town_share(), survey.town_share())
    survey = replace(survey, water_quality=None)  # the visits' own scores
    assert _same(stored.suspect_evidence("urgent"), survey.suspect_evidence("urgent"))
