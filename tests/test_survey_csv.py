"""Survey tables as CSV dumps with the survey's own types (a hand-built survey)."""

import datetime as dt

import pytest

from wellspring.sources.schemas import SURVEY_SCHEMAS
from wellspring.survey import Survey

ROWS = {
    "location": [("L1", "1 Main St", "Akatsi", "Harare", "Urban"),
                 ("L2", "2 Side St", "Kilimani", "Harare", "Rural"),
                 ("L3", "3 Hill Rd", "Kilimani", "Amina", "Rural")],
    "water_source": [("S1", "well", 100), ("S2", "shared_tap", 300), ("S3", "river", 50)],
    "visits": [(1, "L1", "S1", 10, 1, 0, dt.datetime(2024, 1, 6, 6, 15)),    # Saturday
               (2, "L2", "S2", 11, 1, 95, dt.datetime(2024, 1, 6, 6, 45)),
               (3, "L3", "S3", 11, 1, 20, dt.datetime(2024, 1, 8, 18, 5)),  # Monday
               (4, "L2", "S2", 11, 2, 40, dt.datetime(2024, 1, 9, 7, 0))],  # revisit
    "water_quality": [(1, 8, 1), (2, 4, 1), (3, 9, 1), (4, 4, 2)],
    "well_pollution": [("S1", "Clean Bacteria: E. coli", "Clean", 0.3)],
    "employee": [(10, "Ada Obi", None, "555-0100", "Harare"), (11, "Kofi Mensah", None, "555-0101", "Amina")],
    "auditor_report": [("L1", "well", 8, "all fine"), ("L2", "shared_tap", 7, "took CASH"),
                       ("L3", "river", 2, "Cash offered")],
}


@pytest.fixture(scope="module")
def survey(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("dumps")
    for name, schema in SURVEY_SCHEMAS.items():
        spark.createDataFrame(ROWS[name], schema).write.option("header", True).csv(str(root / f"{name}.csv"))
    return Survey.from_csv(spark, str(root))


def test_declared_types(survey):
    assert dict(survey.visits.dtypes)["time_in_queue"] == "int"
    assert dict(survey.auditor_report.dtypes)["true_water_source_score"] == "int"


def test_shares_and_queues(survey):
    shares = {(r.province_name, r.town_name): r for r in survey.town_share().collect()}
    assert shares[("Akatsi", "Harare")].well == 100.0
    assert shares[("Kilimani", "Harare")].shared_tap == 100.0
    assert survey.mean_queue().first()[0] == round((95 + 20 + 40) / 3, 4)
    heat = {r.hour_of_day: r for r in survey.queue_heatmap().collect()}
    assert heat["06:00"].Saturday == 95.0 and heat["18:00"].Monday == 20.0


def test_audit_with_separate_quality_table(survey):
    acc = survey.audit_accuracy().first()
    assert (acc.audited, acc.agreeing, acc.disagreeing) == (3, 1, 2)
    mistakes = {r.employee_name: r.number_of_mistakes for r in survey.mistakes_per_employee().collect()}
    assert mistakes == {"Kofi Mensah": 2}
    # one employee, mean 2: nobody is strictly above it, so the evidence is the control group
    assert survey.suspect_evidence("cash").count() == 0
    assert survey.suspect_evidence("cash", suspected=False).count() == 2


def test_work_orders_raw_and_cleaned(survey):
    raw = {r.source_id: r.Improvement for r in survey.work_orders().collect()}
    assert raw == {"S2": "Install 3 taps nearby", "S3": "Drill well"}
    cleaned = {r.source_id: r.Improvement for r in survey.work_orders(cleaned=True).collect()}
    assert cleaned["S1"] == "Install UV filter"
    emails = {r.employee_name: r.email for r in survey.employees_with_email().collect()}
    assert emails["Ada Obi"].startswith("ada.obi@")


def test_sql_over_the_survey_views(spark, survey):
    from wellspring.plans.views import drop_survey_views
    names = survey.register_views()
    try:
        rows = spark.sql("""
            select employee_name, count(*) as n from Incorrect_records
            where lower(statements) like '%cash%' group by employee_name""").collect()
        assert [(r.employee_name, r.n) for r in rows] == [("Kofi Mensah", 2)]
        total = spark.sql("select sum(people_served) as p from combined_analysis_table").first().p
        assert total == 450
    finally:
        drop_survey_views(spark, names)
