"""SQL users: the survey's statements run through spark.sql on registered views
and agree with the DataFrame jobs."""

import pytest

import __spark_entry__ as E
from wellspring.plans.views import drop_survey_views, register_survey_views, role_tables


@pytest.fixture(scope="module")
def views(spark, sf_small):
    names = register_survey_views(spark, role_tables(spark, sf_small))
    yield names
    drop_survey_views(spark, names)


def _same(a, b):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


def test_town_share_in_sql(spark, sf_small, views):
    cols = ",\n".join(
        f"round(sum(if(source_type = '{t}', people_served, 0)) * 100D / sum(people_served), 0) as {t}"
        for t in ["river", "shared_tap", "tap_in_home", "tap_in_home_broken", "well"])
    sql = f"""
    select province_name, town_name,
    {cols}
    from combined_analysis_table
    group by province_name, town_name"""
    assert _same(spark.sql(sql), E.queries()["town_source_share"](spark, sf_small))


def test_suspects_in_sql(spark, sf_small, views):
    sql = """
    with per_name as (
      select employee_name, count(employee_name) as n from Incorrect_records group by employee_name)
    select i.employee_name, i.location_id, i.statements
    from Incorrect_records i
    where i.employee_name in (select employee_name from per_name
                              where n > (select avg(n) from per_name))
      and lower(i.statements) like '%urgent%'"""
    assert _same(spark.sql(sql), E.queries()["suspect_statements"](spark, sf_small))


def test_first_visit_audit_in_sql(spark, sf_small, views):
    sql = """
    select a.location_id, v.record_id, a.true_water_source_score as auditor_score,
           q.subjective_quality_score as surveyor_score
    from auditor_report a
    join visits v on v.location_id = a.location_id and v.visit_count = 1
    join water_quality q on q.record_id = v.record_id and q.visit_count = v.visit_count
    where a.true_water_source_score = q.subjective_quality_score"""
    got = spark.sql(sql)
    want = E.queries()["audit_match_first"](spark, sf_small)
    # record ids repeat in the role data, so the SQL join may fan out; the
    # distinct rows must agree
    assert _same(got.distinct(), want.distinct())


def test_queue_weekday_in_sql(spark, sf_small, views):
    # the queue log is not one of the survey's base tables; register it here
    from wellspring.sources import Tables
    from wellspring.sources import roles as R
    R.queue_log(Tables(spark, sf_small)).createOrReplaceTempView("queue_log")
    sql = """
    select date_format(time_of_record, 'EEEE') as day_of_week, round(avg(time_in_queue)) as avg_queue_time
    from queue_log where time_in_queue > 0 group by 1"""
    assert _same(spark.sql(sql), E.queries()["queue_by_weekday"](spark, sf_small))
    spark.catalog.dropTempView("queue_log")
