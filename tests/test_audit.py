"""W6/W7 audit and suspects (FIXTURES.md: audit_fanout, suspects)."""

import pytest

from wellspring.operators import not_in, semi_join
from wellspring.plans import audit

AUDITOR = "location_id string, type_of_water_source string, true_water_source_score int, statements string"
VISITS = ("location_id string, record_id long, assigned_employee_id long, source_id long, "
          "visit_count int, subjective_quality_score int")
EMPLOYEE = "assigned_employee_id long, employee_name string"


def _auditor(spark):
    return spark.createDataFrame([
        ("A1", "well", 5, "Took CASH from me"),
        ("A2", "river", 7, "all fine"),
        ("A3", "shared_tap", None, "cash"),
        ("A4", "well", 2, "paid in cash"),
    ], AUDITOR)


def _visits(spark):
    return spark.createDataFrame([
        ("A1", 1, 1, 100, 1, 4),   # first visit, disagrees
        ("A1", 2, 1, 100, 2, 5),   # revisits agree but are not compared
        ("A1", 3, 2, 100, 3, 5),
        ("A2", 4, 2, 200, 1, 7),   # agrees
        ("A3", 5, 3, 300, 1, 3),   # auditor score unknown
        ("A4", 6, 3, 400, 1, 9),   # disagrees
    ], VISITS)


def _employee(spark):
    return spark.createDataFrame([(1, "Ada Obi"), (2, "Esi Owusu"), (3, "Ada Obi")], EMPLOYEE)


def test_first_visit_filter_removes_fanout(spark):
    pairs = audit.audit_pairs(_auditor(spark), _visits(spark))
    assert pairs.count() == 4
    assert sorted(r.location_id for r in audit.agreeing(pairs).collect()) == ["A2"]
    assert sorted(r.location_id for r in audit.disagreeing(pairs).collect()) == ["A1", "A4"]


def test_all_visits_without_filter(spark):
    pairs = audit.audit_pairs(_auditor(spark), _visits(spark), first_visit_only=False)
    assert sorted(r.record_id for r in audit.agreeing(pairs).collect()) == [2, 3, 4]


def test_accuracy_invariant(spark):
    r = audit.accuracy(audit.audit_pairs(_auditor(spark), _visits(spark))).first()
    assert (r.audited, r.agreeing, r.disagreeing) == (3, 1, 2)
    assert r.agreeing + r.disagreeing == r.audited
    assert r.accuracy_pct == 33.33


def test_separate_quality_table(spark):
    visits = _visits(spark).drop("subjective_quality_score")
    quality = _visits(spark).select("record_id", "subjective_quality_score")
    a = audit.audit_pairs(_auditor(spark), visits, quality)
    b = audit.audit_pairs(_auditor(spark), _visits(spark))
    assert sorted(a.collect()) == sorted(b.collect())


def test_mistakes_merge_namesakes(spark):
    m = audit.mistakes_per_employee(_auditor(spark), _visits(spark), _employee(spark))
    assert {r.employee_name: r.number_of_mistakes for r in m.collect()} == {"Ada Obi": 2}


def test_suspects_need_strictly_more_than_mean(spark):
    m = spark.createDataFrame([("a", 2), ("b", 2), ("c", 2)], "employee_name string, number_of_mistakes long")
    assert audit.suspects(m).count() == 0
    m2 = spark.createDataFrame([("a", 1), ("b", 2), ("c", 6)], "employee_name string, number_of_mistakes long")
    assert [r.employee_name for r in audit.suspects(m2).collect()] == ["c"]


def test_keyword_is_case_insensitive(spark):
    inc = audit.incorrect_records(_auditor(spark), _visits(spark), _employee(spark))
    assert sorted(r.location_id for r in audit.statements_of(inc, "cash").collect()) == ["A1", "A4"]


def test_evidence_and_control_split_the_statements(spark):
    a, v, e = _auditor(spark), _visits(spark), _employee(spark)
    sus = audit.suspect_evidence(a, v, e, "cash").collect()
    ctl = audit.suspect_evidence(a, v, e, "cash", suspected=False).collect()
    # one name, two mistakes: mean 2, nobody strictly above it
    assert sus == []
    assert sorted(r.location_id for r in ctl) == ["A1", "A4"]


# --- NOT IN / IN against Spark SQL's own semantics (brute-force oracle) ------

CASES = {
    "plain": ([("x",), ("y",), (None,)], [("x",)]),
    "null_in_list": ([("x",), ("y",)], [("x",), (None,)]),
    "empty_list": ([("x",), (None,)], []),
    "duplicates": ([("x",), ("y",), ("y",)], [("x",), ("x",)]),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_not_in_matches_sql(spark, case):
    left_rows, right_rows = CASES[case]
    left = spark.createDataFrame(left_rows, "k string")
    right = spark.createDataFrame(right_rows, "k string")
    left.createOrReplaceTempView("l_fixture")
    right.createOrReplaceTempView("r_fixture")
    want = spark.sql("SELECT k FROM l_fixture WHERE k NOT IN (SELECT k FROM r_fixture)").collect()
    got = not_in(left, right, "k").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    want_in = spark.sql("SELECT k FROM l_fixture WHERE k IN (SELECT k FROM r_fixture)").collect()
    got_in = semi_join(left, right, "k").collect()
    assert sorted(map(tuple, got_in), key=str) == sorted(map(tuple, want_in), key=str)


def test_semi_and_anti_keep_left_column_order(spark):
    left = spark.createDataFrame([(1, "x", "s")], "id long, k string, t string")
    right = spark.createDataFrame([("x",)], "k string")
    assert semi_join(left, right, "k").columns == ["id", "k", "t"]
    assert not_in(left, right, "k").columns == ["id", "k", "t"]
