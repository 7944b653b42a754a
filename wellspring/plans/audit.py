"""W6 audit reconciliation and W7 suspect detection.

Inputs (columns used):

* auditor report: location_id, type_of_water_source, true_water_source_score, statements
* visits: location_id, record_id, assigned_employee_id, source_id, visit_count,
  and subjective_quality_score unless a separate quality table is given
* quality (optional): record_id, subjective_quality_score, and visit_count if it is to be pruned
* employee: assigned_employee_id, employee_name

The auditor visited each site once while surveyors came back several times,
so every comparison keeps first visits only, and that filter is applied to
the visits and to their scores before any join (it reaches both Parquet scans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.functions import mentions, percent
from wellspring.operators import hot_keys_by, materialize, not_in, semi_join, skew_join

# Fixed value: the word that marks an incriminating statement.
KEYWORD = "cash"


def audit_pairs(auditor: DataFrame, visits: DataFrame, quality: DataFrame | None = None,
                first_visit_only: bool = True, hot_sites: dict | list | None = None) -> DataFrame:
    """Auditor rows joined to the surveyors' visits of the same site.

    A quality row belongs to the visit of its record id and carries that visit's count, as the survey's
    table does, so first visits are filtered on both sides before their join. A quality table without the column
    is joined whole."""
    v = visits
    if first_visit_only:
        v = v.filter(F.col("visit_count") == 1)
        if quality is not None and "visit_count" in quality.columns:
            quality = quality.filter(F.col("visit_count") == 1)
    if quality is not None:
        v = v.drop("subjective_quality_score").join(
            quality.select("record_id", "subjective_quality_score"), "record_id")
    v = v.select("location_id", "record_id", "assigned_employee_id", "source_id", "visit_count",
                 F.col("subjective_quality_score").alias("surveyor_score"))
    a = auditor.select("location_id", F.col("type_of_water_source").alias("auditor_source"),
                       F.col("true_water_source_score").alias("auditor_score"), "statements")
    # visits are the large side; a site visited very often is split over tasks
    return skew_join(v, a, "location_id", hot=hot_sites, row_key=["record_id"])


def agreeing(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("auditor_score") == F.col("surveyor_score"))


def disagreeing(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("auditor_score") != F.col("surveyor_score"))


def accuracy(pairs: DataFrame) -> DataFrame:
    """One row: audited pairs, how many agree and disagree, and the rate."""
    scored = pairs.filter(F.col("auditor_score").isNotNull() & F.col("surveyor_score").isNotNull())
    same = F.count_if(F.col("auditor_score") == F.col("surveyor_score"))
    return scored.agg(
        F.count(F.lit(1)).alias("audited"),
        same.cast("bigint").alias("agreeing"),
        F.count_if(F.col("auditor_score") != F.col("surveyor_score")).cast("bigint").alias("disagreeing"),
        percent(same, F.count(F.lit(1)), 2).alias("accuracy_pct"),
    )


def with_survey_source(pairs: DataFrame, sources: DataFrame, hot: dict | list | None = None) -> DataFrame:
    """Attach the surveyed source type; a source with a large share of the
    pairs is split over several tasks (``hot``: ids found on an input scan)."""
    s = sources.select("source_id", F.col("type_of_water_source").alias("survey_source"))
    return skew_join(pairs, s, "source_id", hot=hot, row_key=["record_id"])


def with_employee(pairs: DataFrame, employee: DataFrame, hot: dict | list | None = None) -> DataFrame:
    """Attach employee names; an employee with a large share of the pairs
    is split over several tasks. ``hot`` (ids found on an input scan) saves
    scanning the joined pairs for them."""
    e = employee.select("assigned_employee_id", "employee_name")
    return skew_join(pairs, e, "assigned_employee_id", hot=hot, row_key=["record_id"])


def incorrect_records(auditor: DataFrame, visits: DataFrame, employee: DataFrame,
                      quality: DataFrame | None = None) -> DataFrame:
    """First visits whose surveyor score differs from the auditor's, with names."""
    hot = hot_keys_by(visits.filter(F.col("visit_count") == 1), ["location_id", "assigned_employee_id"])
    wrong = disagreeing(audit_pairs(auditor, visits, quality, hot_sites=hot["location_id"]))
    return with_employee(wrong, employee, hot=hot["assigned_employee_id"]).select(
        "location_id", "auditor_source", "record_id", "assigned_employee_id", "employee_name",
        "auditor_score", "surveyor_score", "statements")


def offenders(auditor: DataFrame, visits: DataFrame, employee: DataFrame,
              quality: DataFrame | None = None) -> DataFrame:
    """Distinct names of employees with at least one disagreeing first visit.

    Distinct ids are taken before the employee table is joined (partial
    de-duplication per task), so only one row per employee reaches that
    join instead of every disagreeing visit.
    """
    ids = disagreeing(audit_pairs(auditor, visits, quality)).select("assigned_employee_id").distinct()
    return (ids.join(employee.select("assigned_employee_id", "employee_name"), "assigned_employee_id")
            .select("employee_name").distinct())


def mistakes_per_employee(auditor: DataFrame, visits: DataFrame, employee: DataFrame,
                          quality: DataFrame | None = None) -> DataFrame:
    """``COUNT(employee_name)`` of disagreeing first visits per employee *name*.

    The detail rows are first counted per employee id (partial counts per
    task, so a very busy employee costs nothing extra), and only those
    counts meet the employee table. Namesakes merge, as in the survey.
    """
    wrong = disagreeing(audit_pairs(auditor, visits, quality))
    per_id = wrong.groupBy("assigned_employee_id").agg(F.count(F.lit(1)).alias("_n"))
    named = per_id.join(employee.select("assigned_employee_id", "employee_name"),
                        "assigned_employee_id")
    counted = F.when(F.col("employee_name").isNotNull(), F.col("_n")).otherwise(0)
    return named.groupBy("employee_name").agg(F.sum(counted).cast("bigint").alias("number_of_mistakes"))


def mean_mistakes(mistakes: DataFrame) -> DataFrame:
    return mistakes.agg(F.round(F.avg("number_of_mistakes"), 4).alias("avg_error_count_per_empl"))


def suspects(mistakes: DataFrame) -> DataFrame:
    """Employees with more mistakes than the mean (strictly more)."""
    mean = mistakes.select(F.avg("number_of_mistakes")).scalar()
    return mistakes.filter(F.col("number_of_mistakes") > mean)


def statements_of(incorrect: DataFrame, keyword: str = KEYWORD) -> DataFrame:
    return incorrect.filter(mentions(F.col("statements"), keyword))


def suspect_evidence(auditor: DataFrame, visits: DataFrame, employee: DataFrame,
                     keyword: str = KEYWORD, quality: DataFrame | None = None,
                     suspected: bool = True) -> DataFrame:
    """Statements mentioning ``keyword`` about suspects (or, with
    ``suspected=False``, about everyone else: the control query).

    ``Incorrect_records`` feeds the counts, the mean and the evidence, so it
    is computed once into a Parquet table in the shared folder: the count
    branch reads two of its columns, the evidence branch pushes its filter.
    """
    incorrect = materialize(incorrect_records(auditor, visits, employee, quality), "incorrect_records")
    mistakes = incorrect.groupBy("employee_name").agg(
        F.count("employee_name").alias("number_of_mistakes"))
    flagged = suspects(mistakes)
    evidence = statements_of(incorrect, keyword)
    if suspected:
        picked = semi_join(evidence, flagged, "employee_name", row_key=["record_id"])
    else:
        picked = not_in(evidence, flagged, "employee_name", row_key=["record_id"])
    return picked.select("employee_name", "location_id", "statements")
