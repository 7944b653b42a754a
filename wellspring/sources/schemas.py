"""Declared schemas of the survey's own tables.

Types follow how the survey's statements use each column (see FIXTURES.md):
ids of sites and sources are text, employee and record ids are integers,
scores and counts are integers, times are timestamps. Reading with a
declared schema means no inference pass over the files and a type error at
read time instead of a wrong answer later.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SURVEY_SCHEMAS: dict[str, T.StructType] = {
    "location": _schema(("location_id", _S), ("address", _S), ("province_name", _S), ("town_name", _S),
                        ("location_type", _S)),
    "visits": _schema(("record_id", _L), ("location_id", _S), ("source_id", _S),
                      ("assigned_employee_id", _L), ("visit_count", _I), ("time_in_queue", _I),
                      ("time_of_record", _TS)),
    "water_source": _schema(("source_id", _S), ("type_of_water_source", _S),
                            ("number_of_people_served", _I)),
    "water_quality": _schema(("record_id", _L), ("subjective_quality_score", _I), ("visit_count", _I)),
    "well_pollution": _schema(("source_id", _S), ("description", _S), ("results", _S), ("biological", _D)),
    "employee": _schema(("assigned_employee_id", _L), ("employee_name", _S), ("email", _S),
                        ("phone_number", _S), ("town_name", _S)),
    "auditor_report": _schema(("location_id", _S), ("type_of_water_source", _S),
                              ("true_water_source_score", _I), ("statements", _S)),
}
