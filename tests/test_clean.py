"""W1 cleaning and W2 e-mail fill on hand-built edge rows (FIXTURES.md: clean_prefix, byte_length)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.functions import byte_length
from wellspring.plans import clean

from tests.util import plan_text

POLLUTION = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("results", T.StringType()),
    T.StructField("biological", T.DoubleType()),
])

ROWS = [
    ("w1", "Clean", "Clean", 0.0),                                   # bare 'Clean' is fine
    ("w2", "Clean Bacteria: E. coli", "Clean", 0.02),                # mislabel + contradiction
    ("w3", "Clean Bacteria: Giardia Lamblia", "Contaminated: Biological", 0.5),
    ("w4", "Bacteria: Virus", "Clean", 0.011),                       # just above the limit
    ("w5", "Clean", "Clean", 0.01),                                  # at the limit: not above
    ("w6", None, None, None),
]


def _poll(spark):
    return spark.createDataFrame(ROWS, POLLUTION)


def ids(df):
    return sorted(r.source_id for r in df.select("source_id").collect())


def test_contradictions_use_strict_limit(spark):
    assert ids(clean.contradictions(_poll(spark))) == ["w2", "w4"]


def test_like_needs_a_character_after_clean(spark):
    assert ids(clean.mislabelled(_poll(spark))) == ["w2", "w3"]


def test_corrections_apply_in_order(spark):
    fixed = {r.source_id: r for r in clean.correct(_poll(spark)).collect()}
    assert fixed["w2"].description == "Bacteria: E. coli"
    assert fixed["w2"].results == "Contaminated: Biological"
    assert fixed["w3"].description == "Bacteria: Giardia Lamblia"
    assert fixed["w4"].results == "Contaminated: Biological"
    assert fixed["w5"].results == "Clean"
    assert fixed["w1"].description == "Clean"
    assert fixed["w6"].description is None and fixed["w6"].results is None


def test_verification_counts_before_and_after(spark):
    row = clean.verification(_poll(spark)).first()
    assert (row.violations_before, row.violations_after) == (3, 0)


def test_verification_is_one_scan_without_shuffle(spark):
    plan = plan_text(clean.verification(_poll(spark)))
    assert "Join" not in plan


def test_email_fill(spark):
    staff = spark.createDataFrame([(1, "Ada Obi"), (2, None), (3, "Kofi  Mensah")],
                                  "assigned_employee_id long, employee_name string")
    got = {r.assigned_employee_id: r.email for r in clean.with_email(staff).collect()}
    domain = clean.EMAIL_DOMAIN
    assert got == {1: f"ada.obi@{domain}", 2: None, 3: f"kofi..mensah@{domain}"}


def test_byte_length_counts_bytes_not_characters(spark):
    df = spark.createDataFrame([("abc",), ("café",), ("日本",)], "t string")
    got = [r.n for r in df.select(byte_length(F.col("t")).alias("n")).collect()]
    assert got == [3, 5, 6]
