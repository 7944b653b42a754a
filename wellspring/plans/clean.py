"""W1 pollution cleaning and W2 staff e-mail fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.functions import apply_updates, email_address

# Fixed values of the cleaning job.
CLEAN = "Clean"
CONTAMINATED_BIOLOGICAL = "Contaminated: Biological"
BIOLOGICAL_LIMIT = 0.01
MISLABELLED_DESCRIPTIONS = [
    ("Clean Bacteria: E. coli", "Bacteria: E. coli"),
    ("Clean Bacteria: Giardia Lamblia", "Bacteria: Giardia Lamblia"),
]
CLEAN_WITH_SUFFIX = "Clean_%"  # LIKE pattern: 'Clean' plus at least one more character
EMAIL_DOMAIN = "ndogowater.gov"


def marked_clean_but_contaminated(limit: float = BIOLOGICAL_LIMIT) -> Column:
    return (F.col("results") == CLEAN) & (F.col("biological") > limit)


def clean_prefixed_description(limit: float = BIOLOGICAL_LIMIT) -> Column:
    return F.col("description").like(CLEAN_WITH_SUFFIX) & (F.col("biological") > limit)


def contradictions(pollution: DataFrame, limit: float = BIOLOGICAL_LIMIT) -> DataFrame:
    """Rows recorded as clean although the biological reading is above the limit."""
    return pollution.filter(marked_clean_but_contaminated(limit))


def mislabelled(pollution: DataFrame, limit: float = BIOLOGICAL_LIMIT) -> DataFrame:
    """Rows whose description starts with 'Clean' followed by more text."""
    return pollution.filter(clean_prefixed_description(limit))


def corrections(limit: float = BIOLOGICAL_LIMIT) -> list[tuple[str, Column, Column]]:
    """The ordered UPDATE statements of the cleaning job, as data."""
    rules = [("description", F.lit(fixed), F.col("description") == wrong)
             for wrong, fixed in MISLABELLED_DESCRIPTIONS]
    rules.append(("results", F.lit(CONTAMINATED_BIOLOGICAL), marked_clean_but_contaminated(limit)))
    return rules


def correct(pollution: DataFrame, limit: float = BIOLOGICAL_LIMIT) -> DataFrame:
    """The pollution table with all corrections applied, in order."""
    return apply_updates(pollution, corrections(limit))


def violation(limit: float = BIOLOGICAL_LIMIT) -> Column:
    """What the verification query looks for; must match no row after ``correct``."""
    return F.col("description").like(CLEAN_WITH_SUFFIX) | marked_clean_but_contaminated(limit)


def verification(pollution: DataFrame, limit: float = BIOLOGICAL_LIMIT) -> DataFrame:
    """One row: violations before and after correction, counted in one scan."""
    flagged = pollution.withColumn("_ws_before", violation(limit))
    fixed = correct(flagged, limit)
    return fixed.agg(
        F.count_if(F.col("_ws_before")).cast("bigint").alias("violations_before"),
        F.count_if(violation(limit)).cast("bigint").alias("violations_after"),
    )


def with_email(staff: DataFrame, domain: str = EMAIL_DOMAIN) -> DataFrame:
    """``UPDATE employee SET email = CONCAT(LOWER(REPLACE(name,' ','.')), '@domain')``."""
    return staff.withColumn("email", email_address(F.col("employee_name"), domain))


def email_preview(staff: DataFrame) -> DataFrame:
    return staff.select(F.lower(F.replace(F.col("employee_name"), F.lit(" "), F.lit(".")))
                        .alias("email_local"))
