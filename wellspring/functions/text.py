"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def email_address(name: Column, domain: str) -> Column:
    """first.last@domain: spaces become dots, all lower case.

    NULL name gives NULL (string concatenation is NULL-strict).
    """
    local = F.lower(F.replace(name, F.lit(" "), F.lit(".")))
    return F.concat(local, F.lit("@" + domain))


def byte_length(text: Column) -> Column:
    """Length in bytes of the UTF-8 text (what MySQL's LENGTH returns)."""
    return F.octet_length(text).cast("bigint")


def mentions(text: Column, word: str) -> Column:
    """Case-insensitive substring test, ``LOWER(text) LIKE '%word%'``."""
    return F.lower(text).contains(word.lower())


# The collation of text that is compared without regard to case.
CASE_BLIND = "UTF8_LCASE"


def case_blind(text: Column | str) -> Column:
    """``text`` compared like in the survey's server: ``=``, ``IN``, ``LIKE``, ``GROUP BY`` and joins on it don't tell
    upper from lower case. The text itself stays as it is."""
    return F.collate(F.col(text) if isinstance(text, str) else text, CASE_BLIND)


def plain(text: Column | str) -> Column:
    """``text`` without a collation, compared by its bytes."""
    return F.collate(F.col(text) if isinstance(text, str) else text, "UTF8_BINARY")
