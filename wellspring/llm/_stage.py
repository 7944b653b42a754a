"""Input columns by exact name, stored intermediate tables, table readers."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.operators import drop_table
from wellspring.operators.scans import fresh_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def take(df: DataFrame, *names: str) -> DataFrame:
    """The first column of exactly each name. Other columns, also ones whose
    names differ in case only or occur twice, don't get in the way."""
    have = df.columns
    missing = [n for n in names if n not in have]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {have}")
    placed = df.toDF(*[f"_c{i}" for i in range(len(have))])
    return placed.select(*[placed[f"_c{have.index(n)}"].alias(n) for n in names])


def with_row(df: DataFrame, *names: str) -> DataFrame:
    """``take`` plus all columns of the input packed in the struct ``_ws_row``
    (fields by place: ``c0``, ``c1``, ...), to restore them with ``unpack``."""
    have = df.columns
    missing = [n for n in names if n not in have]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {have}")
    placed = df.toDF(*[f"_c{i}" for i in range(len(have))])
    row = F.struct(*[placed[f"_c{i}"].alias(f"c{i}") for i in range(len(have))])
    return placed.select(*[placed[f"_c{have.index(n)}"].alias(n) for n in names], row.alias("_ws_row"))


def unpack(columns: list[str], replace: dict[str, Column] | None = None) -> list[Column]:
    """The columns that ``with_row`` packed, some replaced."""
    replace = replace or {}
    return [(replace[c] if c in replace else F.col(f"_ws_row.c{i}")).alias(c) for i, c in enumerate(columns)]


@contextmanager
def _no_shuffle_kept(spark: SparkSession):
    """While it holds, a finished write drops the shuffle files that made it."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


_recorders: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]):
    """While it holds, ``paths`` gets the folder of every table that ``store`` writes."""
    _recorders.append(paths)
    try:
        yield
    finally:
        _recorders.remove(paths)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later steps
    and retried tasks start from those files, and the shuffle files behind
    them are freed as soon as the write has ended."""
    path = fresh_path(df, name, temporary=True)
    for paths in _recorders:
        paths.append(path)
    with _no_shuffle_kept(df.sparkSession):
        df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_unread(paths: list[str], docs: DataFrame) -> None:
    """Delete the stored tables of ``paths`` that ``docs`` isn't read from, and take them off the list."""
    read = docs.inputFiles() if paths else []
    for path in list(paths):
        if not any(path.split(":", 1)[-1] in f for f in read):
            drop_table(docs.sparkSession, path)
            paths.remove(path)
