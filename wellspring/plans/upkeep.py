"""Stored results kept up to date: access by town from partial sums of batches, and corrections in place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.functions import apply_updates, percent
from wellspring.operators import append_batch, materialize
from wellspring.plans.access import SOURCE_TYPES

PLACE = ["province_name", "town_name"]


# --- access by town (A7, W9) ---------------------------------------------------------------

def people_sums(view: DataFrame) -> DataFrame:
    """People per (province, town, source type) of a combined view: sums that add up over batches of visits."""
    return view.groupBy(*PLACE, "source_type").agg(F.sum("people_served").cast("bigint").alias("people"))


def add_batch(view: DataFrame, path: str, batch: str) -> None:
    """Add the sums of a batch's combined view to the table at ``path``. Only the batch is read; a batch that the
    table holds already is not added again."""
    append_batch(people_sums(view), path, "kind", "people", batch)


def stored_shares(spark: SparkSession, path: str, types: Sequence[str] = SOURCE_TYPES, digits: int = 0) -> DataFrame:
    """Percent of people per source type and town over all batches added to ``path``: sums of sums, so the work is that
    of the towns and batches, not of the visits."""
    sums = spark.read.parquet(f"{path}/kind=people").groupBy(*PLACE).agg(
        *[F.sum(F.when(F.col("source_type") == t, F.col("people")).otherwise(0)).alias("_ws_" + t) for t in types],
        F.sum("people").alias("_ws_total"))
    return sums.select(*PLACE, *[percent(F.col("_ws_" + t), F.col("_ws_total"), digits).alias(t) for t in types])


def compact(spark: SparkSession, path: str, into: str) -> None:
    """All batches of ``path`` merged into one batch of a new table ``into``. The old table stays."""
    merged = spark.read.parquet(f"{path}/kind=people").groupBy(*PLACE, "source_type").agg(
        F.sum("people").cast("bigint").alias("people"))
    append_batch(merged, into, "kind", "people", "compacted")


# --- corrections that rewrite only what changes (A4, A5, W1) --------------------------------

def store_partitioned(df: DataFrame, path: str, partition: str) -> None:
    """Write ``df`` to a new table at ``path``, a folder for each value of ``partition``."""
    df.repartition(F.col(partition)).write.partitionBy(partition).mode("errorifexists").parquet(path)


def correct_partial(spark: SparkSession, path: str, rules: Sequence[tuple[str, Column, Column]],
                    partition: str) -> list:
    """Apply ordered ``UPDATE`` rules to the table at ``path`` in place, rewriting only partitions that hold a row which
    a rule changes; returns their values. The files of all others stay as they are.

    A filter finds the partitions (their values reach the driver: the folder names of a table). Rules run in order, and a
    rule may match only what an earlier one has changed, so a row counts as changed if the rules' result differs. The
    new partitions are first stored apart, as a table can't be read while it is replaced, and then swapped
    in by a dynamic partition overwrite; a lost executor repeats its tasks, and a lost driver's run is repeated whole,
    since the rules leave rows that they have corrected alone. A column that partitions the table can't be corrected.
    """
    touched = [c for c, _, _ in rules]
    if partition in touched:
        raise ValueError(f"{partition} partitions the table and can't be corrected in place")
    rows = spark.read.parquet(path)
    before = rows.withColumns({f"_ws_old_{c}": F.col(c) for c in dict.fromkeys(touched)})
    fixed = apply_updates(before, list(rules))
    changed = F.lit(False)
    for c in dict.fromkeys(touched):
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_ws_old_{c}"))
    values = [r[0] for r in fixed.filter(changed).select(partition).distinct().collect()]
    if not values:
        return []
    named, null = [v for v in values if v is not None], None in values
    hit = F.col(partition).isin(named) if named else F.lit(False)
    hit = hit | F.col(partition).isNull() if null else hit
    staged = materialize(apply_updates(rows.filter(hit), list(rules)), "corrected_partitions")
    (staged.select(*rows.columns).repartition(F.col(partition)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))
    return sorted(values, key=lambda v: (v is not None, v))
