"""W3 source profile (counts, means, totals, shares, ranks) and W4 repair priority."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.functions import percent
from wellspring.operators import row_number_within, running_totals, top_n_within

TYPE = "type_of_water_source"
PEOPLE = "number_of_people_served"


def count_by(df: DataFrame, keys: Sequence[str], name: str = "record_count", weight: str | None = None) -> DataFrame:
    """Rows per key (partial counts per task, one shuffle of the partials).
    ``weight`` names a column that says how many rows each row stands for."""
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*keys).agg(rows.alias(name))


def top_counts(df: DataFrame, key: str, counted: str, k: int, name: str) -> DataFrame:
    """Top ``k`` keys by non-NULL count of ``counted``; ties broken by key.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top ``k`` and only those reach the final merge.
    """
    counts = df.groupBy(key).agg(F.count(counted).alias(name))
    return counts.orderBy(F.desc(name), F.asc(key)).limit(k)


def total_people(sources: DataFrame) -> DataFrame:
    return sources.agg(F.sum(PEOPLE).cast("bigint").alias("total"))


def people_by_type(sources: DataFrame) -> DataFrame:
    return sources.groupBy(TYPE).agg(F.sum(PEOPLE).cast("bigint").alias("total_people_served"))


def mean_people_by_type(sources: DataFrame) -> DataFrame:
    return sources.groupBy(TYPE).agg(F.round(F.avg(PEOPLE), 0).alias("avg_people_served"))


def people_share_by_type(sources: DataFrame) -> DataFrame:
    """Total and percent of all people per type; the grand total is an
    uncorrelated scalar subquery, computed once and inlined."""
    grand = sources.select(F.sum(PEOPLE)).scalar()
    return (people_by_type(sources)
            .withColumn("percentage", percent(F.col("total_people_served"), grand, 0)))


def rank_types_by_people(sources: DataFrame) -> DataFrame:
    """RANK() over the per-type totals: ties share a rank, gaps follow.

    The window has no partition, but it runs over the aggregated rows (one
    per type), never over detail rows.
    """
    w = Window.orderBy(F.desc("total_people_served"))
    return (people_by_type(sources)
            .withColumn("rank_by_people_served", F.rank().over(w).cast("bigint")))


def share_window(df: DataFrame, key: str, digits: int = 2, weight: str | None = None) -> DataFrame:
    """Share of rows per key, total taken by ``SUM(COUNT(*)) OVER ()``.

    The window has no partition, so it runs in one task over one row per
    key: meant for few-valued keys (location types). For keys with many
    values use ``share_of_summed_counts``, whose total is a distributed sum.
    """
    counts = count_by(df, [key], weight=weight)
    total = F.sum("record_count").over(Window.partitionBy())
    return counts.withColumn("percentage", percent(F.col("record_count"), total, digits))


def share_of_summed_counts(df: DataFrame, key: str, digits: int = 2, weight: str | None = None) -> DataFrame:
    """Share of rows per key, total taken as the sum of the per-key counts.

    The survey attaches that one-row total with a cross join; here it is a
    scalar subquery over the (already tiny) count frame, evaluated once.
    """
    counts = count_by(df, [key], weight=weight)
    total = counts.select(F.sum("record_count")).scalar()
    return counts.withColumn("percentage", percent(F.col("record_count"), total, digits))


def ranked_sources(sources: DataFrame) -> DataFrame:
    """Rank of every source inside its type, most people first, then id.

    Uses the skew-proof numbering: five types would otherwise mean five
    tasks holding the whole table between them.
    """
    ranked = row_number_within(sources, [TYPE],
                               [F.desc(PEOPLE), F.asc("source_id")], out="source_rank")
    return ranked.withColumn("source_rank", F.col("source_rank").cast("bigint"))


MOST_PICKS = 64


def pick_ranked(sources: DataFrame, source_ids: Sequence) -> DataFrame:
    """Rank inside type of the listed sources only, ranks counted among all
    sources of the type (the filter must not narrow the ranking).

    No ranking is sorted or stored: one aggregation counts the sources per type, people served and place of the id
    between the listed ones, and running totals over those few counts give how many come before each listed
    source. Beyond ``MOST_PICKS`` ids the whole ranking is made and filtered, as comparing every row
    with every listed id would cost more.
    """
    picked = sorted({i for i in source_ids if i is not None})
    if len(picked) > MOST_PICKS:
        ranked = ranked_sources(sources).filter(F.col("source_id").isin(picked))
        return ranked.orderBy(F.asc(TYPE), F.desc("source_rank"))
    of_type = sources.schema["source_id"].dataType
    listed = F.col("source_id").isin(picked)
    # an odd cell is a listed id, an even one lies between two of them; ids that are NULL come first
    below = sum(((F.col("source_id") > F.lit(i).cast(of_type)).cast("int") for i in picked), F.lit(0))
    cell = F.coalesce(2 * below + listed.cast("int"), F.lit(-1))
    counts = sources.groupBy(TYPE, PEOPLE, cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    before = running_totals(counts, [TYPE], [F.desc(PEOPLE), "cell"], "n", "before", "rank_counts")
    before = before.filter(F.col("cell") % 2 == 1).select(
        F.col(TYPE).alias("_ws_type"), F.col(PEOPLE).alias("_ws_people"), F.col("cell").alias("_ws_cell"), "before")
    rows = sources.filter(listed).withColumn("_ws_of", cell)
    alike = Window.partitionBy("_ws_of", TYPE, PEOPLE).orderBy("source_id")  # rows that repeat a listed id
    rows = rows.withColumn("_ws_nth", F.row_number().over(alike))
    same = (F.col("_ws_of") == F.col("_ws_cell")) & F.col(TYPE).eqNullSafe(F.col("_ws_type")) \
        & F.col(PEOPLE).eqNullSafe(F.col("_ws_people"))
    ranked = rows.join(before, same).withColumn("source_rank", F.col("before") + F.col("_ws_nth"))
    return (ranked.select(*sources.columns, F.col("source_rank").cast("bigint"))
            .orderBy(F.asc(TYPE), F.desc("source_rank")))


def top_sources_per_type(sources: DataFrame, n: int = 10) -> DataFrame:
    top = top_n_within(sources.select("source_id", TYPE, PEOPLE), [TYPE],
                       [F.desc(PEOPLE), F.asc("source_id")], n, out="source_rank")
    return top.withColumn("source_rank", F.col("source_rank").cast("bigint"))
