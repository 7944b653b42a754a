"""Ranking inside groups that may be few and huge."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.operators.scans import materialize


def _asc(c) -> Column:
    return F.col(c).asc() if isinstance(c, str) else c


def top_n_within(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence, n: int,
                 out: str = "rn") -> DataFrame:
    """First ``n`` rows of each group by ``order_cols`` (ROW_NUMBER <= n).

    A row-number filter lets Spark insert a partial WindowGroupLimit before
    the shuffle: each task forwards at most ``n`` rows per group, so even a
    group holding a third of the table moves only ``n`` rows per task.
    """
    w = Window.partitionBy(*partition_cols).orderBy(*[_asc(c) for c in order_cols])
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= n)


def running_totals(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence, value: Column | str,
                   out: str, name: str = "running_totals", write: Callable = materialize,
                   num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows of the same group
    that come earlier in ``order_cols`` (rows that tie come in any order).

    A plain window puts each group into one task. Instead the rows are
    range-partitioned by (group, order) and stored once in the shared folder
    together with their partition's number (``write``), so that every later
    step reads the same placement, whatever the optimizer prunes or reuses.
    The sums of each (partition, group) block, a small table, give the block
    its offset; inside a block a window adds up.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = F.col(value) if isinstance(value, str) else value
    keys = [F.col(c).asc_nulls_first() for c in partition_cols] + [_asc(c) for c in order_cols]
    placed = write(df.withColumn("_ws_value", value).repartitionByRange(n, *keys)
                   .withColumn("_ws_part", F.spark_partition_id()), name)
    sums = placed.groupBy("_ws_part", *partition_cols).agg(F.sum("_ws_value").alias("_ws_sum"))
    before = Window.partitionBy(*partition_cols).orderBy("_ws_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_ws_offset", F.coalesce(F.sum("_ws_sum").over(before), F.lit(0))).drop("_ws_sum")
    offsets = offsets.toDF(*["_ws_o_" + c for c in offsets.columns])
    same = F.col("_ws_part") == F.col("_ws_o__ws_part")
    for c in partition_cols:
        same = same & F.col(c).eqNullSafe(F.col("_ws_o_" + c))
    inside = Window.partitionBy("_ws_part", *partition_cols).orderBy(*[_asc(c) for c in order_cols]).rowsBetween(
        Window.unboundedPreceding, -1)
    return (placed.withColumn("_ws_in", F.coalesce(F.sum("_ws_value").over(inside), F.lit(0)))
            .join(offsets, same).withColumn(out, F.col("_ws_in") + F.col("_ws_o__ws_offset"))
            .select(*df.columns, out))


def row_number_within(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence,
                      out: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY partition_cols ORDER BY order_cols)`` for every row,
    whatever other columns it has, with large groups spread over many tasks (``running_totals``).

    The order must be total (end ``order_cols`` with a unique key) for the
    numbering to be reproducible.
    """
    numbered = running_totals(df, partition_cols, order_cols, F.lit(1).cast("bigint"), out, "row_numbers",
                              num_partitions=num_partitions)
    return numbered.withColumn(out, F.col(out) + 1)
