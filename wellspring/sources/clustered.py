"""Tables laid out for point lookups: files clustered by a key, with Parquet Bloom filters on it.

Rows are range-partitioned and sorted by the key, so that each row group holds a narrow range of it and
its minimum and maximum rule out nearly all others; a Bloom filter in each row group rules out the rest for keys that
lie in the range but don't occur. Spark's Parquet reader uses both when a filter on the key reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, path: str, key: str, files: int | None = None, row_group_bytes: int = 128 << 20,
                    distinct_in_group: int | None = None) -> None:
    """Write ``df`` to a new table at ``path``. ``distinct_in_group`` (by default Parquet's own sizing) is the number of
    different keys that a row group's Bloom filter is made for."""
    spark = df.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, F.col(key).asc()).sortWithinPartitions(F.col(key).asc())
    options = {"parquet.block.size": str(row_group_bytes), f"parquet.bloom.filter.enabled#{key}": "true",
               "parquet.enable.dictionary": "true", f"parquet.enable.dictionary#{key}": "false"}
    if distinct_in_group:
        options[f"parquet.bloom.filter.expected.ndv#{key}"] = str(distinct_in_group)
    placed.write.options(**options).mode("errorifexists").parquet(path)


def lookup(spark: SparkSession, path: str, key: str, values: list) -> DataFrame:
    """The rows whose key is one of ``values``; the filter reaches the row groups."""
    rows = spark.read.parquet(path)
    return rows.filter(F.col(key) == values[0]) if len(values) == 1 else rows.filter(F.col(key).isin(list(values)))
