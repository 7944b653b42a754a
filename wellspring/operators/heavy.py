"""Heavy hitters with a guarantee: mergeable frequent-item summaries of key columns.

A summary tracks at most ``tracked`` values of each column over *all* rows (Spark's frequent-items
sketch, ``approx_top_k_accumulate``): a value's count is overstated by at most ``error_share(tracked)`` of
the rows and never understated, so every value at or above a share that is larger than this is
in it, whatever the order of the rows or their spread over tasks. Summaries of batches combine into the
summary of the whole, so one can be kept with a table and brought up to date by reading only what was added.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 8192  # values of a column in memory at once, in each task
_KEPT = 256  # results that an application remembers
_remembered: OrderedDict[tuple, dict[str, dict]] = OrderedDict()


def error_share(tracked: int = TRACKED) -> float:
    """The share of all rows by which a count may be overstated, at most."""
    return 3.5 / tracked


def _called(name: str, *args: Column) -> Column:
    return F.call_function(name, *args)


def key_summary(df: DataFrame, keys: list[str], tracked: int = TRACKED) -> DataFrame:
    """One row that sums up the columns ``keys`` of ``df``: ``rows``, and for each column a sketch of its values
    (``s0``, ``s1``, ...) and its NULLs (``n0``, ...). One scan of those columns; each task sends one row."""
    made = []
    for i, k in enumerate(keys):
        made.append(_called("approx_top_k_accumulate", F.col(k), F.lit(tracked)).alias(f"s{i}"))
        made.append(F.count_if(F.col(k).isNull()).cast("bigint").alias(f"n{i}"))
    return df.agg(F.count(F.lit(1)).alias("rows"), *made)


def combine_summaries(summaries: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """The summary of everything that the rows of ``summaries`` (of the same columns) sum up."""
    made = [_called("approx_top_k_combine", F.col(c), F.lit(tracked)).alias(c) if c.startswith("s")
            else F.sum(c).cast("bigint").alias(c) for c in summaries.columns]
    return summaries.agg(*made)


def heavy_of(summary: DataFrame, keys: list[str], min_share: float = 0.01, min_rows: int = 0,
             tracked: int = TRACKED) -> dict[str, dict]:
    """From the one row of a summary: for each column the values holding ``min_share`` of the rows (and
    ``min_rows`` rows), with their share. None is missing; a value a little below the share may be among them, as counts
    can be overstated. NULL is a value (None). At most ``1 / min_share`` values a column reach the driver."""
    if min_share <= error_share(tracked):
        raise ValueError(f"shares down to {min_share} need more than {int(3.5 / min_share)} tracked values")
    most = int(1 / (min_share - error_share(tracked))) + 2
    cols = [_called("approx_top_k_estimate", F.col(f"s{i}"), F.lit(min(most, tracked))).alias(f"e{i}")
            for i in range(len(keys))]
    row = summary.select("rows", *[f"n{i}" for i in range(len(keys))], *cols).first()
    found: dict[str, dict] = {}
    total = row["rows"] if row is not None else 0
    least = max(total * min_share, min_rows, 1)
    for i, k in enumerate(keys):
        top = {e["item"]: e["count"] / total for e in (row[f"e{i}"] if total else []) or []
               if e["item"] is not None and e["count"] >= least}
        if total and row[f"n{i}"] >= least:
            top[None] = row[f"n{i}"] / total
        found[k] = top
    return found


def heavy_keys(df: DataFrame, keys: list[str], min_share: float = 0.01, min_rows: int = 0,
               tracked: int = TRACKED) -> dict[str, dict]:
    """``heavy_of`` a summary of ``df``, remembered for the application: jobs that ask for the same columns of the same
    rows (an equal plan over the same files) share one scan. What is remembered only steers plans; results never
    depend on it, also when a file has been replaced meanwhile."""
    of = df.select(*keys)
    files = of.inputFiles()
    if not files:  # rows made in memory have no files to tell them apart
        return heavy_of(key_summary(of, keys, tracked), keys, min_share, min_rows, tracked)
    listed = hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()
    asked = (df.sparkSession.sparkContext.applicationId, of.semanticHash(), listed, tuple(keys), min_share, min_rows,
             tracked)
    if asked not in _remembered:
        _remembered[asked] = heavy_of(key_summary(of, keys, tracked), keys, min_share, min_rows, tracked)
        while len(_remembered) > _KEPT:
            _remembered.popitem(last=False)
    _remembered.move_to_end(asked)
    return {k: dict(v) for k, v in _remembered[asked].items()}
