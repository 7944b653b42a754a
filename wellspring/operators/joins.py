"""Join helpers: semi join, null-aware anti join, and joins that split hot keys.

No broadcast hints: Spark broadcasts a side only when its size is known to
be under ``spark.sql.autoBroadcastJoinThreshold`` — from file sizes at
planning time, or from the measured shuffle output once AQE has run the
side's stage. Beyond that bound the join shuffles, and ``skew_join`` keeps a
key that holds a large share of the rows from landing in a single task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.operators.heavy import heavy_keys


def semi_join(left: DataFrame, right: DataFrame, left_col: str, right_col: str | None = None,
              hot: dict | list | None = None, row_key: list[str] | None = None) -> DataFrame:
    """``left WHERE left_col IN (SELECT right_col FROM right)``.

    Written as a left join to the distinct listed values (pre-aggregated per
    task) and a filter, through ``skew_join``, so a value holding a large
    share of ``left`` is spread over several tasks.
    """
    right_col = right_col or left_col
    listed = (right.select(F.col(right_col).alias(left_col)).filter(F.col(left_col).isNotNull())
              .distinct().withColumn("_ws_hit", F.lit(True)))
    joined = skew_join(left, listed, left_col, "left", hot=hot, row_key=row_key)
    return joined.filter(F.col("_ws_hit")).select(*left.columns)


def not_in(left: DataFrame, right: DataFrame, left_col: str, right_col: str | None = None,
           hot: dict | list | None = None, row_key: list[str] | None = None) -> DataFrame:
    """``left WHERE left_col NOT IN (SELECT right_col FROM right)`` with SQL's NULL rules.

    * empty list: every left row passes, even one whose value is NULL;
    * a NULL in a non-empty list: no row passes;
    * otherwise rows whose value is non-NULL and absent from the list pass.

    Spark plans SQL ``NOT IN`` as a null-aware anti join that must broadcast
    the list (or falls back to a nested loop). Here the list is reduced to its
    distinct keys (partial aggregation before the shuffle), joined with a
    left join that can shuffle at any size and splits hot values
    (``skew_join``), and the two list facts (size, NULL present) enter as
    scalar subqueries evaluated once.
    """
    right_col = right_col or left_col
    listed = right.select(F.col(right_col).alias("_ws_key"))
    n_listed = listed.select(F.count(F.lit(1))).scalar()
    n_nulls = listed.select(F.count_if(F.col("_ws_key").isNull())).scalar()
    hits = (listed.filter(F.col("_ws_key").isNotNull()).distinct()
            .select(F.col("_ws_key").alias(left_col)).withColumn("_ws_hit", F.lit(True)))
    joined = skew_join(left, hits, left_col, "left", hot=hot, row_key=row_key)
    keep = (n_listed == 0) | ((n_nulls == 0) & F.col(left_col).isNotNull() & F.col("_ws_hit").isNull())
    return joined.filter(keep).select(*left.columns)


# A value with fewer rows than this is never cut: its task is small anyhow.
MIN_ROWS = 5000


def hot_keys_by(df: DataFrame, keys: list[str], min_share: float = 0.01, min_hits: int = MIN_ROWS) -> dict[str, dict]:
    """For each column in ``keys``, the values holding at least ``min_share`` of the rows of ``df`` and at least
    ``min_hits`` rows, with their share (``heavy_keys``): found on all rows, so none is missed, in one scan that
    an application makes once for the same rows and columns. NULL is a value like others here
    (None): its rows pile up in one task of a left join. What is found only steers the plan."""
    return heavy_keys(df, keys, min_share, min_hits)


def hot_keys(df: DataFrame, key: str, min_share: float = 0.01, min_hits: int = MIN_ROWS) -> dict:
    """The values of one column holding at least ``min_share`` of the rows, with their shares (see ``hot_keys_by``)."""
    return hot_keys_by(df, [key], min_share, min_hits)[key]


def salt_counts(spark, hot: dict | list, salts: int | None = None, parts: int | None = None) -> dict:
    """How many pieces each hot value is cut into.

    A value with share ``s`` of the rows is cut into ``8 * s * P`` pieces
    (``P`` = ``parts``, by default the shuffle partitions), so each piece is about an eighth of an
    average partition however hot the value is, and partitions stay even
    though hashing deals several pieces to some. A plain list of values
    (share unknown) gets ``salts`` pieces each, by default ``P``.
    """
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if isinstance(hot, dict):
        return {v: max(2, math.ceil(8 * share * parts)) for v, share in hot.items()}
    return {v: max(2, salts or parts) for v in hot}


def skew_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner",
              salts: int | None = None, min_share: float = 0.01, hot: dict | list | None = None,
              row_key: list[str] | None = None) -> DataFrame:
    """``fact JOIN dim USING (key)`` that stays balanced when one key holds
    a large share of ``fact`` (a third of all visits at one source, say).

    Without hot keys this is the plain join, so Spark may still broadcast a
    small dimension. With hot keys, each hot value is cut into pieces in
    proportion to its share (``salt_counts``): its fact rows get a salt from
    a hash of ``row_key``, columns that tell rows apart (by default all: give
    them if rows may be alike; a hash, so a retried task salts the same way)
    and its dimension rows are repeated once per piece; every other row has
    salt 0. The join runs on (key, salt), so no piece is larger than about
    an eighth of an average partition, and only hot dimension rows are repeated.
    Rows with a NULL key, which a left join keeps, are spread the same way;
    they have no match, so nothing is repeated for them.

    ``hot`` may be given (``{value: share}`` or a list of values, found on
    an input scan); otherwise it is found on ``fact`` (``hot_keys``). ``how`` is
    ``inner`` or ``left`` (fact rows kept).
    """
    return skew_join_chain(fact, key, [(dim, how)], salts, min_share, hot, row_key)


def skew_join_chain(fact: DataFrame, key: str, dims: list[tuple[DataFrame, str]],
                    salts: int | None = None, min_share: float = 0.01,
                    hot: dict | list | None = None, row_key: list[str] | None = None) -> DataFrame:
    """Several joins of ``fact`` on the same key, salted once (see ``skew_join``).

    All joins use (key, salt), so after the first one the fact side is
    already partitioned the way the next one needs: the fact is shuffled
    once and every dimension once, however many dimensions hang off the key.
    """
    for _, how in dims:
        if how not in ("inner", "left"):
            raise ValueError("skew joins support inner and left joins")
    hot = hot_keys(fact, key, min_share) if hot is None else hot
    if not hot:
        out = fact
        for dim, how in dims:
            out = out.join(dim, key, how)
        return out
    key_type = fact.schema[key].dataType
    pieces = salt_counts(fact.sparkSession, hot, salts)
    named = [c for v, n in pieces.items() if v is not None for c in (F.lit(v).cast(key_type), F.lit(n))]
    lookup = F.try_element_at(F.create_map(*named), F.col(key)) if named else F.lit(None).cast("int")
    n_pieces = F.coalesce(lookup, F.lit(1))  # 1: not hot
    of_row = F.when(F.col(key).isNull(), F.lit(pieces.get(None, 1))).otherwise(n_pieces)
    hashable = row_key or [f.name for f in fact.schema.fields if not isinstance(f.dataType, T.MapType)]
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in hashable]), of_row).cast("int")
    out = fact.withColumn("_ws_salt", salt)
    for dim, how in dims:
        d = dim.withColumn("_ws_salt", F.explode(F.sequence(F.lit(0), n_pieces.cast("int") - 1)))
        out = out.join(d, [key, "_ws_salt"], how)
    return out.drop("_ws_salt")
