"""Co-partitioned storage: bucketed and sorted tables that join without a shuffle.

A fact table is written once, in buckets of its join key and a salt, a file for each bucket, rows sorted. Its
dimensions are written in the same buckets. Joins on (key, salt) then read matching buckets side by side:
nothing is exchanged, however often the tables are joined.

Plain buckets would put a key that holds a third of the rows into one bucket, hence the salt: a
heavy key's rows (``heavy_keys``: found on all rows, with a guarantee) are cut into pieces in proportion to its share, by
a hash of ``row_key``, and only its dimension rows are repeated, once for each piece. NULL keys are cut the same
way. The layout (key, buckets, pieces) is stored with the table as a table property.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.operators.heavy import heavy_keys
from wellspring.operators.joins import salt_counts
from wellspring.session import table_path

SALT = "_ws_salt"
_PROPERTY = "wellspring.layout"


@dataclass
class Layout:
    """How a fact table is cut: ``pieces`` has the number of pieces of every heavy value."""

    key: str
    buckets: int
    pieces: dict = field(default_factory=dict)

    def n_pieces(self, key_type) -> Column:
        named = [c for v, n in self.pieces.items() if v is not None for c in (F.lit(v).cast(key_type), F.lit(n))]
        found = F.try_element_at(F.create_map(*named), F.col(self.key)) if named else F.lit(None).cast("int")
        return F.when(F.col(self.key).isNull(), F.lit(self.pieces.get(None, 1))).otherwise(F.coalesce(found, F.lit(1)))

    def to_json(self) -> str:
        return json.dumps({"key": self.key, "buckets": self.buckets, "pieces": list(self.pieces.items())}, default=str)

    @classmethod
    def from_json(cls, text: str) -> Layout:
        said = json.loads(text)
        return cls(said["key"], said["buckets"], {v: n for v, n in said["pieces"]})


def layout_for(fact: DataFrame, key: str, buckets: int | None = None, min_share: float = 0.01,
               hot: dict | None = None) -> Layout:
    """A layout for ``fact``: as many buckets as shuffle partitions, heavy keys cut in proportion to their shares. The
    pieces are a quarter of those of a shuffled join: buckets stay as they are written, so they had better be even."""
    spark = fact.sparkSession
    hot = heavy_keys(fact, [key], min_share, min_rows=2)[key] if hot is None else hot
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return Layout(key, buckets, {v: 4 * n for v, n in salt_counts(spark, hot, parts=buckets).items()})


def _save(df: DataFrame, name: str, layout: Layout) -> str:
    spark = df.sparkSession
    table = f"ws_{name}_{uuid.uuid4().hex[:16]}"
    path = table_path(spark, "bucketed", spark.sparkContext.applicationId, table)
    # dealt as the buckets are, so that a task writes whole buckets: one file each, already sorted
    dealt = df.repartition(layout.buckets, layout.key, SALT)
    (dealt.write.format("parquet").bucketBy(layout.buckets, layout.key, SALT).sortBy(layout.key, SALT)
     .option("path", path).saveAsTable(table))
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_PROPERTY}' = '{_quoted(layout.to_json())}')")
    return table


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def store_fact(fact: DataFrame, name: str, layout: Layout, row_key: list[str] | None = None) -> str:
    """Write ``fact`` in the layout's buckets and return the table's name. ``row_key`` are columns that tell rows apart."""
    salt = F.pmod(F.xxhash64(*(row_key or fact.columns)), layout.n_pieces(fact.schema[layout.key].dataType)).cast("int")
    return _save(fact.withColumn(SALT, salt), name, layout)


def store_dim(dim: DataFrame, name: str, layout: Layout) -> str:
    """Write ``dim`` in the buckets of a fact's layout, heavy values' rows once for each piece. Rows with a NULL key
    match nothing and are left out."""
    pieces = layout.n_pieces(dim.schema[layout.key].dataType).cast("int")
    known = dim.filter(F.col(layout.key).isNotNull())
    return _save(known.withColumn(SALT, F.explode(F.sequence(F.lit(0), pieces - 1))), name, layout)


def layout_of(spark: SparkSession, table: str) -> Layout:
    """The layout that a table was written with."""
    for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect():
        if row["key"] == _PROPERTY:
            return Layout.from_json(row["value"])
    raise ValueError(f"{table} has no stored layout")


def bucketed_join(spark: SparkSession, fact: str | DataFrame, dims: list[tuple[str, str]],
                  key: str | None = None) -> DataFrame:
    """``fact`` joined to stored dimensions ``(table, "inner" | "left")`` of the same layout, bucket by bucket. ``fact`` is
    a stored table or a DataFrame that selects and filters rows of one (give the ``key`` then and keep its salt)."""
    if isinstance(fact, str):
        key, out = layout_of(spark, fact).key, spark.table(fact)
    else:
        out = fact
    for table, how in dims:
        if how not in ("inner", "left"):
            raise ValueError("bucketed joins support inner and left joins")
        out = out.join(spark.table(table), [key, SALT], how)
    return out.drop(SALT)


def drop_bucketed(spark: SparkSession, *tables: str) -> None:
    """Drop tables of ``store_fact`` and ``store_dim`` with their files."""
    from wellspring.operators.scans import drop_table
    for table in tables:
        place = table_path(spark, "bucketed", spark.sparkContext.applicationId, table)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        drop_table(spark, place)
