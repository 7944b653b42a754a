"""Previews, snapshots, materialised tables, appends in batches, and dropping them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from wellspring.session import table_path


def preview(df: DataFrame, n: int = 5, order_by: Sequence | None = None) -> DataFrame:
    """``SELECT * ... LIMIT n``. With ``order_by`` the rows are repeatable
    (top-k per task, then a final merge), without it any ``n`` rows."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def fresh_path(df: DataFrame, name: str, temporary: bool = False) -> str:
    """A new folder for one write. Temporaries of one application share the
    prefix ``tmp/<application id>/`` so a storage lifecycle rule (or one
    delete) clears them after the run; other tables live under their name."""
    spark = df.sparkSession
    if temporary:
        return table_path(spark, "tmp", spark.sparkContext.applicationId, name, uuid.uuid4().hex)
    return table_path(spark, name, uuid.uuid4().hex)


def _write_once(df: DataFrame, path: str) -> DataFrame:
    # errorifexists: an accidental second write fails instead of replacing
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def snapshot(df: DataFrame, name: str) -> DataFrame:
    """``CREATE TABLE copy AS SELECT ...``: write once to a new folder, read back."""
    return _write_once(df, fresh_path(df, name))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Temporary table: compute once into the shared folder, reuse the files.

    Cuts the lineage, so later queries and retried tasks read the stored
    rows instead of re-running the joins behind them, and readers prune
    columns and push filters into the Parquet files.
    """
    return _write_once(df, fresh_path(df, name, temporary=True))


def _folder(df_or_spark, path: str):
    """Hadoop's file system and path object of a folder in any store Spark reads."""
    spark = df_or_spark.sparkSession if isinstance(df_or_spark, DataFrame) else df_or_spark
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def publish_folder(spark: SparkSession, written: str, target: str) -> bool:
    """Move the folder ``written`` to ``target`` by one rename that fails if the target is there: of several drivers that
    publish the same target, one wins, and readers see either nothing or a whole folder. The loser's folder is deleted.
    (The store's rename must be atomic, as on HDFS and local disks; an object store needs a committer of its own.)"""
    jvm = spark._jvm
    source, place = jvm.org.apache.hadoop.fs.Path(written), jvm.org.apache.hadoop.fs.Path(target)
    conf = spark._jsc.hadoopConfiguration()
    store = source.getFileSystem(conf)
    store.mkdirs(place.getParent())
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), conf)
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(source, place, none)
    except Py4JJavaError:
        store.delete(source, True)
        if not store.exists(place):  # it wasn't another driver's folder that stood in the way
            raise
        return False
    return True


def append_batch(df: DataFrame, path: str, partition: str, value: str, batch: str) -> bool:
    """Append ``df`` to the table at ``path`` as one batch of a partition; False if the batch was there already.

    Each batch is a folder of its own, ``<partition>=<value>/batch=<id>``. It is written to an attempt's own folder
    (hidden from readers) and then moved to its name by one rename (``publish_folder``): a driver that is lost on the way
    leaves nothing that a reader sees, and two drivers that publish the same batch leave it once. A folder of that name
    without its ``_SUCCESS`` file, which this doesn't leave, counts as half-written and is moved aside.
    """
    spark = df.sparkSession
    target = f"{path}/{partition}={value}/batch={batch}"
    store, place = _folder(df, target)
    if store.exists(place):
        if store.exists(_folder(df, target + "/_SUCCESS")[1]):
            return False
        publish_folder(spark, target, f"{path}/_attempts/{uuid.uuid4().hex}")  # half-written, by other means: aside
    attempt = f"{path}/_attempts/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(attempt)
    return publish_folder(spark, attempt, target)


def drop_table(spark: SparkSession, path: str) -> bool:
    """Delete the folder of a snapshot, temporary or published table below the shared folder."""
    if not path.startswith(table_path(spark) + "/"):
        raise ValueError(f"{path} is not below {table_path(spark)}")
    store, place = _folder(spark, path)
    return store.delete(place, True)


def drop_temporaries(spark: SparkSession) -> bool:
    """Delete every temporary table that this application has written."""
    return drop_table(spark, table_path(spark, "tmp", spark.sparkContext.applicationId))
