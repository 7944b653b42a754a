"""Session construction and the shared folder for written tables."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from real shuffle sizes,
# splits skewed partitions and coalesces small ones; UTC keeps day and hour
# extraction independent of the machine's zone.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # A filtered side of a join that shuffles sends a Bloom filter of its keys ahead (8 MB: some 8 million keys at 2 %),
    # which the other side's scan applies before its own shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "67108864",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "wellspring",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with ``DEFAULT_CONF``. The master and the number of shuffle partitions
    are set only if given, so that spark-submit's and the cluster's own hold."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and written tables: what
    ``spark.checkpoint.dir`` names, or the context's checkpoint folder.

    A local session (tests) without either gets a new local folder. On a
    cluster that would scatter the files over the executors' disks: an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^]]*\])?", master):
        raise RuntimeError(f"no shared folder: set spark.checkpoint.dir to one that all executors of {master} reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wellspring-ckpt-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def table_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_dir(spark), "wellspring", *parts])
