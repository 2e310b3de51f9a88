"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "retort") -> SparkSession:
    """Session with AQE, skew-join handling and the UI off.

    On a cluster the master and most settings come from the submitter;
    ``getOrCreate`` keeps whatever is already configured there.
    """
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared folder there; only when nothing is set on a
    local master (tests) do we pick a fresh local one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="retort-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_root(spark: SparkSession) -> str:
    """This application's own folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/retort/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for one intermediate table."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete the intermediate tables of this application, in whatever store
    they lie. To be called once its results are written: frames that
    operators returned may still read them until then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows over the cluster's slots before heavy row work. By rule, not by
    the scan's partition count: a file of one row group reads as many splits
    of which a single one holds rows."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
