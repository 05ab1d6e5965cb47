"""Session for tests, the bench and the smoke entry.

Cluster jobs use the session they are given; this helper only fills in
settings that are unset, for local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "merchpulse") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("MERCHPULSE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's ``spark.checkpoint.dir``; only when it is unset
    (local tests) make a fresh scratch folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running the job")
        folder = tempfile.mkdtemp(prefix="merchpulse-ckpt-")
    sc.setCheckpointDir(folder)
    return folder


def cut_lineage(df):
    """Materialise ``df`` in the cluster's checkpoint folder.

    The folder comes from the session (``spark.checkpoint.dir``); only a
    local session without one gets a scratch folder.  Unlike a local
    checkpoint this survives the loss of an executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the session's checkpoint folder, which every
    executor shares."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and its ``Path`` class."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), to_path


@dataclass
class SharedTable:
    """A table written as parquet to the shared folder for several readers."""

    frame: DataFrame
    path: str

    @classmethod
    def write(cls, df: DataFrame, name: str, by: str) -> SharedTable:
        """``df`` in folders by column ``by``: readers that filter on it or
        take few columns read only these."""
        path = shared_path(df.sparkSession, name)
        df.write.partitionBy(by).parquet(path)
        return cls(df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns), path)

    def drop(self) -> None:
        fs, to_path = file_system(self.frame.sparkSession, self.path)
        fs.delete(to_path(self.path), True)
