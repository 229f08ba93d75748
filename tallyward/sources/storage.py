"""Where intermediate tables live: the shared folder the cluster names, never a worker's own disk."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Where none is set, local sessions (tests) get a temporary one; a cluster has to name a folder that all its machines see.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    shared_folder(spark)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back: it is computed once, and lineage ends here."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
