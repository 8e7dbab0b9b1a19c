"""Where work tables go."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """The folder that the cluster names for checkpoints; a temporary one of this machine only if all tasks run on it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="loam-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(own)
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def materialised(df: DataFrame) -> DataFrame:
    """df written to the work folder and read again: computed once, with no lineage left."""
    path = f"{work_folder(df.sparkSession)}/loam-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system that the path belongs to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
