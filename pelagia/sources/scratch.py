"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that removes the shuffle files of a query when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset a temporary folder, for a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="pelagia-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/pelagia-{uuid.uuid4().hex}/{name}"


def save(df: DataFrame, path: str) -> None:
    """Writes the rows as Parquet.

    The shuffle files of this job go when it ends: what follows reads the folder, and else they
    would stay on the executors' disks until the driver happens to collect its garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, None)
    conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEAN_UP) if before is None else conf.set(CLEAN_UP, before)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Deletes a file or folder in whatever store it is; tells whether there was one."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
