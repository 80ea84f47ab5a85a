"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def application_folder(spark: SparkSession) -> str:
    """This application's folder in the one named by spark.checkpoint.dir; under a local master that names none, as in
    tests, in a new local folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.partition("[")[0] == "local":  # a folder of this machine would be of no use there
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="panelspark-")
        spark.conf.set("spark.checkpoint.dir", named)
    return f"{named.rstrip('/')}/panelspark-{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in this application's folder."""
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete all that this application has stored, once none of its results is read any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at a path of any file system that Spark can reach."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: worked out once, and cut from what it came from."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
