"""Intermediate tables in the folder that all nodes share.

A table written here cuts lineage like ``checkpoint()`` does and survives lost executors; unlike a
cached frame it holds no executor memory. The folder is ``spark.checkpoint.dir`` or the context's
checkpoint folder; only a local master may do without, which takes a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """The shared folder as a URI that Spark can read and write."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        current = context._jsc.sc().getCheckpointDir()
        if current.isDefined():
            folder = current.get()
        else:
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir has to name a folder that all nodes share")
            folder = "file://" + tempfile.mkdtemp(prefix="pagewright-scratch-")
            context.setCheckpointDir(folder)
    return folder.rstrip("/")


def path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{root(spark)}/pagewright/{label}-{uuid.uuid4().hex}"


def table(df: DataFrame, label: str, reader: SparkSession | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, in the session ``reader`` if one is given."""
    target = path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(target)
    return (reader or df.sparkSession).read.schema(df.schema).parquet(target)


def purge(spark: SparkSession) -> None:
    """Delete everything this package left in the shared folder; call it when results are written."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{root(spark)}/pagewright")
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
