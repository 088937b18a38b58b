"""Pages as a stream (an extension): landing folder, the batch transforms, and state for what was seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import url as U
from pagewright.operators import links as L
from pagewright.schemas import PAGES


def landing(spark: SparkSession, path: str, files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def new_links(stream: DataFrame) -> DataFrame:
    """Links of arriving pages, each page-norm once over the whole stream (state without expiry)."""
    rows = L.resolved(L.anchors(stream)).withColumn("norm", U.page_norm(F.col("url")))
    return rows.select("page_id", "source_url", "pos", "url", "text", "norm").dropDuplicates(["norm"])


def run(spark: SparkSession, source: str, target: str, checkpoint: str) -> None:
    """Process what has arrived and stop; the checkpoint makes the next run go on from there."""
    query = new_links(landing(spark, source)).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
