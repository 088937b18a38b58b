"""Sinks (K1-K9): Parquet is the primary form; CSV, JSON and Markdown are written by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions import url as U
from pagewright.schemas import COURSE_COLUMNS


def course_csv(rows: DataFrame, path: str) -> None:
    """K3: the course table's columns in order; others are left out."""
    rows.select(*COURSE_COLUMNS).write.mode("overwrite").csv(path, header=True, escape='"')


def cleaned_csv(rows: DataFrame, path: str) -> None:
    """K4."""
    helpers = [c for c in ("norm_code", "norm_title", "year_num", "component") if c in rows.columns]
    rows.drop(*helpers).write.mode("overwrite").csv(path, header=True, escape='"')


def unique_urls(rows: DataFrame) -> DataFrame:
    """K5, D-5, O7: distinct urls with https, in order."""
    return rows.select(U.https(F.col("url")).alias("url")).distinct().orderBy("url")


def unique_url_csv(rows: DataFrame, path: str) -> None:
    unique_urls(rows).write.mode("overwrite").csv(path, header=True)


def documents(rows: DataFrame, path: str, column: str, suffix: str) -> None:
    """K7, K8: a file for each row, in a folder named by its file name.

    Spark commits the files, so a lost task leaves none half written. Names that collide after
    shortening share a folder.
    """
    named = rows.select(F.concat("file", F.lit(suffix)).alias("file"), F.col(column).alias("value"))
    named.write.mode("overwrite").partitionBy("file").option("maxRecordsPerFile", 1).text(path)


def json_rows(rows: DataFrame, path: str) -> None:
    """K1, K9: results of one row."""
    rows.write.mode("overwrite").json(path)


def buckets(links: DataFrame, path: str) -> None:
    """K1's primary form: links as Parquet by bucket."""
    links.write.mode("overwrite").partitionBy("bucket").parquet(path)


def cache_json(cache: DataFrame) -> DataFrame:
    """The cache as one JSON object (as large as the cache: an export, not the store)."""
    entry = F.struct("cache_key", F.struct(*[c for c in cache.columns if c != "cache_key"]).alias("record"))
    return cache.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("value"))
