"""Sources (S1-S9, T11): page tables, course rows, url lists, crawl results and the cache. Schemas are declared, never inferred."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.providers import HttpFetch
from pagewright.schemas import CLASSIFICATION, PAGES

# Other names of the columns of course rows.
ALIASES = {
    "url": "url", "link": "url", "href": "url", "course_code": "course_code", "code": "course_code", "course_title": "course_title", "title": "course_title",
    "year": "year", "semester": "semester",
}


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages from a table."""
    return spark.read.schema(PAGES).parquet(path)


def fetched(urls: DataFrame, fetch=None, retries: int = 2, wait_s: float = 1.5, sleep=None, delay_s: float = 0.0) -> DataFrame:
    """``url, html, error`` by a picklable ``fetch(url) -> str`` (HTTP by default); ``retries`` more tries with linear waits, then null.

    One function call set-up a partition (sessions belong into ``fetch``'s own state); urls of a
    partition follow each other by ``delay_s``.
    """
    fetch = fetch or HttpFetch()

    def call(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import time

        pause = sleep or time.sleep
        for batch in batches:
            html, error = [], []
            for url in batch.column(0).to_pylist():
                page, why = None, None
                if delay_s:
                    pause(delay_s)
                for attempt in range(retries + 1):
                    try:
                        page, why = fetch(url), None
                        break
                    except Exception as problem:  # whatever a site does ends as a row with an error
                        why = str(problem)
                        if attempt < retries:
                            pause(wait_s * (attempt + 1))
                html.append(page)
                error.append(why)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(html, pa.string()), pa.array(error, pa.string())], names=["url", "html", "error"])

    return urls.select("url").mapInArrow(call, "url string, html string, error string")


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', quote='"')


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """S4."""
    return _csv(spark, path).select("url").where(F.col("url").isNotNull())


def course_rows(spark: SparkSession, path: str) -> DataFrame:
    """All text, null as empty, columns by their aliases; ``url`` is required. ``idx`` is the row's place in the file."""
    raw = _csv(spark, path)
    named = raw.select(*[F.col(f"`{c}`").alias(ALIASES.get(c.strip().lower(), c)) for c in raw.columns])
    if "url" not in named.columns:
        raise ValueError("the table has no url column")
    return named.na.fill("").withColumn("idx", F.monotonically_increasing_id())


def first_existing(spark: SparkSession, paths: list[str]) -> str:
    """The first path that exists; ``FileNotFoundError`` if none does."""
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(", ".join(paths))


def cache(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of key to record as rows; a missing or broken file is an empty cache."""
    empty = spark.createDataFrame([], f"cache_key string, record {CLASSIFICATION}")
    try:
        text = spark.read.text(path, wholetext=True)
        rows = text.select(F.explode(F.from_json("value", f"map<string,{CLASSIFICATION}>")).alias("cache_key", "record"))
        rows = rows if rows.schema else empty
        return rows.select("cache_key", "record.*")
    except Exception as problem:  # the reader's own error for a path that is not there
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return empty.select("cache_key", "record.*")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def crawl_course_pages(spark: SparkSession, path: str) -> DataFrame:
    """Urls of a crawl result's course pages."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "course_pages array<struct<url:string>>")["course_pages"]).alias("p")).select("p.url")


def template(path: str | None, default: str) -> str:
    """A prompt from a file of the driver, or the default."""
    try:
        with open(path, encoding="utf-8") as file:
            return file.read()
    except (OSError, TypeError):
        return default
