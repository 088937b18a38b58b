"""Classification with a cache, micro-batches and a provider."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright import scratch
from pagewright.config import DEFAULT, Settings
from pagewright.functions import classify as C
from pagewright.functions import url as U
from pagewright.operators.dedup import first_in_page, first_wins

RECORD = ["is_back_link", "is_course_page", "is_course_relevant", "confidence", "reasoning"]


def hits(links: DataFrame, cache: DataFrame) -> DataFrame:
    """Links whose key is known, with the stored record and ``from_cache``; the url stays the link's own."""
    known = cache.select("cache_key", *RECORD)
    return links.withColumn("cache_key", U.cache_key(F.col("url"))).join(known, "cache_key").withColumn("from_cache", F.lit(True))


def misses(links: DataFrame, cache: DataFrame) -> DataFrame:
    """J2."""
    return links.withColumn("cache_key", U.cache_key(F.col("url"))).join(cache.select("cache_key"), "cache_key", "left_anti")


def upsert(cache: DataFrame, fresh: DataFrame, version: str = "version") -> DataFrame:
    """K6: the latest record of each key; rows of failed calls (``error``) are not kept (M5)."""
    both = cache.unionByName(fresh.where(~F.coalesce("error", F.lit(False))).select(*cache.columns))
    return first_wins(both.withColumn("_late", -F.col(version)), ["cache_key"], ["_late"]).drop("_late")


def batches(links: DataFrame, size: int, by: list[str], order: list[str]) -> DataFrame:
    """M1: number the links of each page and put every ``size`` of them in a batch."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    return links.withColumn("place", place.cast("long")).withColumns({"batch_id": F.floor(F.col("place") / size), "place_in_batch": F.pmod("place", F.lit(size))})


def ask(links: DataFrame, provider, settings: Settings = DEFAULT, by: tuple = ("page_id",), order: tuple = ("pos",)) -> DataFrame:
    """M2-M5: one call a batch; rows with the record, and ``error`` where the call failed.

    Batches never straddle pages and have at most ``batch_size`` links, so a group is small.
    """
    dealt = batches(links, settings.batch_size, list(by), list(order))
    fields = [*by, *order, "place", "url", "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.select(*fields).schema) + ", response string"

    def call(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        rows = table.select(["url", "text"]).to_pylist()
        try:
            answer = provider.classify_batch(rows)
        except Exception:  # any failure of an outside call is a row of its own, not a failed job
            answer = None
        return table.select(fields).append_column("response", pa.array([answer] * len(rows), pa.string()))

    keys = [*by, "batch_id"]
    answered = dealt.select(*fields, "batch_id").groupBy(*keys).applyInArrow(call, schema)
    sizes = Window.partitionBy(*by, F.floor(F.col("place") / settings.batch_size))
    answered = answered.withColumn("n", F.count("*").over(sizes))
    record = F.element_at(C.parse_batch(F.col("response"), F.col("n")), (F.pmod("place", F.lit(settings.batch_size)) + 1).cast("int"))
    answered = answered.withColumn("record", record)
    flat = [F.coalesce(F.col(f"record.{c}"), other).alias(c) for c, other in zip(RECORD, (F.lit(False), F.lit(False), F.lit(False), F.lit(0.0), F.lit("Call failed")), strict=True)]
    return answered.select(*by, *order, "place", "url", "text", *flat, F.col("response").isNull().alias("error"), F.lit(False).alias("from_cache"))


def filter_links(links: DataFrame, cache: DataFrame, provider, settings: Settings = DEFAULT, use_heuristics: bool = True) -> tuple[DataFrame, DataFrame]:
    """unique links of each page by page-norm, in their bucket and with their place ``pos`` (J3), and the statistics (A3).

    Links are written before they are judged, so that what finds them (a parse, it may be) runs once.
    """
    links = scratch.table(links.select("page_id", "pos", "url", "text"), "cache-links")
    unique = scratch.table(first_in_page(links, [U.page_norm(F.col("url"))], ["pos"]), "cache-unique")
    back = C.is_back_link(F.col("url"), F.col("text")) if use_heuristics else F.lit(False)
    split = unique.withColumn("is_back", back)
    rest = split.where(~F.col("is_back")).drop("is_back")
    known = hits(rest, cache).select("page_id", "pos", "url", *RECORD, "from_cache")
    asked = ask(misses(rest, cache), provider, settings).select("page_id", "pos", "url", *RECORD, "from_cache")
    flags = [F.col(c) for c in RECORD[:4]]
    judged = known.unionByName(asked).withColumns({"bucket": C.bucket(*flags), "method": F.lit("model")})
    easy = split.where("is_back").select("page_id", "pos", "url", F.lit("back_link").alias("bucket"), F.lit("heuristic").alias("method"))
    out = judged.unionByName(easy, allowMissingColumns=True)
    stats = out.groupBy().pivot("bucket", ["back_link", "course_page", "course_relevant", "irrelevant"]).count().na.fill(0)
    total = links.agg(F.count("*").alias("total"), (F.count("*") - F.countDistinct("page_id", U.page_norm(F.col("url")))).alias("duplicates_removed"))
    return out, total.crossJoin(stats)  # a row each


def find_course_pages(links: DataFrame, provider, settings: Settings = DEFAULT) -> DataFrame:
    """back links by rule, then course indicators, and only those asked, without a threshold."""
    url, text = F.col("url"), F.col("text")
    rows = links.withColumns({"is_back": C.is_back_link(url, text), "has_indicators": C.has_course_indicators(url, text)})
    asked = ask(rows.where("not is_back and has_indicators"), provider, settings)
    judged = asked.select("page_id", "url", C.bucket_unweighted(*[F.col(c) for c in RECORD[:3]]).alias("bucket"), F.lit("model").alias("method"))
    easy = rows.where("is_back or not has_indicators").select("page_id", "url", F.when(F.col("is_back"), "back_link").otherwise("irrelevant").alias("bucket"), F.lit("heuristic").alias("method"))
    return judged.unionByName(easy)
