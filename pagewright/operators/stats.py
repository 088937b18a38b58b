"""Statistics (A1-A7, A10, A13, M17, K11): each is one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright import scratch
from pagewright.schemas import BUCKETS


def crawl_stats(links: DataFrame) -> DataFrame:
    """A1: counters of all links, by place and by bucket; same-domain is what is not external."""
    counts = [F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS]
    external = F.count_if(F.col("is_external"))
    return links.agg(
        F.count("*").alias("all_links"), external.alias("external"), (F.count("*") - external).alias("same_domain"),
        F.count_if(F.col("is_file_link")).alias("file_links"), *counts,
    )


def by_tag(links: DataFrame) -> DataFrame:
    """A2, O6."""
    return links.groupBy("tag").agg(F.count("*").alias("n")).orderBy("tag")


def links_per_page(links: DataFrame) -> DataFrame:
    return links.groupBy("page_id").agg(F.count("*").alias("n_links"))


def pipeline_summary(rows: DataFrame) -> DataFrame:
    """A row of ``course_rows`` for every url tried, null ``manual_page_type`` where it failed."""
    done = F.col("manual_page_type").isNotNull()
    return rows.agg(
        F.count("*").alias("attempted"), F.count_if(done).alias("processed"), F.count_if(~done).alias("failed"), F.count_if(F.col("conflict_flag")).alias("conflicts"),
        F.count_if(F.col("recheck_needed")).alias("recheck"), F.count_if(F.col("is_useful")).alias("useful"), F.count_if(done & ~F.col("is_useful")).alias("not_useful"),
        F.count_if(F.col("has_syllabus_or_logistics") & ~F.col("is_useful")).alias("syllabus_only"),
    )


def generation_summary(rows: DataFrame) -> DataFrame:
    """A5, K9: rows ``(url, failed, extracted_count)``; failed ones count as processed too."""
    failed = F.sort_array(F.collect_list(F.when(F.col("failed"), F.col("url"))))
    return rows.agg(F.count("*").alias("processed_count"), F.count_if(F.col("failed")).alias("failed_count"), F.coalesce(F.sum("extracted_count"), F.lit(0)).alias("items"), failed.alias("failed_urls"))


def cache_stats(links: DataFrame, size: int) -> DataFrame:
    """Hits and misses of rows with ``from_cache``; the rate is 0 if nothing was asked."""
    n, hit = F.count("*"), F.count_if(F.col("from_cache"))
    rate = F.when(n > 0, F.round(100.0 * hit / n, 6)).otherwise(0.0)
    return links.agg(F.lit(size).cast("long").alias("cache_size"), hit.alias("cache_hits"), (n - hit).alias("cache_misses"), rate.alias("hit_rate"))


def error_runs(events: DataFrame) -> DataFrame:
    """Errors of each key since its last success, after each of its events ``(key, n, ok)``.

    Events are dealt by ranges of key and n and counted inside each range; a row a range and key then
    tells what the ranges before it leave over. So few keys do not mean few tasks.
    """
    dealt = scratch.table(events.repartitionByRange("key", "n").withColumn("_range", F.spark_partition_id()), "stats-events")
    so_far = Window.partitionBy("_range", "key").orderBy("n")
    rows = dealt.withColumn("_all", F.sum((~F.col("ok")).cast("long")).over(so_far))
    rows = rows.withColumn("_cleared", F.max(F.when(F.col("ok"), F.col("_all"))).over(so_far))
    tails = rows.groupBy("key", "_range").agg(F.max("_all").alias("_all"), F.max("_cleared").alias("_cleared"))
    reset = Window.partitionBy("key").orderBy("_range")
    tails = tails.withColumn("_run", F.count("_cleared").over(reset)).withColumn("_left", F.col("_all") - F.coalesce("_cleared", F.lit(0)))
    tails = tails.withColumn("_out", F.sum("_left").over(Window.partitionBy("key", "_run").orderBy("_range")))
    tails = tails.select("key", "_range", F.coalesce(F.lag("_out").over(reset), F.lit(0)).alias("_before"))
    errors = F.col("_all") - F.coalesce("_cleared", -F.col("_before"))
    return rows.join(tails, ["key", "_range"]).withColumn("errors", errors).select(*events.columns, "errors")


def key_stats(events: DataFrame) -> DataFrame:
    """Requests and current errors of each key (the errors since its last success)."""
    last = F.max(F.when(F.col("ok"), F.col("n")))
    per_key = events.groupBy("key").agg(F.count("*").alias("requests"), last.alias("last_ok"))
    late = events.join(per_key, "key").where(~F.col("ok") & (F.col("n") > F.coalesce("last_ok", F.lit(-1))))
    return per_key.select("key", "requests").join(late.groupBy("key").agg(F.count("*").alias("errors")), "key", "left").na.fill(0, ["errors"])


def resolve_check(rows: DataFrame) -> DataFrame:
    """A10: distinct codes, titles, pairs (both known) and components, and whether all four agree."""
    both = F.col("course_code").isNotNull() & F.col("course_title").isNotNull()
    found = rows.agg(
        F.countDistinct("course_code").alias("n_codes"), F.countDistinct("course_title").alias("n_titles"),
        F.countDistinct(F.when(both, F.struct("course_code", "course_title"))).alias("n_pairs"), F.countDistinct("component").alias("n_groups"),
    )
    return found.withColumn("consistent", (F.col("n_codes") == F.col("n_titles")) & (F.col("n_titles") == F.col("n_pairs")) & (F.col("n_pairs") == F.col("n_groups")))


def head(rows: DataFrame, order: list[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows, to be looked at."""
    return rows.orderBy(*order).limit(n)


def displayed(rows: DataFrame, column: str, order: list[str], cap: int = 20) -> DataFrame:
    """``(place, line)``: the first ``cap`` values, and one line that tells how many more there are."""
    first = rows.orderBy(*order).limit(cap).withColumn("place", F.row_number().over(Window.orderBy(*order)))
    more = rows.agg((F.count("*") - cap).alias("n")).where("n > 0")
    rest = more.select(F.lit(cap + 1).alias("place"), F.concat(F.lit("... and "), F.col("n").cast("string"), F.lit(" more")).alias("line"))
    return first.select("place", F.col(column).alias("line")).unionByName(rest)


def crawl_summary(links: DataFrame, caps: tuple = (("course_page", 5), ("course_relevant", 3), ("file", 5), ("inaccessible", 5))) -> DataFrame:
    """``(bucket, place, line)`` of a crawl's lists ``(bucket, url, depth, page_id, pos)``, as far as a summary shows them."""
    out = None
    for bucket, cap in caps:
        part = displayed(links.where(F.col("bucket") == bucket), "url", ["depth", "page_id", "pos", "url"], cap).withColumn("bucket", F.lit(bucket))
        out = part if out is None else out.unionByName(part)
    return out.select("bucket", "place", "line")
