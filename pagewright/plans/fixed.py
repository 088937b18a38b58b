"""Queries over small fixed tables, for what the driver's tables cannot exercise: a site of pages, answers of models, files."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from pagewright import scratch
from pagewright.config import DEFAULT
from pagewright.functions import html as H
from pagewright.operators import analyze, cache, catalog, crawl, links, resolve, stats
from pagewright.plans.literals import TABLES, frame
from pagewright.plans.queries import page_rows, pages, query, read
from pagewright.providers import HeuristicProvider, KeyRing, parse_json_ladder
from pagewright.sources import sinks, tables

RECORDS = "cache_key string, is_back_link boolean, is_course_page boolean, is_course_relevant boolean, confidence double, reasoning string"


class WindowProvider(HeuristicProvider):
    """Finds ``item:name`` in a window; a window with FAIL cannot be asked."""

    def materials(self, chunk: str) -> str:
        if "FAIL" in chunk:
            raise OSError("refused")
        return json.dumps({"extracted_items": [{"item_type": "slides", "title": t} for t in re.findall(r"item:(\w)", chunk)]})


# Pages of a site (L1-L13, H6, H7, X4, X11, M11, R1, R2, M14, D-7)


@query
def lit_resource_links(spark, sf_dir):
    return links.resource_links(frame(spark, "lit_html")).select("page_id", "pos", "tag", "url", "text", "title")


@query
def lit_links_per_tag(spark, sf_dir):
    return stats.by_tag(links.extracted_links(frame(spark, "lit_html")))


@query
def lit_anchor_links(spark, sf_dir):
    return links.page_links(frame(spark, "lit_html")).select("page_id", "pos", "url", "text")


@query
def lit_page_files(spark, sf_dir):
    return links.page_files(frame(spark, "lit_html"))


@query
def lit_blocks(spark, sf_dir):
    rows = H.parsed(frame(spark, "lit_html"))
    block = rows.select("page_id", F.lit("block").alias("kind"), F.posexplode("parsed.blocks").alias("place", "text"))
    return block.unionByName(rows.select("page_id", F.lit("code").alias("kind"), F.posexplode("parsed.code").alias("place", "text")))


@query
def lit_materials(spark, sf_dir):
    return catalog.materials(catalog.facts(frame(spark, "lit_html"))).select("page_id", F.col("pos").cast("long").alias("pos"), "item_type", "title", "snippet", "file_url", "confidence")


@query
def lit_model_materials(spark, sf_dir):
    return catalog.materials_by_model(frame(spark, "lit_chunks"), WindowProvider()).select("page_id", "item_type", "title")


@query
def lit_course_table(spark, sf_dir):
    rows = analyze.analyze_pages(frame(spark, "lit_html"), HeuristicProvider())
    listed = lambda c: F.size(F.from_json(c, "array<struct<href:string,text:string>>")).cast("long")
    plain = [c for c, _ in (f.split() for f in TABLES["exp_course_rows"][0].split(", ")) if not c.startswith("n_")]
    return rows.select(*plain, listed("all_files_json").alias("n_files"), listed("all_internal_links_json").alias("n_links"))


@query
def lit_markdown(spark, sf_dir):
    index = catalog.indexed(frame(spark, "lit_groups").where("course_code like '%CS2%' or course_title = 'Logic'"))
    return catalog.rendered(index, frame(spark, "lit_items")).select("group_type", "group_key", "markdown")


# The crawl of the site


def _crawled(spark, verify: bool = False, state: str | None = None):
    seeds = spark.createDataFrame([("https://site.example.edu/cs/cs102.html",), ("https://site.example.edu/cs/index.html",)], "url string")
    return crawl.crawl(frame(spark, "lit_html"), seeds, spark.createDataFrame([], RECORDS), HeuristicProvider(), DEFAULT, verify, state)


@query
def lit_crawl(spark, sf_dir):
    return crawl.buckets(_crawled(spark)).select("bucket", "url", "depth")


@query
def lit_crawl_resumed(spark, sf_dir):
    """A crawl that goes on from the levels of one before finds the same."""
    state = scratch.path(spark, "crawl-state")
    _crawled(spark, state=state)["links"].count()
    return _crawled(spark, state=state)["links"].select("bucket", "url", "depth")


@query
def lit_crawl_json(spark, sf_dir):
    kind = "base_url string, visited_urls array<string>, stats struct<total_visited:bigint,total_links_extracted:bigint,same_domain_links:bigint,external_links:bigint,course_pages:bigint,course_relevant:bigint,back_links:bigint,irrelevant:bigint,file_links:bigint,inaccessible:bigint>"
    at = scratch.path(spark, "crawl-result")
    sinks.json_rows(crawl.result_json(_crawled(spark), "https://site.example.edu/"), at)
    rows = spark.read.schema("json string").json(at).select(F.from_json("json", kind).alias("r"))
    return rows.select("r.base_url", F.size("r.visited_urls").cast("long").alias("n_visited"), "r.stats.*")


@query
def lit_crawl_verified(spark, sf_dir):
    checked = _crawled(spark, verify=True)["verified"]
    return checked.select("url", "action", "reclassified_from", "reason", "error")


@query
def lit_crawl_summary(spark, sf_dir):
    return stats.crawl_summary(crawl.buckets(_crawled(spark)))


@query
def lit_course_pages(spark, sf_dir):
    """asked without a threshold."""
    rows = frame(spark, "lit_links").select((F.col("id") % 3).cast("long").alias("page_id"), F.col("id").alias("pos"), "url", "text")
    return cache.find_course_pages(rows, HeuristicProvider()).select("page_id", "url", "bucket", "method")


# Answers and keys (M13, S12, D-8, M18)


@query
def json_answers(spark, sf_dir):
    def read_answer(text: str) -> str | None:
        try:
            return json.dumps(parse_json_ladder(text))
        except ValueError:
            return None

    return spark.createDataFrame([(i, read_answer(text)) for i, text in TABLES["lit_answers"][1]], "id int, value string")


@query
def key_lists(spark, sf_dir):
    settings: dict[int, dict[str, str]] = {}
    for i, name, value in TABLES["lit_keys"][1]:
        settings.setdefault(i, {})[name] = value
    rows = [(i, place, key) for i, values in settings.items() for place, key in enumerate(KeyRing.from_settings(values).keys)]
    return spark.createDataFrame(rows, "id int, place int, key string")


# Files written and read back


@query
def csv_course_rows(spark, sf_dir):
    """Other column names, nulls as empty, quotes and line breaks."""
    at = scratch.path(spark, "rows")
    sinks.cleaned_csv(frame(spark, "lit_course_rows").withColumnsRenamed({"url": "Link", "course_code": "CODE", "course_title": "Title"}).withColumn("component", F.lit(1)), at)
    return tables.course_rows(spark, tables.first_existing(spark, [at + "-none", at])).drop("idx")


@query
def csv_url_list(spark, sf_dir):
    """S4, K5."""
    at = scratch.path(spark, "urls")
    sinks.unique_url_csv(pages(spark, sf_dir), at)
    return tables.url_list(spark, at)


@query
def csv_course_table(spark, sf_dir):
    """K3: the course table of all pages."""
    at = scratch.path(spark, "courses")
    sinks.course_csv(analyze.analyze_pages(pages(spark, sf_dir), HeuristicProvider()), at)
    return tables.course_rows(spark, at).select("url", "course_title", "manual_page_type", "ai_page_type", "ai_confidence", "has_notes", "conflict_flag", "recheck_needed", "all_files_json")


@query
def json_cache(spark, sf_dir):
    """The cache as one JSON object, read again; a file that is not there is an empty cache."""
    at = scratch.path(spark, "cache")
    rows = read(spark, sf_dir, "customer").select(
        F.concat(F.lit("https://h/"), F.col("c_custkey")).alias("cache_key"), (F.col("c_nationkey") == 1).alias("is_back_link"), (F.col("c_acctbal") > 0).alias("is_course_page"),
        F.lit(True).alias("is_course_relevant"), (F.col("c_custkey") % 10 / 10).alias("confidence"), F.col("c_mktsegment").alias("reasoning"),
    )
    cached = cache.upsert(rows.withColumn("version", F.lit(1)), rows.limit(0).withColumn("version", F.lit(1)).withColumn("error", F.lit(False))).drop("version")
    sinks.cache_json(cached).coalesce(1).write.text(at)
    return tables.cache(spark, at).unionByName(tables.cache(spark, at + "-none"))


@query
def json_course_pages(spark, sf_dir):
    """The urls of a crawl result's course pages."""
    at = scratch.path(spark, "result")
    row = read(spark, sf_dir, "nation").agg(F.to_json(F.struct(F.sort_array(F.collect_list(F.struct(F.concat(F.lit("https://h/"), "n_name").alias("url")))).alias("course_pages"))).alias("value"))
    row.coalesce(1).write.text(at)
    return tables.crawl_course_pages(spark, at)


@query
def files_by_group(spark, sf_dir):
    """K7, K8: an index file for each group, read again."""
    at = scratch.path(spark, "index")
    sinks.documents(catalog.index_json(catalog.indexed(frame(spark, "lit_groups"))), at, "json", ".index.json")
    rows = spark.read.text(at)
    entry = F.explode(F.from_json("value", "links array<struct<index:int,url:string,course_code:string,course_title:string,semester:string,year:string>>")["links"]).alias("l")
    return rows.select("file", entry).select("file", "l.*")


@query
def failed_urls_shown(spark, sf_dir):
    """The first twenty failed urls and how many more there are."""
    rows = pages(spark, sf_dir).where("page_id % 7 = 0")
    return stats.displayed(rows, "url", ["page_id"])


@query
def head_of_courses(spark, sf_dir):
    """O8."""
    return stats.head(resolve.resolved(page_rows(spark, sf_dir)), ["idx"]).select("idx", "course_code", "course_title")
