"""The catalogue of queries over the driver's tables and the fixed ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.config import DEFAULT
from pagewright.functions import classify as C
from pagewright.functions import html as H
from pagewright.functions import text as T
from pagewright.functions import url as U
from pagewright.operators import analyze, cache, catalog, crawl, dedup, links, resolve, stats
from pagewright.plans.literals import frame
from pagewright.providers import HeuristicProvider
from pagewright.session import ship
from pagewright.sources import sinks, tables

YEAR = DEFAULT.current_year
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.pages(spark, f"{sf_dir}/pages.parquet")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as course rows: half the page number as code (null for every fourth), the page's title as title."""
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    code = F.when(F.col("page_id") % 4 == 3, None).otherwise(F.concat(F.lit("C"), F.floor(F.col("page_id") / 2).cast("string")))
    return pages(spark, sf_dir).select(F.col("page_id").alias("idx"), "url", code.alias("course_code"), T.null_if_empty(title).alias("course_title"), F.concat(F.lit("20"), F.lpad((F.col("page_id") % 23).cast("string"), 2, "0")).alias("year"))


# Urls (U1-U15)


@query
def url_parts(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", U.parts(F.col("url")).alias("p")).select("page_id", "p.*")


@query
def url_norm_n1(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", U.page_norm(F.col("url")).alias("norm"))


@query
def url_norm_n2(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", U.anchor_key(F.col("url")).alias("norm"))


@query
def url_cache_key(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", U.cache_key(F.col("url")).alias("cache_key"))


@query
def url_https(spark, sf_dir):
    return sinks.unique_urls(pages(spark, sf_dir))


@query
def url_join(spark, sf_dir):
    return frame(spark, "lit_urls").select("id", U.join(F.col("base"), F.col("href")).alias("url"))


@query
def url_kinds(spark, sf_dir):
    h = F.col("href")
    return frame(spark, "lit_urls").select(
        "id", U.is_file(h).alias("is_file"), U.is_course_file(h).alias("is_course_file"), U.is_material_file(h).alias("is_material_file"), U.basename(h).alias("basename"),
        U.leads_nowhere(h).alias("leads_nowhere"), U.page_skips(h).alias("page_skips"), U.material_skips(h).alias("material_skips"),
    )


@query
def url_is_file_pages(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", U.is_file(F.col("url")).alias("is_file"))


@query
def safe_filename(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", U.safe_filename(F.col("url")).alias("file"))


# Links (H4, L1-L15, F1, F2, D-1, A2)


@query
def links_anchor(spark, sf_dir):
    return links.anchors(pages(spark, sf_dir)).where(~U.leads_nowhere(F.col("href"))).select("page_id", "pos", "href", "text")


@query
def links_resolved(spark, sf_dir):
    return links.resolved(links.anchors(pages(spark, sf_dir))).select("page_id", "pos", "url")


@query
def links_dedup(spark, sf_dir):
    return links.page_links(pages(spark, sf_dir)).select("page_id", "pos", "url", "text", "tag")


@query
def links_dedup_native(spark, sf_dir):
    return links.page_links_native(pages(spark, sf_dir)).select("page_id", "pos", "url", "text")


@query
def links_per_page(spark, sf_dir):
    rows = links.page_links_native(pages(spark, sf_dir))
    same = U.same_domain(F.col("url"), U.netloc(F.col("source_url")))
    return rows.groupBy("page_id").agg(F.count("*").alias("n_links"), F.count_if(same).alias("n_same_domain"))


@query
def links_same_domain(spark, sf_dir):
    rows = links.with_site(frame(spark, "lit_urls").withColumn("url", U.join(F.col("base"), F.col("href"))), F.lit("Www.Site.example.edu"))
    return rows.select("id", "is_external", "is_file_link")


@query
def links_per_tag(spark, sf_dir):
    return stats.by_tag(links.extracted_links(pages(spark, sf_dir)))


@query
def internal_links(spark, sf_dir):
    return links.internal_links(pages(spark, sf_dir)).select("page_id", "pos", "href", "text")


@query
def link_context(spark, sf_dir):
    rows = links.page_links(pages(spark, sf_dir), context=True)
    return rows.select("page_id", "pos", F.col("html_context.parent_text").alias("parent_text"), F.col("html_context.heading_above").alias("heading_above"), F.col("html_context.parent_block").alias("parent_block"))


@query
def first_wins_global(spark, sf_dir):
    rows = links.page_links_native(pages(spark, sf_dir)).withColumn("bucket", F.lit("all"))
    return dedup.bucket_dedup(rows, ["page_id", "pos"]).select("page_id", "pos", "url")


@query
def dedup_removed(spark, sf_dir):
    rows = links.page_links_native(pages(spark, sf_dir))
    return dedup.removed_by_bucket(rows.withColumn("bucket", F.when(C.is_back_link(F.col("url"), F.col("text")), "back_link").otherwise("other")))


# Page text


@query
def page_title(spark, sf_dir):
    rows = H.parsed(pages(spark, sf_dir))
    return rows.select("page_id", T.page_title(F.col("parsed.h1"), F.col("parsed.h2"), F.col("parsed.title")).alias("title"))


@query
def visible_text_native(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", T.visible_native(F.col("html")).alias("text"))


@query
def readable_text(spark, sf_dir):
    rows = H.parsed(pages(spark, sf_dir))
    return rows.select("page_id", T.readable(F.col("parsed.readable"), DEFAULT.content_chars).alias("text"))


@query
def html_chunks(spark, sf_dir):
    rows = pages(spark, sf_dir).select("page_id", F.posexplode(T.chunks(F.col("html"), DEFAULT.content_chars)).alias("window", "chunk"))
    return rows.select("page_id", F.col("window").cast("long").alias("window"), "chunk")


# Classification


@query
def back_link_flag(spark, sf_dir):
    return frame(spark, "lit_links").select("id", C.is_back_link(F.col("url"), F.col("text")).alias("is_back"))


@query
def back_link_pages(spark, sf_dir):
    return links.page_links_native(pages(spark, sf_dir)).select("page_id", "pos", C.is_back_link(F.col("url"), F.col("text")).alias("is_back"))


@query
def course_indicator_flag(spark, sf_dir):
    return frame(spark, "lit_links").select("id", C.has_course_indicators(F.col("url"), F.col("text")).alias("has_indicators"))


@query
def bucket_classify(spark, sf_dir):
    flags = [F.col(c) for c in ("back", "course", "relevant")]
    return frame(spark, "lit_cls").select("id", C.bucket(*flags, F.col("confidence"), F.col("heuristic")).alias("bucket"), C.bucket_unweighted(*flags).alias("unweighted"))


def _judged(spark, sf_dir):
    rows = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return rows.withColumn("bucket", C.bucket(F.col("toxic") == 1, F.col("quality") == 1, F.col("quality") == 0, F.lit(0.4) + F.col("doc_id") % 3 / 10))


@query
def bucket_stats(spark, sf_dir):
    return _judged(spark, sf_dir).groupBy("source", "bucket").agg(F.count("*").alias("n"))


@query
def crawl_stats(spark, sf_dir):
    rows = _judged(spark, sf_dir).withColumns({"is_external": F.col("source") == "src1", "is_file_link": F.col("source") == "src2"})
    return stats.crawl_stats(rows)


@query
def filter_links(spark, sf_dir):
    rows = links.page_links_native(pages(spark, sf_dir)).select("page_id", "pos", "url", "text")
    known = _cached(spark, sf_dir)
    return cache.filter_links(rows, known, HeuristicProvider())[0].select("page_id", "pos", "url", "bucket", "method")


def _cached(spark, sf_dir):
    record = {"is_back_link": F.lit(False), "is_course_page": F.col("page_id") % 4 == 0, "is_course_relevant": F.lit(True), "confidence": F.lit(0.9), "reasoning": F.lit("known")}
    rows = pages(spark, sf_dir).where("page_id % 2 = 0").withColumns(record).withColumn("cache_key", U.cache_key(F.col("url")))
    return dedup.first_wins(rows.select("page_id", "cache_key", *record), ["cache_key"], ["page_id"]).drop("page_id")


@query
def cache_hits(spark, sf_dir):
    return cache.hits(pages(spark, sf_dir).select("page_id", "url"), _cached(spark, sf_dir)).select("page_id", "cache_key", "is_course_page", "from_cache")


@query
def cache_misses(spark, sf_dir):
    return cache.misses(pages(spark, sf_dir).select("page_id", "url"), _cached(spark, sf_dir)).select("page_id", "cache_key")


@query
def cache_stats(spark, sf_dir):
    known = _cached(spark, sf_dir)
    rows = pages(spark, sf_dir).withColumn("cache_key", U.cache_key(F.col("url"))).join(known.select("cache_key", F.lit(True).alias("from_cache")), "cache_key", "left")
    return stats.cache_stats(rows.withColumn("from_cache", F.coalesce("from_cache", F.lit(False))), known.count())


@query
def cache_upsert(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select(F.concat(F.lit("u"), (F.col("user_id") % 50).cast("string")).alias("cache_key"), F.col("event_id").alias("version"), F.col("value"), (F.col("event_type") == "error").alias("error"))
    return cache.upsert(rows.where("version % 2 = 0").drop("error"), rows.where("version % 2 = 1"))


@query
def batch_ids(spark, sf_dir):
    rows = cache.batches(links.page_links_native(pages(spark, sf_dir)), DEFAULT.batch_size, ["page_id"], ["pos"])
    return rows.select("page_id", "pos", "place", "batch_id", "place_in_batch")


@query
def batch_parse(spark, sf_dir):
    rows = frame(spark, "lit_json").select("id", F.posexplode(C.parse_batch(F.col("response"), F.col("n"))).alias("place", "r"))
    return rows.select("id", F.col("place").cast("long").alias("place"), "r.*")


@query
def single_parse(spark, sf_dir):
    return frame(spark, "lit_single").select("id", C.parse_single(F.col("response")).alias("r")).select("id", "r.*")


def _requests(spark, sf_dir):
    rows = read(spark, sf_dir, "events")
    n = F.col("event_id") + 1
    return rows.select(n.alias("n"), C.key_of_request(n, 3).alias("key"), (F.col("event_type") != "error").alias("ok"))


@query
def key_rotation(spark, sf_dir):
    return _requests(spark, sf_dir).select("n", "key")


@query
def key_error_run(spark, sf_dir):
    return stats.error_runs(_requests(spark, sf_dir)).select("n", "key", "errors")


@query
def key_stats(spark, sf_dir):
    return stats.key_stats(_requests(spark, sf_dir))


@query
def verify_decision(spark, sf_dir):
    return frame(spark, "lit_verify").select("id", C.verify_action(F.col("answered"), F.col("is_course"), F.col("confidence"), F.col("n_links")).alias("action"))


@query
def crawl_levels(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem")
    there = rows.select(F.concat(F.lit("s"), F.col("l_suppkey")).alias("src"), F.concat(F.lit("p"), F.col("l_partkey")).alias("dst"))
    edges = there.unionByName(there.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return crawl.levels(edges, spark.createDataFrame([("s1",)], "node string"), 2)


@query
def crawl_pages(spark, sf_dir):
    rows = pages(spark, sf_dir)
    empty = _cached(spark, sf_dir).limit(0)
    return crawl.crawl(rows, rows.select("url"), empty, HeuristicProvider(), DEFAULT)["links"].select("url", "bucket", "depth")


# Page analysis


@query
def course_code(spark, sf_dir):
    t = F.col("text")
    return frame(spark, "lit_text").select("id", T.course_code(t).alias("code"))


@query
def semester(spark, sf_dir):
    return frame(spark, "lit_text").select("id", T.semester(F.col("text")).alias("semester"))


@query
def year_first(spark, sf_dir):
    return frame(spark, "lit_text").select("id", T.first_year(F.col("text")).alias("year"))


@query
def page_type_manual(spark, sf_dir):
    t = F.col("text")
    link = F.struct(F.when(F.col("syllabus"), "https://h/Syllabus.pdf").otherwise("https://h/n.pdf").alias("href"), F.when(F.col("files") >= 2, "week3").otherwise("x").alias("text"))
    files = F.when(F.col("files") > 0, F.array_repeat(link, F.col("files"))).when(F.col("syllabus"), F.array(link)).otherwise(F.array().cast("array<struct<href:string,text:string>>"))
    blocks = F.array(F.when(F.col("topics"), "Unit 1").otherwise("none"))
    return frame(spark, "lit_text").select("id", T.page_type(t, T.course_code(t), T.semester(t), T.first_year(t), files, blocks).alias("page_type"))


@query
def year_int(spark, sf_dir):
    return frame(spark, "lit_years").select("id", T.year_int(F.col("s"), YEAR).alias("year"))


@query
def year_int_pages(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", T.year_int(T.visible_native(F.col("html")), YEAR).alias("year"))


@query
def year_extract(spark, sf_dir):
    return frame(spark, "lit_years").select("id", T.year_extract(F.col("s")).alias("year"))


@query
def norm_code(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", T.norm_code(F.concat(F.lit(" "), "p_brand")).alias("code"))


@query
def norm_title(spark, sf_dir):
    return frame(spark, "lit_rows").select("idx", T.norm_code(F.col("course_code")).alias("code"), T.norm_title(F.col("course_title")).alias("title"))


@query
def merge_conflict(spark, sf_dir):
    conflict = T.ai_type(F.col("manual")) != F.col("ai")
    return frame(spark, "lit_merge").select("id", conflict.alias("conflict_flag"), (conflict | (F.col("confidence") == "low")).alias("recheck_needed"))


@query
def pipeline_summary(spark, sf_dir):
    conflict = T.ai_type(F.col("manual")) != F.col("ai")
    rows = frame(spark, "lit_merge").select(
        F.col("manual").alias("manual_page_type"), conflict.alias("conflict_flag"), (conflict | (F.col("confidence") == "low")).alias("recheck_needed"),
        F.col("useful").alias("is_useful"), F.col("notes").alias("has_notes"), F.col("syllabus").alias("has_syllabus_or_logistics"),
    )
    return stats.pipeline_summary(rows)


@query
def manual_fields(spark, sf_dir):
    rows = analyze.manual_fields(pages(spark, sf_dir))
    return rows.select("page_id", "course_code", "course_title", "year", "manual_page_type", F.size("all_files").cast("long").alias("n_files"), F.size("all_internal_links").cast("long").alias("n_internal"))


@query
def analyze_pages(spark, sf_dir):
    return analyze.analyze_pages(pages(spark, sf_dir), HeuristicProvider())


# Entity resolution


@query
def components(spark, sf_dir):
    return resolve.components(page_rows(spark, sf_dir)).select("idx", "component")


@query
def canonical_rows(spark, sf_dir):
    return resolve.canonical(resolve.components(page_rows(spark, sf_dir)))


@query
def resolved_rows(spark, sf_dir):
    return resolve.resolved(frame(spark, "lit_rows"))


@query
def resolve_check(spark, sf_dir):
    rows = resolve.components(page_rows(spark, sf_dir))
    return stats.resolve_check(rows)


# Catalogue (G1, O1-O4, X11-X16, D-6, R3-R5, A5)


@query
def group_tiers(spark, sf_dir):
    return catalog.grouped(frame(spark, "lit_groups")).select("idx", "group_type", "group_key")


@query
def group_tiers_pages(spark, sf_dir):
    return catalog.grouped(page_rows(spark, sf_dir)).select("idx", "group_type", "group_key")


@query
def group_index(spark, sf_dir):
    return catalog.indexed(frame(spark, "lit_groups")).select("idx", "group_key", "index", "course_code", "course_title", "semester", "year", "year_int")


@query
def group_order(spark, sf_dir):
    return catalog.group_order(frame(spark, "lit_groups"), 4).select("group_key", "group_type", "n_links")


@query
def material_type(spark, sf_dir):
    rows = frame(spark, "lit_anchor")
    return rows.select("id", F.when(U.is_material_file(F.col("url")), T.material_type(F.col("text"), F.col("url"))).alias("item_type"))


@query
def material_dedup(spark, sf_dir):
    rows = frame(spark, "lit_anchor").select("id", F.coalesce(T.material_type(F.col("text"), F.col("url")), F.lit("unknown")).alias("item_type"), F.col("text").alias("title"), F.col("url").alias("file_url"))
    return dedup.material_dedup(rows, [], ["id"]).select("id", "item_type", "file_url")


@query
def friendly_title(spark, sf_dir):
    rows = frame(spark, "lit_anchor")
    return rows.select("id", T.is_generic(F.col("text")).alias("is_generic"), T.display_title(F.col("text"), F.col("url")).alias("title"))


@query
def sem_label(spark, sf_dir):
    return frame(spark, "lit_groups").select("idx", T.semester_label(F.col("semester"), F.col("year")).alias("label"))


@query
def page_materials(spark, sf_dir):
    return catalog.materials(catalog.facts(pages(spark, sf_dir)))


@query
def render_markdown(spark, sf_dir):
    index = catalog.indexed(frame(spark, "lit_groups"))
    files = frame(spark, "lit_anchor").withColumn("item_type", T.material_type(F.col("text"), F.col("url"))).where("item_type is not null")
    items = files.select(F.lit("course_code").alias("group_type"), F.lit("CS2").alias("group_key"), (F.col("id") % 3 + 1).alias("index"), F.col("id").alias("pos"), "item_type", F.col("text").alias("title"), F.col("text").alias("snippet"), F.col("url").alias("file_url"))
    return catalog.rendered(index, items)


@query
def generate_pages(spark, sf_dir):
    rows = page_rows(spark, sf_dir).withColumn("semester", F.lit(""))
    return catalog.generate(rows, pages(spark, sf_dir))["markdown"]


@query
def generation_summary(spark, sf_dir):
    rows = pages(spark, sf_dir).select("url", (F.col("page_id") % 97 == 0).alias("failed"), (F.col("page_id") % 5).alias("extracted_count"))
    return stats.generation_summary(rows).select("processed_count", "failed_count", "items", F.size("failed_urls").cast("long").alias("n_failed_urls"))
