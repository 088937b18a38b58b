"""Bounded traversal of the link graph and verification of candidates (G6, G7, M8-M10, J6, J7, D-2)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from pagewright import scratch
from pagewright.config import DEFAULT, Settings
from pagewright.functions import classify as C
from pagewright.functions import html as H
from pagewright.functions import text as T
from pagewright.functions import url as U
from pagewright.operators import cache as K
from pagewright.operators import links as L
from pagewright.operators.dedup import bucket_dedup, first_wins
from pagewright.providers import parse_json_ladder
from pagewright.schemas import VERIFICATION
from pagewright.sources.tables import exists

# Fixed value: the error of a page that could not be read for verification.
VERIFICATION_FAILED = "Content verification failed – page may be inaccessible (forbidden or no response)"
#: The error of a url that the page table does not hold.
NO_PAGE = "no page"
#: Buckets of links that are judged.
JUDGED = ("back_link", "course_page", "course_relevant", "irrelevant")


def levels(edges: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """``(node, depth)`` of all nodes within ``max_depth`` steps ``(src, dst)`` of the seeds ``(node)``, at their least depth.

    Level by level: the frontier is joined with the edges, and what was visited is taken out. Each
    level is written to the shared folder, so lineage does not grow and a level is a checkpoint (K2).
    """
    frontier = scratch.table(seeds.select("node").distinct().withColumn("depth", F.lit(0)), "crawl-level")
    visited = frontier
    for depth in range(1, max_depth + 1):
        reached = frontier.join(edges, frontier.node == edges.src).select(F.col("dst").alias("node")).distinct()
        frontier = scratch.table(reached.join(visited, "node", "left_anti").withColumn("depth", F.lit(depth)), "crawl-level")
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited


def crawl(pages: DataFrame, seeds: DataFrame, cache: DataFrame, provider, settings: Settings = DEFAULT, verify: bool = False, state: str | None = None) -> dict[str, DataFrame]:
    """Follow course-relevant links from the seeds ``(url)``; the result has ``links`` (by bucket, first wins), ``visited`` and ``inaccessible``,
    and the links of anchors and other tags as they were found: ``all_extracted``, ``external`` and ``files`` (with the page as
    ``parent_folder`` and ``parent_depth``), first wins each.

    With ``verify``, course pages are verified and what their pages link to is added (M10, a level below the page that links).

    Pages come from a table; a url without a page, or whose page has an ``error`` instead of html, is
    inaccessible (J7). Visited urls are compared as they are written. A page at ``max_depth`` is read
    but not followed.

    ``state`` names a folder that keeps every level as it is done; a crawl that was cut short goes on
    from there (K2). Urls meet the page table as narrow rows first; html is read for a frontier alone.
    """
    spark = pages.sparkSession

    def stored(rows: Callable[[], DataFrame], label: str) -> DataFrame:
        if state is None:
            return scratch.table(rows(), f"crawl-{label}")
        at = f"{state}/{label}"
        if not exists(spark, f"{at}/_SUCCESS"):
            rows().write.mode("overwrite").parquet(at)
        return spark.read.parquet(at)

    why = F.coalesce(F.col("error") if "error" in pages.columns else F.lit(None).cast("string"), F.lit(NO_PAGE))
    index = stored(lambda: pages.select("url", "page_id", F.col("html").isNotNull().alias("readable"), F.when(F.col("html").isNull(), why).alias("error")), "index")
    frontier = stored(lambda: seeds.select("url").distinct().withColumn("depth", F.lit(0)), "frontier-0")
    domain = U.netloc(F.col("source_url"))

    def level(frontier: DataFrame, depth: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Links as they were found, the site's own judged, and urls without a page."""
        at = F.lit(depth).alias("depth")
        here = stored(lambda: frontier.join(index, "url", "left"), f"here-{depth}")
        gone = here.where("not coalesce(readable, false)").select("url", F.lit("inaccessible").alias("bucket"), at, F.coalesce("error", F.lit(NO_PAGE)).alias("error"))
        read = pages.select("page_id", "url", "html").join(here.where("readable").select("url"), "url", "left_semi")
        extracted = stored(lambda: L.with_site(L.extracted_links(read), domain).withColumn("depth", at), f"extracted-{depth}")
        rows = extracted.where("not is_external and not is_file_link")

        def judge() -> DataFrame:
            judged, _ = K.filter_links(rows.select("page_id", "pos", "url", "text"), cache, provider, settings)
            placed = judged.drop("pos").join(rows.select("page_id", "url", "source_url", "pos", "text", "title"), ["page_id", "url"])
            return placed.select("page_id", "pos", "url", "text", "title", "source_url", "bucket", "method", "confidence", at)

        return extracted, stored(judge, f"links-{depth}"), gone

    every, found, missing = level(frontier, 0)
    visited, placed = frontier, found
    for depth in range(1, settings.max_depth + 1):
        onward = placed.where("bucket = 'course_relevant'").select("url").distinct().join(visited, "url", "left_anti")
        frontier = stored(partial(onward.withColumn, "depth", F.lit(depth)), f"frontier-{depth}")
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
        extracted, placed, gone = level(frontier, depth)
        every, found, missing = every.unionByName(extracted), found.unionByName(placed), missing.unionByName(gone)
    links = bucket_dedup(found, ["depth", "page_id", "pos"])
    if verify:
        candidates = links.where("bucket = 'course_page'")
        checked = scratch.table(verified(candidates, pages, provider, settings), "crawl-verified")
        fresh = expanded(checked, pages, cache, provider, settings).withColumn("norm", U.page_norm(F.col("url")))
        seen = candidates.select(F.lit("course_page").alias("bucket"), U.page_norm(F.col("url")).alias("norm"))  # verified once, whatever came of it
        fresh = fresh.join(seen, ["bucket", "norm"], "left_anti").join(checked.select(F.col("url").alias("source_url"), (F.col("depth") + 1).alias("depth")), "source_url")
        kept = links.where("bucket <> 'course_page'").unionByName(checked.where("action <> 'dropped'").withColumn("bucket", F.col("action")).select(*links.columns))
        links = bucket_dedup(kept.unionByName(fresh.select(*links.columns)), ["depth", "page_id", "pos"])
    unique = lambda rows: first_wins(rows, [U.page_norm(F.col("url"))], ["depth", "page_id", "pos"])
    files = every.where("is_file_link").withColumns({"parent_folder": F.col("source_url"), "parent_depth": F.col("depth")})
    return {
        "links": links, "visited": visited, "inaccessible": first_wins(missing, [U.page_norm(F.col("url"))], ["depth"]),
        **({"verified": checked} if verify else {}),
        "all_extracted": unique(every), "external": unique(every.where("is_external")), "files": unique(files),
    }


def verified(candidates: DataFrame, pages: DataFrame, provider, settings: Settings = DEFAULT) -> DataFrame:
    """M8, M9: candidates with ``action``: course_page, course_relevant (it has links), dropped or inaccessible."""
    wanted = candidates.select("url").distinct().join(pages.select("url", "page_id", "html"), "url", "left")
    parsed = scratch.table(H.parsed(wanted), "crawl-parsed")
    text = T.readable(F.col("parsed.readable"), settings.content_chars)
    ready = parsed.select("url", "html", text.alias("content"))
    schema = StructType.fromDDL(f"url string, answer {VERIFICATION}")
    kind = to_arrow_type(schema["answer"].dataType)

    def call(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers = []
            for url, html, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    read = parse_json_ladder(provider.verify(url, content)) if html is not None else None
                except Exception:  # a failed call makes the page inaccessible, not the job
                    read = None
                answers.append(read and {
                    "is_course_page": bool(read.get("is_course_page")), "confidence": float(read.get("confidence") or 0), "course_code": read.get("course_code"),
                    "course_name": read.get("course_name"), "semester": read.get("semester"), "reasoning": read.get("reasoning"),
                    "has_other_course_links": bool(read.get("has_other_course_links")),
                })
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(answers, kind)], names=["url", "answer"])

    answered = ready.mapInArrow(call, schema)
    n_links = L.page_links(parsed.where("html is not null")).groupBy(F.col("source_url").alias("url")).agg(F.count("*").alias("n_links"))
    joined = candidates.join(answered, "url", "left").join(n_links, "url", "left")
    found = F.when(F.col("answer.has_other_course_links"), F.col("n_links"))
    action = C.verify_action(F.col("answer").isNotNull(), F.col("answer.is_course_page"), F.col("answer.confidence"), found)
    judged = joined.withColumn("action", action)
    moved, gone = F.col("action") == "course_relevant", F.col("action") == "inaccessible"
    return judged.withColumns({
        "reclassified_from": F.when(moved, "course_page"), "reason": F.when(moved, "has_other_course_links"),
        "error": F.when(gone, VERIFICATION_FAILED),
    })


def expanded(checked: DataFrame, pages: DataFrame, cache: DataFrame, provider, settings: Settings = DEFAULT) -> DataFrame:
    """Links of verified and reclassified pages; only course pages and course-relevant ones are kept."""
    sources = checked.where("action in ('course_page', 'course_relevant') and answer.has_other_course_links").select("url").distinct().join(pages, "url")
    rows = L.page_links(sources)
    judged, _ = K.filter_links(rows.select("page_id", "pos", "url", "text"), cache, provider, settings)
    judged = judged.where("bucket in ('course_page', 'course_relevant')")
    return judged.drop("pos").join(rows.select("page_id", "url", "source_url", "pos", "text", "title"), ["page_id", "url"])


def buckets(result: dict[str, DataFrame]) -> DataFrame:
    """All lists of a crawl's result as rows with ``bucket``; a url that two sources call inaccessible is one row."""
    out = result["links"].where("bucket <> 'inaccessible'")
    for bucket, key in (("all_extracted", "all_extracted"), ("external", "external"), ("file", "files")):
        out = out.unionByName(result[key].withColumn("bucket", F.lit(bucket)), allowMissingColumns=True)
    gone = result["inaccessible"].unionByName(result["links"].where("bucket = 'inaccessible'"), allowMissingColumns=True)
    return out.unionByName(first_wins(gone, [U.page_norm(F.col("url"))], ["depth", "page_id", "pos"]), allowMissingColumns=True)


def result_json(result: dict[str, DataFrame], base_url: str) -> DataFrame:
    """A crawl's result as one row of JSON (bounded by what one crawl of a site finds)."""
    rows = buckets(result)
    row = F.struct("depth", "page_id", "pos", "url", "text", "tag", "confidence", "parent_folder", "parent_depth", "error")
    kind = rows.select(row.alias("r")).schema["r"].dataType.simpleString()
    listed = lambda bucket: F.sort_array(F.coalesce(F.element_at("lists", bucket), F.array().cast(f"array<{kind}>")))
    grouped = rows.groupBy("bucket").agg(F.collect_list(row).alias("rows"))
    lists = grouped.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "rows"))).alias("lists"))
    visited = result["visited"].agg(F.sort_array(F.collect_list("url")).alias("visited_urls"))
    both = lists.crossJoin(visited)  # a row each
    own = {"all_extracted_links": "all_extracted", "external_links": "external", "file_links": "file", "inaccessible_links": "inaccessible"}
    judged = F.map_from_arrays(F.array(*map(F.lit, JUDGED)), F.array(*map(listed, JUDGED)))
    sizes = {"external_links": "external", "course_pages": "course_page", "course_relevant": "course_relevant", "back_links": "back_link", "irrelevant": "irrelevant", "file_links": "file", "inaccessible": "inaccessible"}
    n_all = F.size(listed("all_extracted"))
    stats = F.struct(
        F.size("visited_urls").alias("total_visited"), n_all.alias("total_links_extracted"), (n_all - F.size(listed("external"))).alias("same_domain_links"),
        *[F.size(listed(bucket)).alias(name) for name, bucket in sizes.items()],
    )
    whole = F.struct(F.lit(base_url).alias("base_url"), "visited_urls", judged.alias("links"), *[listed(bucket).alias(name) for name, bucket in own.items()], stats.alias("stats"))
    return both.select(F.to_json(whole).alias("json"))
