"""Links of pages (L1-L15, F1, F2): generators, rules and first-wins dedup."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import html
from pagewright.functions import url as U
from pagewright.operators.dedup import first_in_array


def anchors(pages: DataFrame, context: bool = False) -> DataFrame:
    """Rules 1 and 2: every anchor with an href, in page order."""
    rows = html.parsed(pages, context).select("page_id", F.col("url").alias("source_url"), F.explode("parsed.anchors").alias("a"))
    return rows.select("page_id", "source_url", "a.pos", "a.href", "a.text", "a.title", "a.text_spaced", "a.html_context").where("href <> ''")


def resolved(rows: DataFrame) -> DataFrame:
    """Rules 3 to 7: leads somewhere, absolute, http or https, without fragment, no static file."""
    kept = rows.where(~U.leads_nowhere(F.col("href"))).withColumn("url", U.join(F.col("source_url"), F.col("href")))
    kept = kept.where(U.scheme(F.col("url")).isin("http", "https")).withColumn("url", U.without_fragment(F.col("url")))
    return kept.where(~U.is_file(F.col("url")))


def _resolved(items: Column, source: Column) -> Column:
    """Rules 1 to 7 within a page's array of anchors: structs of the anchor ``a`` and its ``url``."""
    lead = F.filter(items, lambda a: (a["href"] != "") & ~U.leads_nowhere(a["href"]))
    joined = F.transform(lead, lambda a: F.struct(a.alias("a"), U.join(source, a["href"]).alias("url")))
    web = F.filter(joined, lambda x: U.scheme(x["url"]).isin("http", "https"))
    plain = F.transform(web, lambda x: F.struct(x["a"].alias("a"), U.without_fragment(x["url"]).alias("url")))
    return F.filter(plain, lambda x: ~U.is_file(x["url"]))


def _first_links(rows: DataFrame, anchors: str) -> DataFrame:
    """Pages ``page_id, source_url`` with their ``links`` by rules 1 to 8."""
    found = rows.withColumn("links", _resolved(F.col(anchors), F.col("source_url")))
    return first_in_array(found, "links", lambda x: U.anchor_key(x["url"]))


def page_links(pages: DataFrame, context: bool = False) -> DataFrame:
    """L1: the anchors of each page by rules 1 to 8, with ``tag`` = a."""
    rows = html.parsed(pages, context).select("page_id", F.col("url").alias("source_url"), F.col("parsed.anchors").alias("anchors"))
    rows = _first_links(rows, "anchors").select("page_id", "source_url", F.explode("links").alias("l"))
    fields = ["pos", "href", "text", "title", "text_spaced", "html_context"]
    return rows.select("page_id", "source_url", *[f"l.a.{f}" for f in fields], "l.url", F.lit("a").alias("tag"))


def page_links_native(pages: DataFrame) -> DataFrame:
    """L1 for regular html, all in the JVM."""
    rows = html.anchor_array_native(pages).withColumnRenamed("url", "source_url")
    rows = _first_links(rows, "anchors").select("page_id", "source_url", F.explode("links").alias("l"))
    return rows.select("page_id", "source_url", "l.a.pos", "l.a.href", "l.a.text", "l.url")


def extracted_links(pages: DataFrame) -> DataFrame:
    """The links of each page, anchors before other tags, numbered by ``pos`` in that order.

    Urls of other tags stay unless an anchor of the page has them; of equals the first in tag order.
    A page is parsed once, and its links never leave its row before they are whole.
    """
    rows = html.parsed(pages).select("page_id", F.col("url").alias("source_url"), F.col("parsed.anchors").alias("anchors"), F.col("parsed.resources").alias("resources"))
    rows = rows.withColumn("resolved", _resolved(F.col("anchors"), F.col("source_url")))
    rows = first_in_array(rows.withColumn("links", F.col("resolved")), "links", lambda x: U.anchor_key(x["url"]))

    def item(tag: Column, order: Column, pos: Column, href: Column, text: Column, title: Column, url: Column) -> Column:
        values = zip(("tag_order", "pos", "tag", "href", "text", "title", "url"), (order, pos, tag, href, text, title, url), strict=True)
        return F.struct(*[value.alias(name) for name, value in values])

    anchor = lambda x, url: item(F.lit("a"), F.lit(-1), x["a"]["pos"], x["a"]["href"], x["a"]["text"], x["a"]["title"], url)
    taken = F.concat(F.transform("resolved", lambda x: anchor(x, x["url"])), F.transform("resolved", lambda x: anchor(x, U.https(x["url"]))))
    other = F.transform("resources", lambda r: item(r["tag"], r["tag_order"], r["pos"], r["href"], r["text"], r["title"], U.join(F.col("source_url"), r["href"])))
    own = F.transform("links", lambda x: anchor(x, x["url"]))
    rows = rows.select("page_id", "source_url", own.alias("own"), F.concat(taken, F.sort_array(other)).alias("all"))
    rows = first_in_array(rows, "all", lambda x: x["url"])
    whole = F.concat("own", F.filter("all", lambda x: x["tag_order"] >= 0))
    rows = rows.select("page_id", "source_url", F.posexplode(whole).alias("pos", "l"))
    return rows.select("page_id", "source_url", "l.tag", "pos", "l.href", "l.text", "l.title", "l.url")


def resource_links(pages: DataFrame) -> DataFrame:
    """The links of other tags than anchors."""
    return extracted_links(pages).where("tag <> 'a'")


def page_files(pages: DataFrame) -> DataFrame:
    """Downloadable files of each page, first of equals: ``page_id, pos, href, text``."""
    return _listed(pages, lambda a: F.lit(True), lambda a, source: U.is_course_file(a["href"]))


def internal_links(pages: DataFrame) -> DataFrame:
    """Links within the page's host; fragments and files stay."""
    inside = lambda a, source: U.scheme(a["href"]).isin("http", "https") & U.same_domain(a["href"], U.netloc(source))
    return _listed(pages, lambda a: ~U.page_skips(a["href"]), inside)


def listed(anchors: Column, source: Column, before: Callable, after: Callable) -> Column:
    """Structs ``pos, href, text`` of a page's anchors that pass ``before``, made absolute, and then ``after``."""
    lead = F.filter(anchors, lambda a: (a["href"] != "") & before(a))
    full = F.transform(lead, lambda a: F.struct(a["pos"].alias("pos"), U.join(source, a["href"]).alias("href"), a["text_spaced"].alias("text")))
    return F.filter(full, lambda a: after(a, source))


def _listed(pages: DataFrame, before: Callable, after: Callable) -> DataFrame:
    rows = html.parsed(pages).select("page_id", F.col("url").alias("source_url"), F.col("parsed.anchors").alias("anchors"))
    rows = rows.withColumn("found", listed(F.col("anchors"), F.col("source_url"), before, after))
    return first_in_array(rows, "found", lambda a: a["href"]).select("page_id", F.explode("found").alias("a")).select("page_id", "a.pos", "a.href", "a.text")


def with_site(links: DataFrame, domain) -> DataFrame:
    """``is_external``, ``is_file_link`` of a site's own links."""
    external = ~U.same_domain(F.col("url"), domain)
    return links.withColumns({"is_external": external, "is_file_link": ~external & U.is_file(F.col("url"))})


def with_folder(files: DataFrame, parent: str, depth: int) -> DataFrame:
    """T5: a file link with the page that it was found on."""
    return files.withColumns({"parent_folder": F.lit(parent), "parent_depth": F.lit(depth)})


def top_of_bucket(links: DataFrame, k: int, order: list[str]) -> DataFrame:
    """F8: the first ``k`` links of each bucket, for a summary."""
    return links.withColumn("_k", F.row_number().over(Window.partitionBy("bucket").orderBy(*order))).where(F.col("_k") <= k).drop("_k")
