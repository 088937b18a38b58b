"""Catalogue: groups, indexes, materials and Markdown (G1, O1-O4, X11, X16, D-6, A12, R3-R5, F9)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright import scratch
from pagewright.config import DEFAULT, Settings
from pagewright.functions import html as H
from pagewright.functions import text as T
from pagewright.functions import url as U
from pagewright.operators.dedup import material_dedup
from pagewright.operators.ranking import numbered
from pagewright.providers import parse_json_ladder

FIELDS = ["url", "course_code", "course_title", "semester", "year"]


def grouped(rows: DataFrame) -> DataFrame:
    """G1, O3: rows ``(idx, url, course_code, ...)`` with ``group_type``, ``group_key`` and ``type_rank``.

    Rows with neither code nor title are groups of their own, numbered by input order.
    """
    code, title = T.safe_text(F.col("course_code")), T.safe_text(F.col("course_title"))
    kind = F.when(code != "", "course_code").when(title != "", "course_title").otherwise("singleton")
    typed = rows.withColumns({"group_type": kind, "_key": F.when(code != "", code).when(title != "", title)})
    single = typed.where("group_type = 'singleton'").withColumn("type_rank", F.lit(2))
    single = numbered(single, ["idx"]).withColumn("group_key", F.concat(F.lit("singleton_"), F.col("number").cast("string")))
    named = typed.where("group_type <> 'singleton'").withColumns({"type_rank": F.when(F.col("group_type") == "course_code", 0).otherwise(1), "group_key": F.col("_key")})
    return named.unionByName(single.select(*named.columns)).drop("_key")


def year_of(row_year, term, current_year: int):
    """O1: of the year, or of the term where there is no year."""
    return T.year_int(F.coalesce(T.null_if_empty(row_year), T.null_if_empty(term)), current_year)


def facts(pages: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """What a catalogue needs of each page, parsed once: ``page_id, url, page_year, anchors, code``."""
    year = T.year_int(F.col("parsed.visible"), settings.current_year)
    return scratch.table(H.parsed(pages).select("page_id", "url", year.alias("page_year"), "parsed.anchors", "parsed.code"), "catalog-facts")


def indexed(rows: DataFrame, settings: Settings = DEFAULT, years: DataFrame | None = None) -> DataFrame:
    """Rows of each group by year, newest first, and their 1-based index.

    With ``years`` (``url, page_year``), rows without a year take the latest year in their page's text, for the order only;
    of several pages with a row's url, the latest of all.
    """
    groups = grouped(rows)
    year = year_of(F.col("year"), F.col("semester"), settings.current_year)
    groups = groups.withColumn("year_int", year)
    if years is not None:
        latest = years.groupBy("url").agg(F.max("page_year").alias("page_year"))
        groups = groups.join(latest, "url", "left").withColumn("year_int", F.coalesce(F.when(F.col("year_int") > 0, F.col("year_int")), "page_year", F.lit(0))).drop("page_year")
    order = Window.partitionBy("group_type", "group_key").orderBy(F.desc("year_int"), "idx")
    out = groups.withColumn("index", F.row_number().over(order))
    return out.withColumns({c: T.null_if_empty(T.safe_text(F.col(c))) for c in FIELDS[1:]})


def group_order(rows: DataFrame, limit: int = 0) -> DataFrame:
    """Groups with their number of links: by code, then by title, then singletons in input order."""
    groups = grouped(rows).groupBy("type_rank", "group_type", "group_key").agg(F.count("*").alias("n_links"), F.min("idx").alias("first_idx"))
    ordered = groups.orderBy("type_rank", F.when(F.col("type_rank") == 2, F.lpad(F.col("first_idx").cast("string"), 20, "0")).otherwise(F.col("group_key")))
    return ordered.limit(limit) if limit > 0 else ordered


def materials(rows: DataFrame, of: str = "page_id") -> DataFrame:
    """X11, D-6: ``page_id, url, pos, item_type, title, snippet, file_url, confidence`` of each page (or url) of ``facts``, first of equals."""
    links = rows.select("page_id", "url", F.explode("anchors").alias("a")).select("page_id", "url", "a.pos", "a.href", F.col("a.text_spaced").alias("text"))
    links = links.where((F.col("href") != "") & ~U.material_skips(F.col("href"))).withColumn("file_url", U.join(F.col("url"), F.col("href")))
    links = links.where(U.is_material_file(F.col("file_url"))).withColumn("item_type", T.material_type(F.col("text"), F.col("file_url"))).where("item_type is not null")
    title = F.coalesce(T.null_if_empty(F.col("text")), U.basename(F.col("file_url")))
    files = links.select("page_id", "url", "pos", "item_type", title.alias("title"), F.substring("text", 1, 200).alias("snippet"), "file_url", F.lit("medium").alias("confidence"))
    code = rows.select("page_id", "url", F.posexplode("code").alias("pos", "text")).where(T.is_inline_code(F.col("text")))
    inline = code.select(
        "page_id", "url", (F.col("pos") + (1 << 20)).alias("pos"), F.lit("example_code").alias("item_type"), F.lit("inline code snippet").alias("title"),
        F.substring("text", 1, 200).alias("snippet"), F.lit(None).cast("string").alias("file_url"), F.lit("low").alias("confidence"),
    )
    return material_dedup(files.unionByName(inline), [of], ["page_id", "pos"])


def materials_by_model(pages: DataFrame, provider, settings: Settings = DEFAULT, of: str = "page_id") -> DataFrame:
    """M14, D-7: items of every window of a page, first of equals of a page (or url); a window whose call fails gives none."""
    windows = pages.select("page_id", "url", F.posexplode(T.chunks(F.col("html"), settings.content_chars)).alias("window", "chunk"))
    schema = "page_id long, url string, pos long, item_type string, title string, snippet string, file_url string, confidence string"

    def call(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["item_type", "title", "snippet", "file_url", "confidence"]
        for batch in batches:
            out = []
            for page_id, url, window, chunk in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    items = parse_json_ladder(provider.materials(chunk)).get("extracted_items") or []
                except Exception:  # errors of a window are passed over
                    items = []
                out.extend((page_id, url, (window << 20) + k, *(item.get(n) for n in names)) for k, item in enumerate(items))
            columns = list(zip(*out, strict=True)) if out else [()] * 8
            types = [pa.int64(), pa.string(), pa.int64()] + [pa.string()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["page_id", "url", "pos", *names])

    return material_dedup(windows.mapInArrow(call, schema), [of], ["page_id", "pos"])


def _titles(index):
    """(title, code): rows up to the first with a title; each code seen on the way replaces the last."""
    with_title = F.filter(index, lambda r: F.coalesce(r["course_title"], F.lit("")) != "")
    title = F.coalesce(F.get(with_title, F.lit(0))["course_title"], F.lit(""))
    until = F.coalesce(F.get(with_title, F.lit(0))["index"], F.element_at(index, -1)["index"])
    coded = F.filter(index, lambda r: (F.coalesce(r["course_code"], F.lit("")) != "") & (r["index"] <= until))
    return title, F.coalesce(F.get(coded, F.size(coded) - 1)["course_code"], F.col("group_key"))


def rendered(index: DataFrame, items: DataFrame) -> DataFrame:
    """``group_type, group_key, file, markdown`` of every group.

    ``index``: rows of ``indexed``; ``items``: ``group_type, group_key, index, pos, item_type, title, description?, snippet, file_url``.
    A page's items become text where they are; only finished sections meet in a group. Items of
    other kinds, or of none, are not shown, but their page is no page without materials.
    """
    ranks = {kind: i for i, kind in enumerate(T.ITEM_ORDER)}
    rank = F.element_at(F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair]), F.col("item_type"))
    long = F.col("description") if "description" in items.columns else F.lit(None).cast("string")
    name = T.display_title(F.col("title"), F.col("file_url"))
    link = F.coalesce(F.col("file_url"), F.lit(""))
    said = T.description(long, F.col("snippet"))
    line = F.concat(
        F.when(link != "", F.concat(F.lit("#### ["), name, F.lit("]("), link, F.lit(")\n"))).otherwise(F.concat(F.lit("#### "), name, F.lit("\n"))),
        F.when(said != "", F.concat(F.lit("> "), said, F.lit("\n"))).otherwise(""), F.lit("\n"),
    )
    lines = items.withColumns({"rank": rank, "line": line})
    keys = ["group_type", "group_key", "index"]
    sections = lines.groupBy(*keys, "rank").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "").alias("body"))
    label = F.element_at(F.array(*[F.lit(T.ITEM_LABELS[k]) for k in T.ITEM_ORDER]), F.col("rank") + 1)
    sections = sections.withColumn("body", F.when(F.col("rank").isNotNull(), F.concat(F.lit("### "), label, F.lit("\n\n"), F.col("body"))).otherwise(""))
    bodies = sections.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "body"))), lambda x: x["body"]), "").alias("body"))
    url = F.coalesce("url", F.lit(""))
    part = F.concat(
        F.lit("## "), T.semester_label(F.col("semester"), F.col("year")), F.lit("\n\n**Source:** [Course Page]("), url, F.lit(")\n\n"),
        F.when(F.col("body").isNull(), F.lit("*No learning materials could be extracted from this page.*\n\n")).otherwise(
            F.concat(F.col("body"), F.lit("*Full course page: ["), url, F.lit("]("), url, F.lit(")*\n\n"))
        ),
        F.lit("---\n"),
    )
    rows = index.join(bodies, keys, "left").withColumn("part", part)
    one = F.sort_array(F.collect_list(F.struct("index", "course_title", "course_code", "part"))).alias("rows")
    groups = rows.groupBy("group_type", "group_key").agg(one)
    title, code = _titles(F.col("rows"))
    groups = groups.withColumns({"_title": title, "_code": code})
    shown = F.when(F.col("_title") == "", F.col("_code")).otherwise(F.col("_title"))
    full = F.when((F.col("_title") != "") & (F.col("_title") != F.col("_code")), F.concat("_title", F.lit(" — "), "_code")).otherwise(shown)
    head = F.concat(
        F.lit('---\ntitle: "'), full, F.lit('"\ncourse_code: "'), F.col("_code"), F.lit('"\n'),
        F.when(F.col("_title") != "", F.concat(F.lit('course_title: "'), F.col("_title"), F.lit('"\n'))).otherwise(""), F.lit("---\n\n# "), full, F.lit("\n\n"),
    )
    body = F.array_join(F.transform("rows", lambda r: r["part"]), "\n")
    return groups.select("group_type", "group_key", U.safe_filename(F.col("group_key")).alias("file"), F.concat(head, body).alias("markdown"))


def index_json(index: DataFrame) -> DataFrame:
    """K7: ``group_type, group_key, file, json`` of every group's index."""
    links = F.sort_array(F.collect_list(F.struct("index", *FIELDS))).alias("links")
    groups = index.groupBy("group_type", "group_key").agg(links)
    return groups.select("group_type", "group_key", U.safe_filename(F.col("group_key")).alias("file"), F.to_json(F.struct("links"), {"ignoreNullFields": "false"}).alias("json"))


def generate(rows: DataFrame, pages: DataFrame, settings: Settings = DEFAULT, provider=None, limit: int = 0) -> dict[str, DataFrame]:
    """``index``, ``items``, ``markdown`` and ``outcome`` (a row a link: url, failed, extracted_count).

    Several pages of one url are one source: a row of that url stands once, with the materials of all of them, first of equals.
    Like the process that this follows, a page that cannot be read counts as failed once, and once more if its year was looked for.
    """
    if limit:
        chosen = group_order(rows, limit).select("group_type", "group_key")
        rows = grouped(rows).join(chosen, ["group_type", "group_key"], "left_semi").select(*rows.columns)
    known = facts(pages, settings)
    index = indexed(rows, settings, known)
    found = materials(known, "url") if provider is None else materials_by_model(pages, provider, settings, "url")
    items = index.select("group_type", "group_key", "index", "url").join(found.drop("page_id"), "url")
    counts = items.groupBy("group_type", "group_key", "index").agg(F.count("*").alias("extracted_count"))
    read = pages.where("html is not null and html <> ''").select("url", F.lit(True).alias("known")).distinct()
    outcome = index.join(read, "url", "left").join(counts, ["group_type", "group_key", "index"], "left")
    unread = F.col("known").isNull()
    looked = year_of(F.col("year"), F.col("semester"), settings.current_year) == 0
    times = F.when(unread & looked, 2).otherwise(1)
    outcome = outcome.select("url", unread.alias("failed"), F.coalesce("extracted_count", F.lit(0)).alias("extracted_count"), F.when(unread, times).otherwise(0).alias("failures"))
    return {"index": index, "items": items, "markdown": rendered(index, items), "outcome": outcome}
