"""Command line: ``python -m pagewright fetch | crawl | analyze | resolve | generate``."""

from __future__ import annotations

import argparse
import os
from dataclasses import replace

from pyspark.sql import functions as F

from pagewright.config import DEFAULT
from pagewright.operators import analyze, catalog, crawl, ranking, resolve, stats
from pagewright.providers import HeuristicProvider, HttpProvider, KeyRing, RetryingProvider
from pagewright.session import get_spark, ship
from pagewright.sources import sinks, tables

RECORDS = "cache_key string, is_back_link boolean, is_course_page boolean, is_course_relevant boolean, confidence double, reasoning string"


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pagewright")
    commands = parser.add_subparsers(dest="command", required=True)
    model = argparse.ArgumentParser(add_help=False)
    model.add_argument("--endpoint", help="a chat endpoint; without one, rules answer. Keys: API_KEYS, or API_KEY and API_KEY_1, ... of the environment")
    model.add_argument("--model", default="")
    model.add_argument("--no-ai", "--no-llm", dest="rules", action="store_true", help="rules only, whatever the endpoint")
    f = commands.add_parser("fetch", help="pages of a list of urls")
    f.add_argument("--urls", required=True)
    f.add_argument("--output", required=True)
    f.add_argument("--delay", type=float, default=DEFAULT.delay_s)
    c = commands.add_parser("crawl", parents=[model], help="follow links through a table of pages")
    c.add_argument("--url", required=True)
    c.add_argument("--pages", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--depth", type=int, default=DEFAULT.max_depth)
    c.add_argument("--cache", help="a JSON file of known classifications")
    c.add_argument("--verify-content", action="store_true")
    c.add_argument("--state", help="a folder for finished levels; a crawl that was cut short goes on from there")
    a = commands.add_parser("analyze", parents=[model], help="course rows from pages")
    a.add_argument("--pages", required=True)
    a.add_argument("--output", required=True)
    r = commands.add_parser("resolve", help="one code and title for rows of the same course")
    r.add_argument("--input", required=True)
    r.add_argument("--output", required=True)
    g = commands.add_parser("generate", parents=[model], help="Markdown and indexes by course")
    g.add_argument("--input", action="append", required=True, help="may be repeated: the first that exists is read")
    g.add_argument("--pages")
    g.add_argument("--output")
    g.add_argument("--limit", type=int, default=0)
    g.add_argument("--test", action="store_true", help="the first three groups")
    g.add_argument("--dry-run", action="store_true", help="list the groups only")
    return parser


def asked(args: argparse.Namespace):
    """The model that answers, or None for rules."""
    if not args.endpoint or args.rules:
        return None
    return RetryingProvider(HttpProvider(args.endpoint, args.model, KeyRing.from_settings(dict(os.environ))))


def show(title: str, rows) -> None:
    """A summary of a few rows."""
    print(title)
    for row in rows.collect():
        print("  " + ", ".join(f"{name}: {value}" for name, value in row.asDict().items()))


def main(argv: list[str] | None = None) -> int:
    args = arguments().parse_args(argv)
    spark = get_spark()
    ship(spark)
    if args.command == "fetch":
        urls = ranking.numbered(tables.url_list(spark, args.urls), ["url"], "page_id")
        found = tables.fetched(urls, delay_s=args.delay)
        urls.join(found, "url").select("page_id", "url", "html", "error").write.mode("overwrite").parquet(args.output)
    elif args.command == "crawl":
        seeds = spark.createDataFrame([(args.url,)], "url string")
        known = tables.cache(spark, args.cache) if args.cache else spark.createDataFrame([], RECORDS)
        settings = replace(DEFAULT, max_depth=args.depth)
        result = crawl.crawl(tables.pages(spark, args.pages), seeds, known, asked(args) or HeuristicProvider(), settings, args.verify_content, args.state)
        lists = crawl.buckets(result)
        sinks.buckets(lists, f"{args.output}/links")
        sinks.json_rows(crawl.result_json(result, args.url), f"{args.output}/result")
        found = spark.read.parquet(f"{args.output}/links")
        show("Links by list", found.groupBy("bucket").count().orderBy("bucket"))
        show("First of each list", stats.crawl_summary(found))
    elif args.command == "analyze":
        rows = analyze.analyze_pages(tables.pages(spark, args.pages), asked(args) or HeuristicProvider())
        sinks.course_csv(rows, args.output)
        done = tables.course_rows(spark, args.output)
        flags = {c: F.col(c).cast("boolean") for c in ("conflict_flag", "recheck_needed", "is_useful", "has_notes", "has_syllabus_or_logistics")}
        tried = tables.pages(spark, args.pages).select("url").join(done.withColumns(flags), "url", "left")
        show("Pages", stats.pipeline_summary(tried))
        show("Failed", stats.displayed(tried.where("manual_page_type is null"), "url", ["url"]))
    elif args.command == "resolve":
        rows = resolve.resolved(tables.course_rows(spark, args.input))
        sinks.cleaned_csv(rows.drop("idx"), args.output)
        show("First rows", stats.head(rows, ["idx"]))
    else:
        try:
            rows = tables.course_rows(spark, tables.first_existing(spark, args.input))
        except FileNotFoundError as problem:
            print(f"no input: {problem}")
            return 2
        limit = 3 if args.test else args.limit
        if args.dry_run:
            show("Groups", catalog.group_order(rows, limit).select("group_key", "group_type", "n_links").limit(1000))
            return 0
        result = catalog.generate(rows, tables.pages(spark, args.pages), provider=asked(args), limit=limit)
        sinks.documents(result["markdown"], f"{args.output}/md", "markdown", ".md")
        sinks.documents(catalog.index_json(result["index"]), f"{args.output}/index", "json", ".index.json")
        sinks.json_rows(stats.generation_summary(result["outcome"]), f"{args.output}/summary")
        show("Pages", stats.generation_summary(result["outcome"]).drop("failed_urls"))
        show("Failed", stats.displayed(result["outcome"].where("failed"), "url", ["url"]))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
