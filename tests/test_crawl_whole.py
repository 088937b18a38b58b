"""A crawl keeps every link that it meets."""

import json

from pagewright.config import Settings
from pagewright.operators import crawl
from pagewright.providers import HeuristicProvider
from test_operators import CACHE

HTML = '<a href="/teaching/a">Teaching</a><a href="https://o/x">Other</a><img src="/i/p.png" alt="P"><iframe src="/teaching/frame"></iframe><map><area href="/notes.pdf" alt="N"></map>'


def crawled(spark, rows, **more):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    seeds = spark.createDataFrame([("https://h/",)], "url string")
    return crawl.crawl(pages, seeds, spark.createDataFrame([], CACHE), HeuristicProvider(), Settings(max_depth=2), **more)


def test_external_and_file_links_are_kept(spark):
    result = crawled(spark, [(1, "https://h/", HTML), (2, "https://h/teaching/a", '<img src="/i/p.png"><img src="/i/q.png"><a href="https://o/x">again</a>')])
    assert [r.url for r in result["external"].collect()] == ["https://o/x"]
    assert {(r.url, r.parent_folder, r.parent_depth) for r in result["files"].collect()} == {
        ("https://h/i/p.png", "https://h/", 0), ("https://h/notes.pdf", "https://h/", 0), ("https://h/i/q.png", "https://h/teaching/a", 1),
    }
    every = {"https://h/teaching/a", "https://o/x", "https://h/i/p.png", "https://h/i/q.png", "https://h/teaching/frame", "https://h/notes.pdf"}
    assert sorted(r.url for r in result["all_extracted"].collect()) == sorted(every)
    assert "https://h/teaching/frame" in {r.url for r in result["links"].collect()}  # other tags are judged, too
    found = json.loads(crawl.result_json(result, "https://h/").first().json)
    assert {r["url"] for r in found["all_extracted_links"]} == every and [r["url"] for r in found["external_links"]] == ["https://o/x"]
    assert len(found["file_links"]) == 3 and [r["url"] for r in found["inaccessible_links"]] == ["https://h/teaching/frame"]
    assert found["stats"] == {
        "total_visited": 3, "total_links_extracted": 6, "external_links": 1, "same_domain_links": 5, "course_pages": 0, "course_relevant": 2, "back_links": 0,
        "irrelevant": 0, "file_links": 3, "inaccessible": 1,
    }
    assert {r.bucket for r in crawl.buckets(result).collect()} == {"all_extracted", "external", "file", "inaccessible", "course_relevant"}


def test_links_of_verified_pages_are_added(spark):
    gate = '<p>no code here</p><a href="/c/2">CS202 Systems</a><a href="/teaching/z">more</a><a href="/c/1">CS101 itself</a><a href="/people">P</a>'
    rows = [(1, "https://h/", '<a href="/c/1">CS101 Intro</a>'), (2, "https://h/c/1", gate), (3, "https://h/c/2", "<h1>CS202</h1>")]
    plain = {(r.url, r.bucket) for r in crawled(spark, rows)["links"].collect()}
    assert plain == {("https://h/c/1", "course_page")}
    found = crawled(spark, rows, verify=True)["links"].collect()
    assert sorted((r.url, r.bucket, r.depth) for r in found) == [
        ("https://h/c/1", "course_relevant", 0), ("https://h/c/2", "course_page", 1), ("https://h/teaching/z", "course_relevant", 1),
    ]
