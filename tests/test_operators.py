import random

import pytest
from pagewright import scratch
from pagewright.config import DEFAULT, Settings
from pagewright.operators import analyze, cache, catalog, crawl, dedup, resolve, stats
from pagewright.operators.components import connected_components
from pagewright.operators.ranking import numbered
from pagewright.plans.literals import frame
from pagewright.providers import HeuristicProvider, KeyRing, RetryingProvider, ai_fields, parse_json_ladder, render
from pagewright.sources import sinks, tables
from pyspark.sql import functions as F

CACHE = "cache_key string, is_back_link boolean, is_course_page boolean, is_course_relevant boolean, confidence double, reasoning string"


def closure(nodes, edges):
    label = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("seed", [0, 1])
def test_components_of_random_graphs_and_chains(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(20)] + [(200, 200 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    want = closure({n for e in edges for n in e}, edges)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: want[n] for n in linked}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([(1, 1), (None, 2)], "src long, dst long")).count() == 0


def test_first_wins_does_not_depend_on_partitions(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.lit(1000) - F.col("id")).alias("o"), F.col("id").alias("v"))
    got = {tuple(sorted(map(tuple, dedup.first_wins(rows.repartition(n), ["k"], ["o"]).collect()))) for n in (1, 3, 8)}
    assert len(got) == 1 and all(v >= 993 for _, _, v in got.pop())
    by_page = dedup.first_in_page(rows.withColumn("page_id", F.col("v") % 2), ["k"], ["o"])
    assert by_page.columns == ["k", "o", "v", "page_id"] and by_page.count() == 14


def test_numbering_is_global(spark):
    rows = spark.range(0, 500, 1, 7).select(((F.col("id") * 37) % 1009).alias("k"))
    got = sorted((r.k, r.place) for r in numbered(rows, ["k"], "place").collect())
    assert [p for _, p in got] == list(range(1, 501)) and numbered(rows.limit(0), ["k"]).count() == 0


def test_cache_and_provider(spark):
    links = spark.createDataFrame([(1, i, f"https://h/{'course' if i % 2 else 'x'}/{i}", f"CS10{i} notes" if i == 3 else "text") for i in range(10)] + [(1, 10, "https://H/x/0", "dup"), (1, 11, "https://h/home", "Home")], "page_id long, pos int, url string, text string")
    known = spark.createDataFrame([("https://h/x/2", False, True, True, 0.9, "known")], CACHE)
    rows, counts = cache.filter_links(links, known, HeuristicProvider())
    by_url = {r.url: (r.bucket, r.method) for r in rows.collect()}
    assert by_url["https://h/x/2"] == ("course_page", "model") and by_url["https://h/home"] == ("back_link", "heuristic") and by_url["https://h/course/3"][0] == "course_page"
    assert by_url["https://h/course/5"][0] == "course_relevant" and by_url["https://h/x/4"][0] == "irrelevant" and len(by_url) == 11
    total = counts.first()
    assert (total.total, total.duplicates_removed, total.back_link, total.course_page) == (12, 1, 1, 2)

    class Failing(HeuristicProvider):
        def classify_batch(self, links):
            raise OSError("down")

    failed = cache.ask(links.where("pos < 3"), Failing())
    assert all(r.error and r.confidence == 0 and not r.is_course_page for r in failed.collect())
    fresh = failed.select(F.col("url").alias("cache_key"), F.lit(1).alias("version"), "confidence", "error")
    assert cache.upsert(spark.createDataFrame([("k", 0, 0.5)], "cache_key string, version int, confidence double"), fresh).count() == 1
    asked = cache.find_course_pages(links, HeuristicProvider())
    assert {r.bucket for r in asked.collect()} == {"back_link", "course_page", "irrelevant"} and asked.count() == 12


def test_levels_are_least_depths(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "a"), ("x", "y")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "node string")
    assert {r.node: r.depth for r in crawl.levels(edges, seeds, 5).collect()} == {"a": 0, "b": 1, "c": 1, "d": 2}
    assert crawl.levels(edges, seeds, 0).count() == 1


def site(spark):
    pages = [
        (1, "https://h/", '<a href="/teaching/a">Teaching</a><a href="/people">P</a><a href="/home">Home</a><a href="https://o/x">Other</a>'),
        (2, "https://h/teaching/a", '<h1>List</h1><a href="/c/1">CS101 Intro</a><a href="/teaching/b">Teaching more</a><a href="/">back</a>'),
        (3, "https://h/teaching/b", '<a href="/c/1">CS101 again</a><a href="/gone/teaching">teaching gone</a>'), (4, "https://h/c/1", "<h1>CS101 Intro</h1><a href='/teaching/d'>more teaching</a>"),
    ]
    return spark.createDataFrame(pages, "page_id long, url string, html string")


def test_crawl_follows_relevant_links_only(spark):
    seeds = spark.createDataFrame([("https://h/",)], "url string")
    result = crawl.crawl(site(spark), seeds, spark.createDataFrame([], CACHE), HeuristicProvider(), Settings(max_depth=3))
    assert {(r.url, r.bucket, r.depth) for r in result["links"].collect()} == {
        ("https://h/teaching/a", "course_relevant", 0), ("https://h/people", "irrelevant", 0), ("https://h/home", "back_link", 0), ("https://h/c/1", "course_page", 1),
        ("https://h/teaching/b", "course_relevant", 1), ("https://h/", "back_link", 1), ("https://h/gone/teaching", "course_relevant", 2),
    }
    assert {r.url for r in result["visited"].collect()} == {"https://h/", "https://h/teaching/a", "https://h/teaching/b", "https://h/gone/teaching"}
    assert [r.url for r in result["inaccessible"].collect()] == ["https://h/gone/teaching"]
    assert '"base_url":"https://h/"' in crawl.result_json(result, "https://h/").first().json
    checked = crawl.verified(result["links"].where("bucket = 'course_page'"), site(spark), HeuristicProvider())
    assert [(r.url, r.action) for r in checked.collect()] == [("https://h/c/1", "course_page")]
    assert crawl.expanded(checked, site(spark), spark.createDataFrame([], CACHE), HeuristicProvider()).count() == 0


def test_analysis_merges_the_models_fields(spark):
    html = '<title>x</title><h1>Intro to CS</h1><p>CS101 CS101 MA1 Autumn 2023</p><ul><li>Unit 1</li></ul><a href="w1.pdf">Week1</a><a href="w1.pdf">again</a><a href="/n#f">n</a>'
    pages = spark.createDataFrame([(1, "https://h/c/", html), (2, "https://h/e", ""), (3, "https://h/f", None)], "page_id long, url string, html string")
    row = analyze.analyze_pages(pages, HeuristicProvider()).collect()
    assert len(row) == 1 and (row[0].course_code, row[0].year, row[0].semester, row[0].manual_page_type, row[0].conflict_flag) == ("CS101", "2023", "Autumn", "course_page_like", False)
    assert row[0].all_files_json == '[{"href":"https://h/c/w1.pdf","text":"Week1"}]' and '"https://h/n#f"' in row[0].all_internal_links_json

    class Broken(HeuristicProvider):
        def enrich(self, page):
            return "no json"

    row = analyze.analyze_pages(pages, Broken()).first()
    assert (row.ai_page_type, row.course_code, row.recheck_needed, row.conflict_flag) == ("other", None, True, True)


def test_resolution_keeps_every_row(spark):
    rows = frame(spark, "lit_rows")
    assert resolve.resolved(rows).count() == rows.count()


def test_rendering(spark):
    rows = spark.createDataFrame([(0, "https://h/0", "CS2", "Systems", "Autumn", "2019"), (1, "https://h/1", "CS2", "", "", "2021")], "idx bigint, url string, course_code string, course_title string, semester string, year string")
    html = '<a href="lec1.pdf">Lecture 1</a><a href="lec1.pdf">Lecture 1</a><a href="Tut02.pdf">click here</a><pre>' + "x = 1\n" * 10 + "def f(): pass</pre>"
    pages = spark.createDataFrame([(5, "https://h/0", html)], "page_id long, url string, html string")
    out = catalog.generate(rows, pages)
    assert out["markdown"].first().markdown == (
        '---\ntitle: "Systems — CS2"\ncourse_code: "CS2"\ncourse_title: "Systems"\n---\n\n# Systems — CS2\n\n## 2021\n\n**Source:** [Course Page](https://h/1)\n\n'
        "*No learning materials could be extracted from this page.*\n\n---\n\n## Autumn 2019\n\n**Source:** [Course Page](https://h/0)\n\n### Lecture Slides\n\n#### [Lecture 1](https://h/lec1.pdf)\n> Lecture 1\n\n"
        "### Tutorials & Assignments\n\n#### [Tutorial 02](https://h/Tut02.pdf)\n> click here\n\n### Example Code\n\n#### inline code snippet\n> "
        + ("x = 1 " * 10 + "def f(): pass") + "\n\n*Full course page: [https://h/0](https://h/0)*\n\n---\n"
    )
    assert stats.generation_summary(out["outcome"]).first().asDict() == {"processed_count": 2, "failed_count": 1, "items": 3, "failed_urls": ["https://h/1"]}
    assert '"index":1,"url":"https://h/1"' in catalog.index_json(out["index"]).first().json
    assert catalog.materials_by_model(pages, HeuristicProvider()).count() == 0


def test_pages_of_one_url_are_one_source(spark):
    rows = spark.createDataFrame([(0, "https://h/0", "CS2", "Systems", "", ""), (1, "https://h/1", "CS2", "", "", "2021")], "idx bigint, url string, course_code string, course_title string, semester string, year string")
    html = ('<p>2019</p><a href="lec1.pdf">Lecture 1</a>', '<p>2023</p><a href="lec1.pdf">Lecture 1 again</a><a href="lec2.pdf">Lecture 2</a>')
    pages = spark.createDataFrame([(5, "https://h/0", html[0]), (6, "https://h/0", html[1]), (7, "https://h/1", "")], "page_id long, url string, html string")
    out = catalog.generate(rows, pages)
    assert sorted((r["index"], r.url) for r in out["index"].collect()) == [(1, "https://h/0"), (2, "https://h/1")]
    assert sorted((r.file_url, r.title) for r in out["items"].collect()) == [("https://h/lec1.pdf", "Lecture 1"), ("https://h/lec2.pdf", "Lecture 2")]
    text = out["markdown"].first().markdown
    assert text.count("**Source:**") == 2 and text.count("lec1.pdf") == text.count("lec2.pdf") == 1
    assert sorted((r.url, r.extracted_count) for r in out["outcome"].collect()) == [("https://h/0", 2), ("https://h/1", 0)]

    class Reader(HeuristicProvider):
        def materials(self, chunk):
            return '{"extracted_items": [{"item_type": "slides", "title": "L", "file_url": "https://h/lec1.pdf"}]}'

    assert catalog.generate(rows, pages, provider=Reader())["items"].where("url = 'https://h/0'").count() == 1


def test_files(spark, tmp_path):
    (tmp_path / "rows.csv").write_text('Link,Code,Title,Year\nhttps://h/1,CS1,"A, ""b""",2020\nhttps://h/2,,,\n')
    rows = tables.course_rows(spark, str(tmp_path / "rows.csv"))
    assert [(r.url, r.course_code, r.course_title) for r in rows.collect()] == [("https://h/1", "CS1", 'A, "b"'), ("https://h/2", "", "")]
    assert tables.first_existing(spark, [str(tmp_path / "none"), str(tmp_path / "rows.csv")]).endswith("rows.csv")
    with pytest.raises(FileNotFoundError):
        tables.first_existing(spark, [str(tmp_path / "none")])
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="url"):
        tables.course_rows(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "cache.json").write_text('{"k1": {"is_course_page": true, "confidence": 0.9}, "k2": {}}')
    assert {r.cache_key: r.is_course_page for r in tables.cache(spark, str(tmp_path / "cache.json")).collect()} == {"k1": True, "k2": None}
    assert tables.cache(spark, str(tmp_path / "no.json")).count() == 0
    (tmp_path / "broken.json").write_text('{"k1": {"is_course')
    assert tables.cache(spark, str(tmp_path / "broken.json")).count() == 0
    (tmp_path / "crawl.json").write_text('{"course_pages": [{"url": "https://h/1"}, {"url": "https://h/2"}]}')
    assert tables.crawl_course_pages(spark, str(tmp_path / "crawl.json")).count() == 2
    docs = spark.createDataFrame([("a", "x\ny"), ("b", "z")], "file string, markdown string")
    sinks.documents(docs, str(tmp_path / "out"), "markdown", ".md")
    assert next((tmp_path / "out" / "file=a.md").glob("part-*")).read_text() == "x\ny\n"
    assert tables.template(None, "d") == "d"


def test_fetching_with_retries(spark):
    def fetch(url):
        if "bad" in url:
            raise OSError("refused")
        return "<p>x</p>"

    urls = spark.createDataFrame([("https://h/ok",), ("https://h/bad",)], "url string")
    rows = tables.fetched(urls, fetch, retries=1, wait_s=0.0)
    assert {r.url: (r.html, r.error) for r in rows.collect()} == {"https://h/ok": ("<p>x</p>", None), "https://h/bad": (None, "refused")}
    found = crawl.crawl(rows.withColumn("page_id", F.lit(1).cast("long")), urls, spark.createDataFrame([], CACHE), HeuristicProvider(), Settings(max_depth=1))
    assert [(r.url, r.error) for r in found["inaccessible"].collect()] == [("https://h/bad", "refused")]


def test_keys_and_retries():
    ring = KeyRing.from_settings({"API_KEY": "a", "API_KEY_1": "b", "API_KEY_2": "c", "API_KEY_4": "x"})
    assert [ring.next() for _ in range(4)] == ["b", "c", "a", "b"]
    ring.report("b", False)
    ring.report("b", False)
    ring.report("c", True)
    assert ring.stats()["total_errors"] == 2 and ring.stats()["error_rate"] == 0.5 and ring.has_multiple() and ring.remove("a") and not ring.remove("zz")
    assert KeyRing.from_settings({"API_KEYS": "x, y,x", "API_KEY": "z"}).keys == ["x", "y", "x"]  # a list stands as it is
    waits = []

    class Slow:
        def classify(self, link):
            raise TimeoutError

    with pytest.raises(TimeoutError):
        RetryingProvider(Slow(), DEFAULT, sleep=waits.append).call("classify", {})
    assert waits == [5.0, 10.0, 15.0]


def test_json_ladder_and_settings():
    assert parse_json_ladder('```json\n{"a": 1}\n```') == parse_json_ladder('x {"a": 1} y') == parse_json_ladder('{"a": 1') == {"a": 1}
    with pytest.raises(ValueError):
        parse_json_ladder("none")
    assert ai_fields("none")["ai_confidence"] == "low" and ai_fields('{"page_type": "course_page", "course_code": ""}')["course_code"] is None
    assert render("a {{x}} {{y}}", {"x": "1"}) == "a 1 {{y}}"
    with pytest.raises(ValueError):
        Settings(batch_size=0)


def test_streaming_pages(spark, tmp_path):
    from pagewright.streaming import pages as S

    site(spark).repartition(2).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        S.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch.path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
