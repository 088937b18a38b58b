"""Queries that have to take every row of their tables, against brute force."""

import pyarrow.parquet as pq
from pagewright.functions import text as T
from pagewright.functions import url as U
from pagewright.operators import links
from pagewright.plans.literals import frame
from pagewright.plans.queries import QUERIES, pages
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.001"


def test_crawl_levels_takes_every_edge(spark):
    rows = pq.read_table(f"{DIR}/lineitem.parquet", columns=["l_suppkey", "l_partkey"])
    next_to: dict[str, set[str]] = {}
    for s, p in zip(*(c.to_pylist() for c in rows.columns), strict=True):
        next_to.setdefault(f"s{s}", set()).add(f"p{p}")
        next_to.setdefault(f"p{p}", set()).add(f"s{s}")
    want = {"s1": 0}
    for depth in (1, 2):
        for node in [n for n, d in want.items() if d == depth - 1]:
            for other in next_to.get(node, ()):
                want.setdefault(other, depth)
    got = QUERIES["crawl_levels"](spark, DIR).collect()
    assert {r.node: r.depth for r in got} == want and len(got) == len(want)


def test_crawl_pages_reads_every_page(spark):
    anchors = links.page_links(pages(spark, DIR)).where(U.same_domain(F.col("url"), U.netloc(F.col("source_url"))))
    want = {r.norm for r in anchors.select(U.page_norm(F.col("url")).alias("norm")).collect()}
    got = QUERIES["crawl_pages"](spark, DIR)
    assert want <= {r.norm for r in got.select(U.page_norm(F.col("url")).alias("norm")).collect()}


def test_markdown_has_every_file(spark):
    files = frame(spark, "lit_anchor").where(T.material_type(F.col("text"), F.col("url")).isNotNull())
    text = "".join(r.markdown for r in QUERIES["render_markdown"](spark, DIR).collect())
    assert [r.url for r in files.collect() if r.url not in text] == []
