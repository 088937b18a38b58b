from urllib.parse import urljoin, urlparse

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pagewright.functions import url as U
from pyspark.sql import functions as F

BASE = "https://h.example.org/a/b/c.html?x=1#f"


def values(spark, urls, *columns):
    rows = spark.createDataFrame(list(enumerate(urls)), "i int, u string").select("i", *columns).orderBy("i").collect()
    return [r[1] if len(columns) == 1 else tuple(r[1:]) for r in rows]


def test_four_identities(spark):
    u = F.col("u")
    got = values(spark, ["HTTP://Host.X/Path//?Q=1#f", "https://h/a/?b=c/", "https://h"], U.page_norm(u), U.anchor_key(u), U.cache_key(u), U.https(u))
    assert got == [
        ("http://host.x/Path?Q=1", "https://Host.X/Path//?Q=1", "http://host.x/path//?q=1", "HTTP://Host.X/Path//?Q=1#f"),
        ("https://h/a?b=c/", "https://h/a/?b=c", "https://h/a/?b=c/", "https://h/a/?b=c/"),
        ("https://h/", "https://h", "https://h", "https://h"),
    ]


def test_norms_are_idempotent(spark):
    urls = ["HTTP://A.b/C/?q#z", "https://h//", "http://h/a/?b=/", "https://h/p;x=1?y"]
    u = F.col("u")
    for norm in (U.page_norm, U.anchor_key, U.cache_key, U.https):
        once = values(spark, urls, norm(u))
        assert values(spark, once, norm(u)) == once


def test_join_as_the_standard_library(spark):
    hrefs = ["", "x", "/x/y", "//o/p", "?q", "#z", "../x", "./x", "../../../x", "a/./b/../c", "..", ".", "a/..", "/a/../b", "http://o", "mailto:a", "x?y=../z", "x#../z", "a//b", "/..", "/a/.."]
    assert values(spark, hrefs, U.join(F.lit(BASE), F.col("u"))) == [urljoin(BASE, h) for h in hrefs]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b.c", "..", ".", "x-y"]), min_size=1, max_size=5), min_size=5, max_size=20), st.sampled_from(["", "/"]), st.sampled_from(["", "?k=v", "#f"]))
def test_join_property(spark, paths, lead, tail):
    hrefs = [lead + "/".join(p) + tail for p in paths]
    assert values(spark, hrefs, U.join(F.lit(BASE), F.col("u"))) == [urljoin(BASE, h) for h in hrefs]


def test_parts_as_the_standard_library(spark):
    urls = ["https://u:p@h:80/a/b?c=d#e", "HTTP://H", "/p/q?r", "mailto:x@y", "https://h?x#y", "https://h/a?b?c#d#e"]
    got = values(spark, urls, U.scheme(F.col("u")), U.netloc(F.col("u")), U.path(F.col("u")), U.query(F.col("u")), U.fragment(F.col("u")))
    assert got == [(p.scheme, p.netloc, p.path, p.query, p.fragment) for p in map(urlparse, urls)]


def test_file_rules(spark):
    urls = ["https://h/a.PDF", "https://h/a.html?download=1", "https://h/a?file=1", "https://h/a", "https://h/a.pdf?v=1", "https://h/a.pdfx"]
    assert values(spark, urls, U.is_file(F.col("u"))) == [True, False, True, False, True, False]
    assert values(spark, urls, U.is_material_file(F.col("u"))) == [True, False, False, False, False, False]


def test_safe_filename(spark):
    assert values(spark, ["a b/c", "x" * 200], U.safe_filename(F.col("u"))) == ["a_b_c", "x" * 120]
