from pagewright.functions import html as H
from pagewright.operators import links as L

PAGE = """<html><head><title> T  one </title><base href="/base/"><link rel="stylesheet" href="s.css"><link rel="icon" type="image/x" href="i.ico"><style>p{}</style></head><body>
<h1></h1><h2>Head <b>two</b></h2><div><p>before</p><div id="x"><a href="/a#f">A <b>b</b></a> &amp; text</div><img src="data:x" alt="pic"><img src="/i.png" title="t"></div>
<script>var t="</p><a href='/no'>";</script><!-- <a href="/no2">x</a> --><table><tr><td>Unit 1</td></tr></table><pre>def f(): pass</pre><form action="/go" name="n"></form><form method="post" action="/p"></form>
<video src="/v.mp4"></video><embed src="/e1"><embed src="/e2" data="d"><area href="/area" alt="al"><iframe src="/fr" title="ft" name="fn"></iframe><a>none</a><a href="  ">blank</a><a href="https://h/a/">again</a><a href="/i.png">file</a></body>"""


def test_features_of_a_page():
    p = H.parse(PAGE)
    assert (p["h1"], p["h2"], p["title"], p["base"]) == ("", "Head two", "T  one", "/base/")
    assert [(a["href"], a["text"], a["text_spaced"]) for a in p["anchors"]] == [("/a#f", "Ab", "A b"), ("", "blank", "blank"), ("https://h/a/", "again", "again"), ("/i.png", "file", "file")]
    context = p["anchors"][0]["html_context"]
    assert context["parent_block"] == '<div id="x"><a href="/a#f">A <b>b</b></a> &amp; text</div>' and context["previous_block"] == "<p>before</p>"
    assert (context["parent_text"], context["heading_above"]) == ("Ab& text", "Headtwo")
    assert [(r["tag"], r["href"], r["text"], r["title"]) for r in sorted(p["resources"], key=lambda r: (r["tag_order"], r["pos"]))] == [
        ("link", "i.ico", "icon", "image/x"), ("img", "data:x", "pic", ""), ("img", "/i.png", "", "t"), ("iframe", "/fr", "ft", "fn"), ("area", "/area", "al", ""), ("form", "/go", "n", "GET"),
        ("form", "/p", "", "post"), ("base", "/base/", "", ""), ("video", "/v.mp4", "", "video"), ("embed", "/e2", "", ""),
    ]
    assert p["blocks"] == ["Unit 1"] and p["code"] == ["def f(): pass"]
    assert "var t" not in p["visible"] and "T  one Head two before A b & text" in p["visible"]


def test_readable_leaves_out_page_furniture():
    assert H.parse("<nav>n</nav><header>h</header><p>a  b\n c</p><footer>f</footer><script>s</script>")["readable"] == "a b c"


def test_odd_html():
    for html in (None, "", "<", "</p></div>", "<p><b>x<p>y", "<a href=x", "plain & text", "<![CDATA[x]]>"):
        H.parse(html)
    assert H.parse("<p>x</b></p>y")["visible"] == "x y"


def test_references_without_a_semicolon_stay():
    p = H.parse("<h1>a&amp</h1><p>&amp;amp &#38;&#38 &notit;&am & &copy 2024 &copy; &lt;</p><script>a&&b&amp</script><a href='/x?a=1&b=2&amp;c=&amp'>t&quot</a>")
    assert (p["h1"], p["visible"]) == ("a&amp", "a&amp &amp &&#38 &notit;&am & &copy 2024 © < t&quot")
    assert [a["href"] for a in p["anchors"]] == ["/x?a=1&b=2&c=&"]


def test_links_of_a_page(spark):
    pages = spark.createDataFrame([(1, "http://h/d/p.html", PAGE), (2, "https://h/", None)], "page_id long, url string, html string")
    rows = L.page_links(pages).orderBy("pos").collect()
    assert [(r.url, r.text, r.tag) for r in rows] == [("http://h/a", "Ab", "a")]
    resources = L.resource_links(pages).orderBy("pos").collect()
    assert [r.url for r in resources] == ["http://h/d/i.ico", "data:x", "http://h/i.png", "http://h/fr", "http://h/area", "http://h/go", "http://h/p", "http://h/base/", "http://h/v.mp4", "http://h/e2"]
    assert L.internal_links(pages).count() == 3


def test_native_anchors_agree(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    columns = ["page_id", "pos", "url", "text"]
    assert sorted(map(tuple, L.page_links(pages).select(*columns).collect())) == sorted(map(tuple, L.page_links_native(pages).select(*columns).collect()))
