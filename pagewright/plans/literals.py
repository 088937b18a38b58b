"""Small fixed tables for operators that the driver's tables cannot exercise; the same rows for Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES: dict[str, tuple[str, list[tuple]]] = {
    "lit_urls": ("id int, base string, href string", [
        (i, "https://Www.Site.example.edu/Dept/cs/page.html?x=1#top", h) for i, h in enumerate([
            "", "#x", "JavaScript:void(0)", "mailto:a@b.c", "TEL:1", "ftp://h/f", "data:text/plain,x", "blob:x", "VOID(0)", "//h.example.org/p", "?q=2", "../up", "./here", "a/../b",
            "/root/./x/../y", "../../../over", "deep/..", "a.pdf", "A.PDF?v=1", "x.html", "x.php?download=1", "get?file=3", "/Attachment/7", "https://h.example.org/a/", "http://h.example.org/a/",
            "HTTP://H.example.org/B", "page#part", "lec.ppt", "notes.ipynb", "code.py", "img.PNG", "x.tar.gz", "s.css", "q?a=b/", "plain", "a//b", "http://h.example.org", "z.zip#f", "main.java", "doc.docx",
        ])
    ]),
    "lit_links": ("id int, url string, text string", [
        (0, "https://h/x", "Home"), (1, "https://domain.h/y", "Go"), (2, "https://h/feedback", "f"), (3, "https://h/index.html", ""), (4, "https://h/course/1", "Course notes"), (5, "https://h/teaching/", "people"),
        (6, "https://h/a", "CS101 Algorithms"), (7, "https://h/a", "math-202"), (8, "https://h/math", "spring class"), (9, "https://h/p?back=1", None), (10, "https://h/q", "← older"), (11, "https://h/q", "<- older"),
        (12, "https://h/r", "Index of things"), (13, "https://h/cs", "2024 plan"), (14, "https://h/syllabus", "pdf"), (15, "https://h/z", "A1234"), (16, "https://h/z", "phys_1010"), (17, "https://h/z", None), (18, "https://h/fall", "Fall Semester"), (19, "https://H/PARENT", "x"),
    ]),
    "lit_cls": ("id int, heuristic boolean, back boolean, course boolean, relevant boolean, confidence double", [
        (8 * i + 4 * b + 2 * c + r + 100 * h, bool(h), bool(b), bool(c), bool(r), conf) for h in (0, 1) for i, conf in enumerate((0.49, 0.5, 0.51)) for b in (0, 1) for c in (0, 1) for r in (0, 1)
    ]),
    "lit_json": ("id int, response string, n int", [
        (0, '[{"is_back_link": true, "is_course_page": false, "is_course_relevant": false, "confidence": 0.9, "reasoning": "nav"}]', 1), (1, 'Sure: [{"is_course_page": true}, {"confidence": 0.2}] done', 2),
        (2, '[{"is_course_page": true}]', 2), (3, "no array here", 3), (4, "[]", 0), (5, '[{"is_course_page": tru', 1), (6, "", 1),
    ]),
    "lit_single": ("id int, response string", [
        (0, '{"is_back_link": false, "is_course_page": true, "is_course_relevant": true, "confidence": 0.8, "reasoning": "code"}'), (1, 'Answer {"is_back_link": true, "is_course_relevant": false, "confidence": 0.6, "reasoning": "nav"} end'),
        (2, "This is a course page"), (3, "navigation only"), (4, "a Course that is relevant"), (5, "{broken"), (6, "{broken}"), (7, ""),
    ]),
    "lit_text": ("id int, text string, files int, syllabus boolean, topics boolean", [
        (0, "CS101 and CS 101 and MA20 CS101", 0, False, True), (1, "EE2001 then ME200 Autumn 2023", 0, False, True), (2, "Even  Semester 2021-22 of HS 12345", 0, False, True), (3, "nothing here", 0, False, False),
        (4, "A101 AB12 ABC123 AB12", 1, False, False), (5, "AB11 AB12 AB13 AB14 AB15 AB16", 3, True, True), (6, "Time and venue and room", 0, False, False), (7, "time venue room lecture", 0, False, False), (8, "time venue room unit", 0, False, False),
        (9, "fall term 2019", 2, True, False), (10, "CS 101 monsoon", 0, True, True), (11, "WINTER 2020-2021 CS202", 0, False, False), (12, "time time", 0, False, False), (13, "year 12020 and 20199 and 2021", 0, False, False), (14, "", 0, False, False),
    ]),
    "lit_years": ("id int, s string", list(enumerate([None, "", "2023-24", "2023/2024", "Autumn 07", "99", "12025", "2056", "2017.0", "31 and 30", "7", "in 1999", "05 and 98", "Spring 2019, Fall 2021", "abc"]))),
    "lit_rows": ("idx bigint, course_code string, course_title string, year string", [
        (0, "CS101", "Intro", "2019"), (1, "cs 101", "Intro to CS", "2021"), (2, None, "intro to cs", "2022"), (3, "CS999", "Intro to  CS", "2020"), (4, "MA1", None, None), (5, "ma 1 ", "Algebra (Autumn 2020)", "2020"),
        (6, None, "Algebra", "2020"), (7, None, None, "2021"), (8, None, None, None), (9, "PH1", "Waves_and &ndash; Light", ""), (10, "PH2", "waves-and - light", "x"), (11, "CH1", "Bonds (lab)", "2018"), (12, "CH1", "Bonds (lab)", "2018"), (13, "CH1", "Rings", "2018"), (14, "", "", ""),
    ]),
    "lit_anchor": ("id int, text string, url string", [
        (0, "Lecture 1", "https://h/a.pdf"), (1, "slides", "https://h/b.pdf"), (2, "deck", "https://h/c.pptx"), (3, "Midterm paper", "https://h/d.pdf"), (4, "exams", "https://h/e.pdf"), (5, "Tut3", "https://h/f.pdf"), (6, "HW", "https://h/homework_2.pdf"),
        (7, "sample", "https://h/g.zip"), (8, "x", "https://h/h.py"), (9, "x", "https://h/i.pdf"), (10, "lec2 tutorial", "https://h/j.pdf"), (11, "end-sem test", "https://h/k.doc"), (12, "pdf", "https://h/Lec-05_intro.pdf"), (13, "Lecture", "https://h/l.pdf?v=1"),
        (14, "Lecture 1", "https://h/a.pdf"), (15, "click here", "https://h/Assn2.final.pdf"), (16, "", "https://h/tut07.PDF"), (17, "Download", "https://h/"), (18, "lab code", "https://h/m.cpp"), (19, "previous", "https://h/n.c"),
    ]),
    "lit_groups": ("idx bigint, url string, course_code string, course_title string, semester string, year string", [
        (0, "https://h/0", "CS2", "Systems", "Autumn", "2019"), (1, "https://h/1", "CS2", "", "Autumn 2021", ""), (2, "https://h/2", " CS2 ", "Systems II", "", "2021"), (3, "https://h/3", "", "Logic", "Spring 2020", "2020"), (4, "https://h/4", "", "Logic", "", ""),
        (5, "https://h/5", "", "", "", "2018"), (6, "https://h/6", " ", " ", "", ""), (7, "https://h/7", "AB1", "", "", "2010"), (8, "https://h/8", None, None, None, None), (9, "https://h/9", "", "Art", None, "19"), (10, "https://h/10", "CS2", "Systems", "", "2021"),
    ]),
    "lit_verify": ("id int, answered boolean, is_course boolean, confidence double, n_links int", [
        (0, True, True, 0.9, 0), (1, True, True, 0.5, 0), (2, True, True, 0.5, 2), (3, True, False, 0.9, 3), (4, True, False, 0.9, 0), (5, False, None, None, None), (6, None, True, 1.0, 1), (7, True, None, None, 1), (8, True, True, None, None),
    ]),
    "lit_merge": ("id int, manual string, ai string, confidence string, useful boolean, notes boolean, syllabus boolean", [
        (0, "course_page_like", "course_page", "high", True, True, True), (1, "syllabus_like", "syllabus_pdf_link", "low", True, False, True), (2, "other", "course_page", "high", False, False, False), (3, "other", "other", "low", False, False, False),
        (4, "notes_subpage_like", "other", "medium", True, True, False), (5, "strange", "other", "high", False, False, True), (6, None, None, None, None, None, None),
    ]),
}


#: A small site: every tag that links, files, code, tables, a page that cannot be read and one that is empty.
_INDEX = (
    '<html><head><title>CS 101 Home</title><link rel="stylesheet" href="s.css"><link rel="alternate feed" type="application/rss" href="feed.xml"><link rel="icon" href="x.CSS?v=2">'
    '<base href="/ignored/"><base href="/second/"></head><body><h1>CS101 <b>Algorithms</b></h1><p>Autumn 2023, syllabus below.</p><table><tr><td>Unit 1: sorting</td></tr></table>'
    '<a href="notes/lec1.pdf">Lecture 1</a> <a href="notes/lec1.pdf">again</a> <a href="exam/mid.pdf?v=2">Midterm paper</a> <a href="hw/tut3.pdf">Tut3</a> <a href="cs102.html">CS 102</a> '
    '<a href="https://other.example.org/x">other</a> <a href="#top">Top</a> <a href="mailto:a@b">mail</a> <a href="cs102.html/">CS 102 again</a>'
    '<img src="logo.png" alt="Logo" title="The logo"><img src="logo.png" alt="dup"><img src="data:image/png;base64,AA" alt="d"><iframe src="frame.html" title="F" name="fr"></iframe>'
    '<map><area href="cs102.html" alt="seen"><area href="area.html" alt="A" title="T"></map><form action="search" name="q"><input></form><form action="post" method="post"></form>'
    '<video src="v.mp4" title="V"><source src="v.webm"></video><audio src="a.mp3"></audio><embed src="e.swf" type="app"><embed src="e2.swf" data="y" type="app2">'
    '<object src="o.bin" data="z" type="t"></object><pre>def solve(xs): return sorted(xs)  # a longer line of code, over fifty characters</pre><code>x</code></body></html>'
)
TABLES |= {
    "lit_html": ("page_id bigint, url string, html string", [
        (1, "https://site.example.edu/cs/index.html", _INDEX),
        (2, "https://site.example.edu/cs/cs102.html", "<title>CS102</title><h2>Data</h2><a href='index.html'>Home</a><a href='/course/cs103'>CS 103 notes</a><a href='/course/list'>course list</a><p>time, venue and room</p>"),
        (3, "https://site.example.edu/course/cs103", None),
        (4, "https://site.example.edu/course/list", "<a href='/course/cs104'>CS104</a><a href='/cs/index.html'>Back</a><a href='/course/more'>more courses</a><p>Spring 2020, exam 99</p>"),
        (5, "https://site.example.edu/empty", ""),
    ]),
    "lit_answers": ("id int, answer string", [
        (0, '{"a": 1}'), (1, '```json\n{"a": 2}\n```'), (2, 'Sure: {"a": {"b": 3}} and so on'), (3, '{"a": {"b": 4'), (4, '{"a": "x} y'), (5, '{"a": [1, 2'), (6, "nothing"), (7, "[1, 2]"), (8, '{"a": 5} or {"a": 6}'),
        (9, '{"a":{"b":{"c":{"d":{"e":7'), (10, '{"a":{"b":{"c":{"d":{"e":{"f":8'), (11, '{"a": "\\" {", "b": 9'), (12, ""),
    ]),
    "lit_keys": ("id int, name string, value string", [
        (0, "API_KEYS", " x, y,x ,,"), (0, "API_KEY", "z"), (1, "API_KEY", "a"), (1, "API_KEY_1", "b"), (1, "API_KEY_2", "a"), (1, "API_KEY_4", "c"), (2, "API_KEY_1", "d"), (2, "API_KEY_2", " "), (2, "API_KEY_3", "e"), (3, "API_KEYS", " , "), (3, "API_KEY", " f "),
    ]),
    "lit_chunks": ("page_id bigint, url string, html string", [
        (1, "https://h/1", "item:a item:b " + "x" * 7990 + " item:c item:a"), (2, "https://h/2", "y" * 8000 + "FAIL item:d"), (3, "https://h/3", "FAIL" + "z" * 7996 + "item:e"), (4, "https://h/4", None),
    ]),
    "lit_items": ("group_type string, group_key string, index int, pos int, item_type string, title string, description string, snippet string, file_url string", [
        ("course_code", "CS2", 1, 2, "tutorials", "click here", None, "two", "https://h/Tut02.pdf"), ("course_code", "CS2", 1, 1, "slides", "Lecture 1", "long\nline", "short", "https://h/lec1.pdf"), ("course_code", "CS2", 1, 3, "slides", "", "", "", ""),
        ("course_code", "CS2", 2, 1, "videos", "V", None, None, "https://h/v"), ("course_code", "CS2", 3, 1, None, "N", None, None, None), ("course_code", "CS2", 3, 2, "unknown", "", None, None, "https://h/"),
        ("course_title", "Logic", 1, 1, "example_code", "code", None, "s", None),
    ]),
    "lit_course_rows": ("url string, course_code string, course_title string, year string", [("https://h/1", "CS1", 'A, "b"', "2020"), ("https://h/2", None, None, "2017.0"), ("http://h/3", "MA1", "x\ny", None)]),
    # Expected values, worked out by hand from the rules.
    "exp_resource_links": ("page_id bigint, pos int, tag string, url string, text string, title string", [
        (1, k + 2, tag, u if ":" in u else "https://site.example.edu" + u, text, title) for k, (tag, u, text, title) in enumerate([
            ("link", "/cs/feed.xml", "alternate", "application/rss"), ("img", "/cs/logo.png", "Logo", "The logo"), ("img", "data:image/png;base64,AA", "d", ""), ("iframe", "/cs/frame.html", "F", "fr"),
            ("area", "/cs/area.html", "A", "T"), ("form", "/cs/search", "q", "GET"), ("form", "/cs/post", "", "post"), ("base", "/ignored/", "", ""), ("video", "/cs/v.mp4", "V", "video"),
            ("source", "/cs/v.webm", "", "source"), ("audio", "/cs/a.mp3", "", "audio"), ("embed", "/cs/e2.swf", "", "app2"), ("object", "/cs/o.bin", "", "t"),
        ])
    ]),
    "exp_anchor_links": ("page_id bigint, pos int, url string, text string", [
        (1, 4, "https://site.example.edu/cs/cs102.html", "CS 102"), (1, 5, "https://other.example.org/x", "other"), (2, 0, "https://site.example.edu/cs/index.html", "Home"),
        (2, 1, "https://site.example.edu/course/cs103", "CS 103 notes"), (2, 2, "https://site.example.edu/course/list", "course list"), (4, 0, "https://site.example.edu/course/cs104", "CS104"),
        (4, 1, "https://site.example.edu/cs/index.html", "Back"), (4, 2, "https://site.example.edu/course/more", "more courses"),
    ]),
    "exp_files": ("page_id bigint, pos int, href string, text string", [
        (1, 0, "https://site.example.edu/cs/notes/lec1.pdf", "Lecture 1"), (1, 2, "https://site.example.edu/cs/exam/mid.pdf?v=2", "Midterm paper"), (1, 3, "https://site.example.edu/cs/hw/tut3.pdf", "Tut3"),
    ]),
    "exp_blocks": ("page_id bigint, kind string, place int, text string", [
        (1, "block", 0, "Unit 1: sorting"), (1, "code", 0, "def solve(xs): return sorted(xs)  # a longer line of code, over fifty characters"), (1, "code", 1, "x"),
    ]),
    "exp_materials": ("page_id bigint, pos bigint, item_type string, title string, snippet string, file_url string, confidence string", [
        (1, 0, "slides", "Lecture 1", "Lecture 1", "https://site.example.edu/cs/notes/lec1.pdf", "medium"), (1, 3, "tutorials", "Tut3", "Tut3", "https://site.example.edu/cs/hw/tut3.pdf", "medium"),
        (1, 1048576, "example_code", "inline code snippet", "def solve(xs): return sorted(xs)  # a longer line of code, over fifty characters", None, "low"),
    ]),
    "exp_model_materials": ("page_id bigint, item_type string, title string", [(1, "slides", "a"), (1, "slides", "b"), (1, "slides", "c"), (3, "slides", "e")]),
    "exp_course_rows": (
        "url string, course_code string, course_title string, semester string, year string, manual_page_type string, ai_page_type string, ai_confidence string, has_notes boolean, notes_type string, "
        "is_useful boolean, conflict_flag boolean, recheck_needed boolean, n_files bigint, n_links bigint", [
            ("https://site.example.edu/cs/index.html", "CS102", "CS101 Algorithms", "Autumn", "2023", "course_page_like", "course_page", "high", True, "files_direct", True, False, False, 3, 5),
            ("https://site.example.edu/cs/cs102.html", "CS102", "Data", None, None, "logistics_only_like", "course_page", "high", False, "no_notes", True, True, True, 0, 3),
            ("https://site.example.edu/course/list", "CS104", None, "Spring", "2020", "other", "course_page", "high", False, "no_notes", True, True, True, 0, 3),
        ]),
    "exp_answers": ("id int, value string", [
        (0, '{"a": 1}'), (1, '{"a": 2}'), (2, '{"a": {"b": 3}}'), (3, '{"a": {"b": 4}}'), (4, None), (5, None), (6, None), (7, "[1, 2]"), (8, None), (9, '{"a": {"b": {"c": {"d": {"e": 7}}}}}'), (10, None),
        (11, '{"a": "\\" {", "b": 9}'), (12, None),
    ]),
    "exp_keys": ("id int, place int, key string", [(0, 0, "x"), (0, 1, "y"), (0, 2, "x"), (1, 0, "a"), (1, 1, "b"), (2, 0, "d"), (3, 0, "f")]),
    "exp_markdown": ("group_type string, group_key string, markdown string", [
        ("course_code", "CS2", '---\ntitle: "Systems II — CS2"\ncourse_code: "CS2"\ncourse_title: "Systems II"\n---\n\n# Systems II — CS2\n\n## Autumn 2021\n\n**Source:** [Course Page](https://h/1)\n\n'
         "### Lecture Slides\n\n#### [Lecture 1](https://h/lec1.pdf)\n> long line\n\n#### (untitled)\n\n### Tutorials & Assignments\n\n#### [Tutorial 02](https://h/Tut02.pdf)\n> two\n\n"
         "*Full course page: [https://h/1](https://h/1)*\n\n---\n\n## 2021\n\n**Source:** [Course Page](https://h/2)\n\n*Full course page: [https://h/2](https://h/2)*\n\n---\n\n"
         "## 2021\n\n**Source:** [Course Page](https://h/10)\n\n### [FILE] Other Materials\n\n#### []({})\n\n*Full course page: [https://h/10](https://h/10)*\n\n---\n\n"
         "## Autumn 2019\n\n**Source:** [Course Page](https://h/0)\n\n*No learning materials could be extracted from this page.*\n\n---\n".format("https://h/")),
        ("course_title", "Logic", '---\ntitle: "Logic"\ncourse_code: "Logic"\ncourse_title: "Logic"\n---\n\n# Logic\n\n## Spring 2020\n\n**Source:** [Course Page](https://h/3)\n\n### Example Code\n\n#### code\n> s\n\n'
         "*Full course page: [https://h/3](https://h/3)*\n\n---\n\n## Course Materials\n\n**Source:** [Course Page](https://h/4)\n\n*No learning materials could be extracted from this page.*\n\n---\n"),
    ]),
}


def frame(spark: SparkSession, name: str) -> DataFrame:
    schema, rows = TABLES[name]
    return spark.createDataFrame(rows, schema)


def _value(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def sql(name: str) -> str:
    """The table as a DuckDB subquery."""
    schema, rows = TABLES[name]
    columns = [c.split() for c in schema.split(", ")]
    types = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}
    casts = ", ".join(f"CAST({c} AS {types[t]}) AS {c}" for c, t in columns)
    values = ", ".join("(" + ", ".join(map(_value, row)) + ")" for row in rows)
    return f"(SELECT {casts} FROM (VALUES {values}) AS v({', '.join(c for c, _ in columns)}))"
