"""Features of visible text and of course rows as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions import url as U

# Patterns that results depend on.
COURSE_CODE = r"\b([A-Z]{2,3}\s?\d{2,5})\b"
SEMESTER = r"(?i)\b(Autumn|Spring|Fall|Monsoon|Winter|Even\s+Semester|Odd\s+Semester)"
YEAR = r"\b(20\d{2}(?:-\d{2,4})?)\b"
SYLLABUS_WORDS = r"(?i)\b(unit|topic|syllabus|outline|module)\b"
LOGISTICS_WORDS = r"(?i)\b(time|venue|room|slot|instructor|timing|schedule)\b"
NOTES_WORDS = r"(?i)\b(lecture|lec\d*|week\d*|slide|tutorial|assignment)\b"
SLIDES = r"(?i)(?:^|[^a-zA-Z])(slide|lecture|lec\d*|ppt|presentation)(?:[^a-zA-Z]|$)"
PAPERS = r"(?i)(?:^|[^a-zA-Z])(question|exam|midterm|endsem|midsem|end[-_]?sem|mid[-_]?sem|test|paper|previous)(?:[^a-zA-Z]|$)"
TUTORIALS = r"(?i)(?:^|[^a-zA-Z])(tutorial|tut\d*|lab|exercise|assignment|homework)(?:[^a-zA-Z]|$)"
EXAMPLES = r"(?i)(?:^|[^a-zA-Z])(example|sample|demo|code|program)(?:[^a-zA-Z]|$)"
INLINE_CODE = r"\b(def |class |#include |import |package |function )"
GENERIC_TEXTS = ("click here", "download", "pdf", "here", "link", "file", "view", "open", "")
CODE_FILES = "py ipynb java c cpp zip".split()
ITEM_LABELS = {
    "slides": "Lecture Slides", "question_papers": "Question Papers", "tutorials": "Tutorials & Assignments", "example_code": "Example Code",
    "unknown": "[FILE] Other Materials",
}
ITEM_ORDER = ("slides", "question_papers", "tutorials", "example_code", "unknown")
MANUAL_TO_AI = {
    "course_page_like": "course_page", "syllabus_like": "syllabus_pdf_link", "notes_subpage_like": "notes_subpage",
    "curricula_list_like": "curricula_list", "logistics_only_like": "logistics_only", "other": "other",
}


def null_if_empty(value: Column) -> Column:
    return F.when(value != "", value)


def safe_text(value: Column) -> Column:
    """Null as empty, outer white space removed."""
    return F.trim(F.coalesce(value, F.lit("")))


def codes(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(COURSE_CODE), F.lit(1))


def course_code(text: Column) -> Column:
    """The most frequent code as it is spaced, the earliest of equals; then without spaces."""
    found = codes(text)
    distinct = F.array_distinct(found)
    # a code's rank: how often it is there, then how early
    ranked = F.transform(distinct, lambda c, i: F.struct(F.size(F.filter(found, lambda f: f == c)).alias("n"), (-i).alias("early"), c.alias("code")))
    return F.replace(F.array_max(ranked)["code"], F.lit(" "), F.lit(""))


def semester(text: Column) -> Column:
    """The first semester word; its year is never part of it."""
    return null_if_empty(F.trim(F.regexp_extract(text, SEMESTER, 1)))


def first_year(text: Column) -> Column:
    """X3."""
    return null_if_empty(F.regexp_extract(text, YEAR, 1))


def page_title(h1: Column, h2: Column, title: Column) -> Column:
    """H5: the first heading that is not empty, else the page's title."""
    squeeze = lambda c: null_if_empty(F.trim(F.regexp_replace(c, r"\s+", " ")))
    return F.coalesce(squeeze(h1), squeeze(h2), F.trim(F.regexp_replace(title, r"\s+", " ")))


def page_type(text: Column, code: Column, term: Column, year: Column, files: Column, blocks: Column) -> Column:
    """The decision list; ``files``: array of structs (href, text), ``blocks``: texts of tables and lists."""
    notes = F.size(F.filter(files, lambda f: f["text"].rlike(NOTES_WORDS) | f["href"].rlike(NOTES_WORDS)))
    syllabus = F.exists(files, lambda f: F.lower(f["href"]).contains("syllabus") | F.lower(f["text"]).contains("syllabus"))
    dated = null_if_empty(term).isNotNull() | null_if_empty(year).isNotNull()
    topics = F.exists(blocks, lambda b: b.rlike(SYLLABUS_WORDS))
    return (
        F.when(F.size(F.array_distinct(codes(text))) > 5, "curricula_list_like")
        .when(notes >= 2, "notes_subpage_like")
        .when(F.coalesce(syllabus, F.lit(False)), "syllabus_like")
        .when(null_if_empty(code).isNotNull() & dated & F.coalesce(topics, F.lit(False)), "course_page_like")
        .when((F.regexp_count(text, F.lit(LOGISTICS_WORDS)) >= 3) & ~text.rlike(NOTES_WORDS) & ~text.rlike(SYLLABUS_WORDS), "logistics_only_like")
        .otherwise("other")
    )


def year_int(value: Column, current_year: int) -> Column:
    """The largest 20xx, else the largest two-digit year about ``current_year``, else 0."""
    text = F.coalesce(value, F.lit(""))
    full = F.array_max(F.transform(F.regexp_extract_all(text, F.lit(r"(20\d{2})"), F.lit(1)), lambda y: y.cast("int")))
    short = F.transform(F.regexp_extract_all(text, F.lit(r"\b(\d{2})\b"), F.lit(1)), lambda y: y.cast("int"))
    near = F.array_max(F.transform(short, lambda v: F.when(v <= current_year % 100 + 5, v + 2000).otherwise(v + 1900)))
    return F.coalesce(full, near, F.lit(0)).cast("int")


def year_extract(value: Column) -> Column:
    """The first four digits, else 0."""
    return F.coalesce(null_if_empty(F.regexp_extract(F.coalesce(value, F.lit("")), r"(\d{4})", 1)).cast("int"), F.lit(0))


def norm_code(code: Column) -> Column:
    """X9."""
    return null_if_empty(F.replace(F.upper(F.trim(code)), F.lit(" "), F.lit("")))


def norm_title(title: Column) -> Column:
    """Without bracketed years and seasons, dashes alike, white space single."""
    value = F.regexp_replace(F.lower(F.trim(title)), "&ndash;|–|_", "-")
    value = F.regexp_replace(value, r"(?i)\s*\([^)]*(?:20\d{2}|autumn|spring|summer|winter)[^)]*\)", "")
    return null_if_empty(F.trim(F.regexp_replace(value, r"\s+", " ")))


def material_type(text: Column, href: Column) -> Column:
    """X11: a material file's kind by its text and url; null if none fits (such files are dropped)."""
    both = F.concat(F.lower(F.coalesce(text, F.lit(""))), F.lit(" "), F.lower(href))
    low = F.lower(href)
    return (
        F.when(both.rlike(SLIDES) | U.ends_with_any(low, ["ppt", "pptx"]), "slides")
        .when(both.rlike(PAPERS), "question_papers")
        .when(both.rlike(TUTORIALS), "tutorials")
        .when(both.rlike(EXAMPLES) | U.ends_with_any(low, CODE_FILES), "example_code")
    )


def is_inline_code(text: Column) -> Column:
    return (F.length(text) > 50) & (F.length(text) < 5000) & text.rlike(INLINE_CODE)


def is_generic(text: Column) -> Column:
    """X12."""
    return F.trim(F.lower(text)).isin(*GENERIC_TEXTS)


def friendly_title(url: Column) -> Column:
    """A file's name as a title. Capitals as in Python's ``str.title``: after anything that is no letter."""
    base = U.basename(url)
    stem = F.regexp_replace(base, r"(?<=[^.])\.[^.]*\z", "")
    name = F.trim(F.regexp_replace(stem, "[-_]+", " "))
    name = F.regexp_replace(name, r"(?i)\bLec(\d+)\b", "Lecture $1")
    name = F.regexp_replace(name, r"(?i)\bAss?n?(\d+)\b", "Assignment $1")
    name = F.regexp_replace(name, r"(?i)\bTut(\d+)\b", "Tutorial $1")
    letters = F.split(F.lower(name), "")
    titled = F.array_join(
        F.transform(letters, lambda c, i: F.when((i == 0) | ~F.coalesce(F.get(letters, i - 1), F.lit(" ")).rlike(r"\p{L}"), F.upper(c)).otherwise(c)), ""
    )
    return F.when(name == "", base).otherwise(titled)


def display_title(title: Column, file_url: Column) -> Column:
    """X13."""
    own = F.coalesce(title, F.lit(""))
    other = F.when(F.coalesce(file_url, F.lit("")) != "", friendly_title(file_url)).otherwise("(untitled)")
    return F.when((own != "") & ~is_generic(own), own).otherwise(other)


def description(long: Column, snippet: Column) -> Column:
    """X14."""
    value = F.coalesce(null_if_empty(long), null_if_empty(snippet), F.lit(""))
    return F.substring(F.trim(F.replace(value, F.lit("\n"), F.lit(" "))), 1, 200)


def semester_label(term: Column, year: Column) -> Column:
    """X15."""
    t, y = F.coalesce(term, F.lit("")), F.coalesce(year, F.lit(""))
    label = F.concat_ws(" ", null_if_empty(t), F.when((y != "") & ~t.contains(y), y))
    return F.when(label == "", "Course Materials").otherwise(label)


def item_label(kind: Column) -> Column:
    """J10."""
    table = F.create_map(*[F.lit(x) for pair in ITEM_LABELS.items() for x in pair])
    return F.element_at(table, kind)


def ai_type(manual: Column) -> Column:
    """A manual page type as the model would call it."""
    table = F.create_map(*[F.lit(x) for pair in MANUAL_TO_AI.items() for x in pair])
    return F.coalesce(F.element_at(table, manual), F.lit("other"))


def visible_native(html: Column) -> Column:
    """H2 without Python, for regular html: comments, scripts and styles dropped, tags as borders, references decoded."""
    text = F.regexp_replace(html, r"(?is)<!--.*?-->|<!doctype[^>]*>|<(script|style)\b.*?</\1\s*>", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    for name, value in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(value))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def readable(text: Column, most: int) -> Column:
    """H3's end: at most ``most`` characters, and three dots if something was cut."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def chunks(html: Column, most: int) -> Column:
    """Windows of ``most`` characters; an empty page is one empty window."""
    text = F.coalesce(html, F.lit(""))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(
        F.transform(F.sequence(F.lit(0), F.floor((F.length(text) - 1) / most).cast("int")), lambda i: F.substring(text, i * most + 1, F.lit(most)))
    )
