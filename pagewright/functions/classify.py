"""Link classification and model answers as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions.url import contains_any
from pagewright.schemas import CLASSIFICATION

# Words of urls and texts that mark links back and links to courses.
BACK_URL = ("home", "back", "return", "previous", "parent", "index.html", "index.php", "../", "main", "?back", "&back")
BACK_TEXT = ("back", "home", "return", "go back", "<-", "←", "previous page", "main page", "index")
COURSE_URL = (
    "/course/", "/courses/", "/teaching/", "/class/", "syllabus", "curriculum", "lecture", "assignment", "fall", "spring", "summer", "winter",
    "/cs", "/math", "/phys", "/chem", "/bio",
)
COURSE_TEXT = ("course", "class", "lecture", "syllabus", "fall", "spring", "semester", "2024", "2023", "2025")
INDICATOR_CODE = r"(?i)\b[A-Z]{2,4}[-_\s]?\d{3,4}\b"
THRESHOLD = 0.5


def is_back_link(url: Column, text: Column) -> Column:
    """plain substrings, wherever they stand."""
    return contains_any(F.lower(url), BACK_URL) | contains_any(F.lower(F.coalesce(text, F.lit(""))), BACK_TEXT)


def has_course_indicators(url: Column, text: Column) -> Column:
    """a course code in the text, or words of both lists."""
    words = F.coalesce(text, F.lit(""))
    return words.rlike(INDICATOR_CODE) | (contains_any(F.lower(url), COURSE_URL) & contains_any(F.lower(words), COURSE_TEXT))


def bucket(back: Column, course: Column, relevant: Column, confidence: Column, heuristic: Column | None = None) -> Column:
    """a heuristic hit or a back link first, then what is confident enough (strictly)."""
    sure = F.coalesce(confidence, F.lit(0.0)) > THRESHOLD
    first = back if heuristic is None else heuristic | back
    return (
        F.when(F.coalesce(first, F.lit(False)), "back_link")
        .when(F.coalesce(course, F.lit(False)) & sure, "course_page")
        .when(F.coalesce(relevant, F.lit(False)) & sure, "course_relevant")
        .otherwise("irrelevant")
    )


def bucket_unweighted(back: Column, course: Column, relevant: Column) -> Column:
    """course pages first and no threshold."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return F.when(yes(course), "course_page").when(yes(relevant), "course_relevant").when(yes(back), "back_link").otherwise("irrelevant")


def _record(back, course, relevant, confidence, reasoning) -> Column:
    return F.struct(
        back.alias("is_back_link"), course.alias("is_course_page"), relevant.alias("is_course_relevant"), confidence.cast("double").alias("confidence"),
        reasoning.alias("reasoning"),
    )


def _no(reason: str) -> Column:
    return _record(F.lit(False), F.lit(False), F.lit(False), F.lit(0.0), F.lit(reason))


def parse_batch(response: Column, n: Column) -> Column:
    """M4: the outermost array of an answer, one record for each of ``n`` links; else defaults for all."""
    body = F.regexp_extract(response, r"(?s)\[.*\]", 0)
    found = F.from_json(body, f"array<{CLASSIFICATION}>")
    filled = F.transform(
        found,
        lambda r: _record(
            F.coalesce(r["is_back_link"], F.lit(False)), F.coalesce(r["is_course_page"], F.lit(False)), F.coalesce(r["is_course_relevant"], F.lit(False)),
            F.coalesce(r["confidence"], F.lit(0.5)), F.coalesce(r["reasoning"], F.lit("Batch classification")),
        ),
    )
    defaults = F.transform(F.sequence(F.lit(1), n.cast("int")), lambda i: _no("Parse error"))
    return F.when(F.coalesce(F.size(found), F.lit(-1)) == n, filled).otherwise(F.when(n > 0, defaults).otherwise(F.array().cast(f"array<{CLASSIFICATION}>")))


def parse_single(response: Column) -> Column:
    """M7: the outermost object of an answer; words, if there is none; all false, if it is broken."""
    body = F.regexp_extract(response, r"(?s)\{.*\}", 0)
    parsed = F.from_json(body, CLASSIFICATION)
    whole = F.try_parse_json(body).isNotNull()
    low = F.lower(response)
    words = _record(
        low.contains("back") | low.contains("navigation"), low.contains("course page") | low.contains("course_page"),
        low.contains("course") & low.contains("relevant"), F.lit(0.5), F.lit("Fallback parsing used"),
    )
    read = _record(parsed["is_back_link"], F.coalesce(parsed["is_course_page"], F.lit(False)), parsed["is_course_relevant"], parsed["confidence"], parsed["reasoning"])
    return F.when(body == "", words).when(whole, read).otherwise(_no("Failed to parse AI response"))


def verify_action(answered: Column, is_course: Column, confidence: Column, n_links: Column) -> Column:
    """M9: what becomes of a candidate after its page was read."""
    sure = F.coalesce(is_course, F.lit(False)) & (F.coalesce(confidence, F.lit(0.0)) > THRESHOLD)
    return (
        F.when(~F.coalesce(answered, F.lit(False)), "inaccessible")
        .when(sure, "course_page")
        .when(F.coalesce(n_links, F.lit(0)) > 0, "course_relevant")
        .otherwise("dropped")
    )


def key_of_request(n: Column, keys: int) -> Column:
    """Requests count from 1; the second key is handed out first (0-based place of the key)."""
    return F.pmod(n, F.lit(keys))


def next_key(keys: list[str], n: int) -> str:
    return keys[n % len(keys)]
