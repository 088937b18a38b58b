"""URL algebra as Catalyst expressions (U1-U15). No function here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File extensions that are never course pages, by kind.
FILE_EXTENSIONS = (
    "jpg jpeg png gif bmp svg ico webp tiff tif "
    "pdf doc docx xls xlsx ppt pptx odt ods odp "
    "zip rar tar gz 7z bz2 xz "
    "mp4 mp3 avi mov wmv flv wav mkv webm "
    "css js json xml txt csv sql log "
    "epub mobi azw djvu ps eps"
).split()
# Web pages, never files; download words; schemes that lead nowhere; files of courses; materials.
WEB_EXTENSIONS = "html htm php asp aspx jsp do".split()
DOWNLOAD_WORDS = ("download", "attachment", "file=")
BAD_SCHEMES = ("javascript:", "mailto:", "tel:", "ftp:", "data:", "blob:", "void(")
PAGE_SKIP_PREFIXES = ("#", "javascript:", "mailto:", "tel:", "ftp:", "data:", "blob:")
MATERIAL_SKIP_PREFIXES = ("#", "mailto:", "javascript:", "tel:")
COURSE_FILES = "pdf doc docx ppt pptx zip rar".split()
MATERIAL_FILES = "pdf doc docx ppt pptx zip rar ipynb py java c cpp".split()

SCHEME = r"(?:[A-Za-z][A-Za-z0-9+.\-]*:)?"


def ends_with_any(value: Column, extensions: list[str]) -> Column:
    return value.rlike(r"\.(?:" + "|".join(extensions) + r")\z")


def contains_any(value: Column, words: tuple[str, ...]) -> Column:
    found = value.contains(words[0])
    for word in words[1:]:
        found = found | value.contains(word)
    return found


def starts_with_any(value: Column, prefixes: tuple[str, ...]) -> Column:
    found = value.startswith(prefixes[0])
    for prefix in prefixes[1:]:
        found = found | value.startswith(prefix)
    return found


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, rf"^{SCHEME}//([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, rf"^{SCHEME}(?://[^/?#]*)?([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def fragment(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^[^#]*#(.*)\z", 1)


def parts(url: Column) -> Column:
    """U2."""
    return F.struct(scheme(url).alias("scheme"), netloc(url).alias("netloc"), path(url).alias("path"), query(url).alias("query"), fragment(url).alias("fragment"))


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, r"(?s)#.*\z", "")


def _query_of(url: Column) -> Column:
    return F.when(query(url) != "", F.concat(F.lit("?"), query(url))).otherwise("")


def page_norm(url: Column) -> Column:
    """N1 (U3): scheme and host in lower case, path without slashes at its end, no fragment."""
    stripped = F.regexp_replace(path(url), r"/+\z", "")
    return F.concat(scheme(url), F.lit("://"), F.lower(netloc(url)), F.when(stripped == "", "/").otherwise(stripped), _query_of(url))


def anchor_key(url: Column) -> Column:
    """N2 (U4): scheme taken as https, no fragment, no slash at the end of the whole url."""
    return F.regexp_replace(F.concat(F.lit("https://"), netloc(url), path(url), _query_of(url)), r"/+\z", "")


def cache_key(url: Column) -> Column:
    """N3 (U5): the whole url in lower case, without fragment and outer spaces."""
    return F.lower(F.trim(without_fragment(url)))


def https(url: Column) -> Column:
    """N4 (U6): every http:// becomes https://."""
    return F.replace(url, F.lit("http://"), F.lit("https://"))


def same_domain(url: Column, domain: Column) -> Column:
    """The host as it is written, port included."""
    return netloc(url) == domain


def is_file(url: Column) -> Column:
    """U8: a static file and no web page."""
    low = F.lower(url)
    return F.when(ends_with_any(path(low), WEB_EXTENSIONS), False).otherwise(ends_with_any(path(low), FILE_EXTENSIONS) | contains_any(low, DOWNLOAD_WORDS))


def is_course_file(url: Column) -> Column:
    """By the path's ending."""
    return ends_with_any(F.lower(path(url)), COURSE_FILES)


def is_material_file(url: Column) -> Column:
    """By the ending of the whole url, so that a query hides the file."""
    return ends_with_any(F.lower(url), MATERIAL_FILES)


def basename(url: Column) -> Column:
    """U11."""
    return F.element_at(F.split(path(url), "/"), -1)


def leads_nowhere(href: Column) -> Column:
    """Rules 3 and 4 for anchors."""
    return href.startswith("#") | starts_with_any(F.lower(href), BAD_SCHEMES)


def page_skips(href: Column) -> Column:
    """Case-sensitive."""
    return starts_with_any(href, PAGE_SKIP_PREFIXES)


def material_skips(href: Column) -> Column:
    """Case-sensitive."""
    return starts_with_any(href, MATERIAL_SKIP_PREFIXES)


def _without_dots(joined: Column) -> Column:
    """A path without ``.`` and ``..`` segments; one at the end leaves a slash."""
    segments = F.split(joined, "/")
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(done))
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    kept = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.regexp_replace(F.array_join(kept, "/"), r"^(?!/)", "/")


def join(base: Column, href: Column) -> Column:
    """RFC 3986 resolution of ``href`` against ``base`` (http and https bases)."""
    origin = F.concat(scheme(base), F.lit("://"), netloc(base))
    tail = F.regexp_extract(href, r"(?s)([?#].*)\z", 1)
    own_path = path(href)
    folder = F.regexp_replace(path(base), r"[^/]*\z", "")
    relative = F.concat(F.when(folder == "", "/").otherwise(folder), own_path)
    merged = F.when(own_path.startswith("/"), own_path).otherwise(F.regexp_replace(relative, "/{2,}", "/"))  # as the standard library does
    return (
        F.when(F.length(href) == 0, base)
        .when(scheme(href) != "", href)
        .when(href.startswith("//"), F.concat(scheme(base), F.lit(":"), href))
        .when(href.startswith("?"), F.concat(origin, path(base), href))
        .when(href.startswith("#"), F.concat(without_fragment(base), href))
        .when(own_path.rlike(r"(^|/)\.\.?(/|\z)"), F.concat(origin, _without_dots(merged), tail))
        .otherwise(F.concat(origin, merged, tail))
    )


def safe_filename(key: Column) -> Column:
    """Other characters become ``_``; at most 120 (long keys may collide)."""
    return F.substring(F.regexp_replace(key, "[^A-Za-z0-9_.-]", "_"), 1, 120)
