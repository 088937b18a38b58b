r"""DuckDB SQL for the catalogue's queries. Regular expressions are RE2's: no look-around, ASCII ``\b``."""

from __future__ import annotations

from pagewright.config import DEFAULT
from pagewright.plans import literals

L = literals.sql
YEAR = DEFAULT.current_year
# Fixed values, written out once more: what is compared with must not follow a change of what is checked.
BACK_TEXT = ("back", "home", "return", "go back", "<-", "←", "previous page", "main page", "index")
BACK_URL = "home back return previous parent index.html index.php ../ main ?back &back".split()
COURSE_TEXT = "course class lecture syllabus fall spring semester 2024 2023 2025".split()
COURSE_URL = "/course/ /courses/ /teaching/ /class/ syllabus curriculum lecture assignment fall spring summer winter /cs /math /phys /chem /bio".split()
BAD_SCHEMES = "javascript: mailto: tel: ftp: data: blob: void(".split()
COURSE_FILES = "pdf doc docx ppt pptx zip rar".split()
DOWNLOAD_WORDS = "download attachment file=".split()
FILE_EXTENSIONS = (
    "jpg jpeg png gif bmp svg ico webp tiff tif pdf doc docx xls xlsx ppt pptx odt ods odp zip rar tar gz 7z bz2 xz mp4 mp3 avi mov wmv flv wav mkv webm "
    "css js json xml txt csv sql log epub mobi azw djvu ps eps"
).split()
MATERIAL_FILES = "pdf doc docx ppt pptx zip rar ipynb py java c cpp".split()
MATERIAL_SKIP_PREFIXES = "# mailto: javascript: tel:".split()
PAGE_SKIP_PREFIXES = "# javascript: mailto: tel: ftp: data: blob:".split()
WEB_EXTENSIONS = "html htm php asp aspx jsp do".split()

SCHEME = r"(?:[A-Za-z][A-Za-z0-9+.\-]*:)?"


def scheme(u: str) -> str:
    return rf"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1))"


def netloc(u: str) -> str:
    return f"regexp_extract({u}, '^{SCHEME}//([^/?#]*)', 1)"


def path(u: str) -> str:
    return f"regexp_extract({u}, '^{SCHEME}(?://[^/?#]*)?([^?#]*)', 1)"


def query(u: str) -> str:
    return rf"regexp_extract({u}, '^[^?#]*\?([^#]*)', 1)"


def fragment(u: str) -> str:
    return f"regexp_extract({u}, '(?s)^[^#]*#(.*)$', 1)"


def no_fragment(u: str) -> str:
    return f"split_part({u}, '#', 1)"


def query_of(u: str) -> str:
    return f"CASE WHEN {query(u)} <> '' THEN '?' || {query(u)} ELSE '' END"


def page_norm(u: str) -> str:
    return f"{scheme(u)} || '://' || lower({netloc(u)}) || coalesce(nullif(rtrim({path(u)}, '/'), ''), '/') || {query_of(u)}"


def anchor_key(u: str) -> str:
    return f"rtrim('https://' || {netloc(u)} || {path(u)} || {query_of(u)}, '/')"


def cache_key(u: str) -> str:
    return f"lower(trim({no_fragment(u)}))"


def ends(value: str, extensions: list[str]) -> str:
    return rf"regexp_matches({value}, '\.({'|'.join(extensions)})$')"


def has(value: str, words: tuple) -> str:
    return "(" + " OR ".join(f"contains({value}, '{w}')" for w in words) + ")"


def starts(value: str, words: tuple) -> str:
    return "(" + " OR ".join(f"starts_with({value}, '{w}')" for w in words) + ")"


def is_file(u: str) -> str:
    low = f"lower({u})"
    return f"CASE WHEN {ends(path(low), WEB_EXTENSIONS)} THEN false ELSE {ends(path(low), FILE_EXTENSIONS)} OR {has(low, DOWNLOAD_WORDS)} END"


def nowhere(h: str) -> str:
    return f"(starts_with({h}, '#') OR {starts(f'lower({h})', BAD_SCHEMES)})"


def back_link(u: str, t: str) -> str:
    return f"({has(f'lower({u})', BACK_URL)} OR {has(f'''lower(coalesce({t}, ''))''', BACK_TEXT)})"


ANCHORS = """(SELECT page_id, url AS source_url, generate_subscripts(hs, 1) - 1 AS pos, trim(unnest(hs)) AS href, trim(unnest(ts)) AS text
  FROM (SELECT page_id, url, regexp_extract_all(html, '(?s)<a href="([^"]*)">(.*?)</a>', 1) AS hs, regexp_extract_all(html, '(?s)<a href="([^"]*)">(.*?)</a>', 2) AS ts FROM pages))"""
# all hrefs of the test pages are host-relative
RESOLVED = f"""(SELECT * FROM (SELECT page_id, source_url, pos, {no_fragment(f"({scheme('source_url')} || '://' || {netloc('source_url')} || href)")} AS url, text, href
  FROM {ANCHORS} WHERE href <> '' AND NOT {nowhere('href')}) WHERE NOT ({is_file('url')}))"""
LINKS = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id, {anchor_key('url')} ORDER BY pos) AS k FROM {RESOLVED}) WHERE k = 1)"
TITLE = "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"
PAGE_ROWS = f"""(SELECT page_id AS idx, url, CASE WHEN page_id % 4 = 3 THEN NULL ELSE 'C' || (page_id // 2)::VARCHAR END AS course_code, nullif({TITLE}, '') AS course_title,
  '20' || lpad((page_id % 23)::VARCHAR, 2, '0') AS year FROM pages)"""


def norm_code(c: str) -> str:
    return f"nullif(replace(upper(trim({c})), ' ', ''), '')"


def norm_title(t: str) -> str:
    value = f"regexp_replace(lower(trim({t})), '&ndash;|–|_', '-', 'g')"
    value = rf"regexp_replace({value}, '(?i)\s*\([^)]*(20\d{{2}}|autumn|spring|summer|winter)[^)]*\)', '', 'g')"
    return rf"nullif(trim(regexp_replace({value}, '\s+', ' ', 'g')), '')"


def year_extract(y: str) -> str:
    return rf"coalesce(try_cast(nullif(regexp_extract(coalesce({y}, ''), '(\d{{4}})', 1), '') AS INTEGER), 0)"


def year_int(s: str) -> str:
    text = f"coalesce({s}, '')"
    full = rf"list_max(list_transform(regexp_extract_all({text}, '(20\d{{2}})', 1), lambda y: y::INTEGER))"
    short = rf"list_max(list_transform(regexp_extract_all({text}, '\b(\d{{2}})\b', 1), lambda y: CASE WHEN y::INTEGER <= {YEAR % 100 + 5} THEN y::INTEGER + 2000 ELSE y::INTEGER + 1900 END))"
    return f"coalesce({full}, {short}, 0)::INTEGER"


def components(rows: str) -> str:
    return f"""nr AS (SELECT *, {norm_code('course_code')} AS nc, {norm_title('course_title')} AS nt, {year_extract('year')} AS yn FROM {rows}),
  ed AS (SELECT idx AS x, lag(idx) OVER (PARTITION BY nc ORDER BY idx) AS y FROM nr WHERE nc IS NOT NULL UNION SELECT idx, lag(idx) OVER (PARTITION BY nt ORDER BY idx) FROM nr WHERE nt IS NOT NULL),
  e2 AS (SELECT x, y FROM ed WHERE y IS NOT NULL UNION SELECT y, x FROM ed WHERE y IS NOT NULL),
  rc(x, y) AS (SELECT idx, idx FROM nr UNION SELECT rc.x, e2.y FROM rc JOIN e2 ON rc.y = e2.x),
  cp AS (SELECT x AS idx, min(y) AS component FROM rc GROUP BY x),
  cr AS (SELECT nr.*, component FROM nr JOIN cp USING (idx))"""


CANONICAL = """lt AS (SELECT component, course_code AS canonical_code FROM (SELECT *, row_number() OVER (PARTITION BY component ORDER BY CASE WHEN yn > 0 THEN yn ELSE -1 END DESC, idx) AS k FROM cr) WHERE k = 1),
  tt AS (SELECT component, course_title AS canonical_title FROM (SELECT component, course_title, row_number() OVER (PARTITION BY component ORDER BY count(*) DESC, min(idx)) AS k FROM cr WHERE course_title IS NOT NULL GROUP BY component, course_title) WHERE k = 1),
  cn AS (SELECT component, canonical_code, canonical_title FROM lt LEFT JOIN tt USING (component))"""


def grouped(rows: str) -> str:
    return f"""(SELECT *, CASE WHEN group_type = 'singleton' THEN 'singleton_' || row_number() OVER (PARTITION BY group_type ORDER BY idx) WHEN c <> '' THEN c ELSE t END AS group_key
  FROM (SELECT *, CASE WHEN c <> '' THEN 'course_code' WHEN t <> '' THEN 'course_title' ELSE 'singleton' END AS group_type
    FROM (SELECT *, trim(coalesce(course_code, '')) AS c, trim(coalesce(course_title, '')) AS t FROM {rows})))"""


def bucket(back: str, course: str, relevant: str, confidence: str) -> str:
    return f"CASE WHEN {back} THEN 'back_link' WHEN {course} AND {confidence} > 0.5 THEN 'course_page' WHEN {relevant} AND {confidence} > 0.5 THEN 'course_relevant' ELSE 'irrelevant' END"


JUDGED = f"""(SELECT l.*, d.source, {bucket('l.toxic = 1', 'l.quality = 1', 'l.quality = 0', '(0.4::DOUBLE + (l.doc_id % 3)::DOUBLE / 10)')} AS bucket FROM labels l JOIN documents d USING (doc_id))"""
CACHE = f"(SELECT key, min(page_id) AS first FROM (SELECT page_id, {cache_key('url')} AS key FROM pages WHERE page_id % 2 = 0) GROUP BY key)"
KEYED = f"(SELECT page_id, {cache_key('url')} AS cache_key FROM pages)"
EVENTS = "(SELECT event_id + 1 AS n, (event_id + 1) % 3 AS key, event_type <> 'error' AS ok FROM events)"
RUNS = "(SELECT *, sum(ok::INT) OVER (PARTITION BY key ORDER BY n) AS run FROM " + EVENTS + ")"
CODES = r"regexp_extract_all(text, '\b([A-Z]{2,3}\s?\d{2,5})\b', 1)"
CODE_OF = f"""(SELECT id, replace(code, ' ', '') AS code FROM (SELECT id, code, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, min(p)) AS k
  FROM (SELECT id, unnest({CODES}) AS code, generate_subscripts({CODES}, 1) AS p FROM {L('lit_text')}) GROUP BY id, code) WHERE k = 1)"""
SEMESTER = r"nullif(trim(regexp_extract(text, '(?i)\b(Autumn|Spring|Fall|Monsoon|Winter|Even\s+Semester|Odd\s+Semester)', 1)), '')"
FIRST_YEAR = r"nullif(regexp_extract(text, '\b(20\d{2}(?:-\d{2,4})?)\b', 1), '')"
NOTES = r"(?i)\b(lecture|lec\d*|week\d*|slide|tutorial|assignment)\b"
SYLLABUS = r"(?i)\b(unit|topic|syllabus|outline|module)\b"
LOGISTICS = r"(?i)\b(time|venue|room|slot|instructor|timing|schedule)\b"


def word(both: str, words: str) -> str:
    """Whether one of the words stands between characters that are no letters."""
    return f"regexp_matches(' ' || {both} || ' ', '[^a-zA-Z]({words})[^a-zA-Z]')"


def material(t: str, u: str) -> str:
    both = f"(lower(coalesce({t}, '')) || ' ' || lower({u}))"
    return (
        f"CASE WHEN {word(both, 'slide|lecture|lec[0-9]*|ppt|presentation')} OR {ends(f'lower({u})', ['ppt', 'pptx'])} THEN 'slides' "
        f"WHEN {word(both, 'question|exam|midterm|endsem|midsem|end[-_]?sem|mid[-_]?sem|test|paper|previous')} THEN 'question_papers' "
        f"WHEN {word(both, 'tutorial|tut[0-9]*|lab|exercise|assignment|homework')} THEN 'tutorials' "
        f"WHEN {word(both, 'example|sample|demo|code|program')} OR {ends(f'lower({u})', ['py', 'ipynb', 'java', 'c', 'cpp', 'zip'])} THEN 'example_code' END"
    )


def record(j: str, default_conf: str, default_reason: str) -> str:
    return (
        f"coalesce(({j}->>'is_back_link')::BOOLEAN, false) AS is_back_link, coalesce(({j}->>'is_course_page')::BOOLEAN, false) AS is_course_page, "
        f"coalesce(({j}->>'is_course_relevant')::BOOLEAN, false) AS is_course_relevant, coalesce(({j}->>'confidence')::DOUBLE, {default_conf}) AS confidence, "
        f"coalesce({j}->>'reasoning', '{default_reason}') AS reasoning"
    )


TEXT_OF = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html,
  '(?is)<!--.*?-->|<!doctype[^>]*>|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
  '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g'))"""

READABLE = r"""array_to_string(list_filter(flatten(list_transform(string_split(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html,
  '(?is)<!--.*?-->|<!doctype[^>]*>|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<nav\b.*?</nav\s*>|<footer\b.*?(</footer\s*>|$)', '', 'g'), '(?s)<[^>]*>', '', 'g'),
  '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), chr(10)), lambda l: list_transform(string_split(trim(l), '  '), lambda p: trim(p)))), lambda p: p <> ''), ' ')"""


def join(base: str, href: str) -> str:
    """RFC 3986 resolution; dot segments fall away in one pass over the path's parts."""
    origin, own = f"({scheme(base)} || '://' || {netloc(base)})", path(href)
    folder = f"regexp_replace({path(base)}, '[^/]*$', '')"
    merged = f"CASE WHEN starts_with({own}, '/') THEN {own} ELSE regexp_replace(coalesce(nullif({folder}, ''), '/') || {own}, '/{{2,}}', '/', 'g') END"
    parts = f"string_split({merged}, '/')"
    kept = (
        f"list_reduce(list_transform({parts}, lambda s: [s]), lambda a, b: CASE WHEN b[1] = '..' THEN CASE WHEN len(a) > 1 THEN a[1:len(a) - 1] ELSE a END "
        f"WHEN b[1] = '.' THEN a ELSE list_concat(a, b) END)"
    )
    plain = f"array_to_string(CASE WHEN ({parts})[-1] IN ('.', '..') THEN list_append({kept}, '') ELSE {kept} END, '/')"
    plain = f"CASE WHEN starts_with({plain}, '/') THEN {plain} ELSE '/' || {plain} END"
    tail = f"regexp_extract({href}, '(?s)([?#].*)$', 1)"
    return (
        f"CASE WHEN {href} = '' THEN {base} WHEN {scheme(href)} <> '' THEN {href} WHEN starts_with({href}, '//') THEN {scheme(base)} || ':' || {href} "
        f"WHEN starts_with({href}, '?') THEN {origin} || {path(base)} || {href} WHEN starts_with({href}, '#') THEN {no_fragment(base)} || {href} ELSE {origin} || {plain} || {tail} END"
    )


# Fixed value: what the friendly titles of the fixed anchors are (their capitals follow no SQL function).
FRIENDLY = {9: "I", 8: "H", 12: "Lec 05 Intro", 15: "Assignment 2.Final", 16: "Tutorial 07", 17: ""}

_GENERIC = "lower(trim(text)) IN ('click here', 'download', 'pdf', 'here', 'link', 'file', 'view', 'open', '')"
_FRIENDLY = "CASE id " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in FRIENDLY.items()) + " END"

ORACLES: dict[str, str] = {
    "url_parts": f"SELECT page_id, {scheme('url')} AS scheme, {netloc('url')} AS netloc, {path('url')} AS path, {query('url')} AS query, {fragment('url')} AS fragment FROM pages",
    "url_norm_n1": f"SELECT page_id, {page_norm('url')} AS norm FROM pages",
    "url_norm_n2": f"SELECT page_id, {anchor_key('url')} AS norm FROM pages",
    "url_cache_key": f"SELECT page_id, {cache_key('url')} AS cache_key FROM pages",
    "url_https": "SELECT DISTINCT replace(url, 'http://', 'https://') AS url FROM pages",
    "url_kinds": f"""SELECT id, {is_file('href')} AS is_file, {ends(f"lower({path('href')})", COURSE_FILES)} AS is_course_file, {ends('lower(href)', MATERIAL_FILES)} AS is_material_file,
  list_extract(string_split({path('href')}, '/'), -1) AS basename, {nowhere('href')} AS leads_nowhere, {starts('href', PAGE_SKIP_PREFIXES)} AS page_skips,
  {starts('href', MATERIAL_SKIP_PREFIXES)} AS material_skips FROM {L('lit_urls')}""",
    "url_is_file_pages": f"SELECT page_id, {is_file('url')} AS is_file FROM pages",
    "safe_filename": "SELECT page_id, substr(regexp_replace(url, '[^A-Za-z0-9_.-]', '_', 'g'), 1, 120) AS file FROM pages",
    "links_anchor": f"SELECT page_id, pos::INTEGER AS pos, href, text FROM {ANCHORS} WHERE href <> '' AND NOT {nowhere('href')}",
    "links_resolved": f"SELECT page_id, pos::INTEGER AS pos, url FROM {RESOLVED}",
    "links_dedup": f"SELECT page_id, pos::INTEGER AS pos, url, text, 'a' AS tag FROM {LINKS}",
    "links_dedup_native": f"SELECT page_id, pos::INTEGER AS pos, url, text FROM {LINKS}",
    "links_per_page": f"SELECT page_id, count(*) AS n_links, count_if({netloc('url')} = {netloc('source_url')})::BIGINT AS n_same_domain FROM {LINKS} GROUP BY page_id",
    "url_join": f"SELECT id, {join('base', 'href')} AS url FROM {L('lit_urls')}",
    "links_same_domain": f"""SELECT id, {netloc('url')} <> 'Www.Site.example.edu' AS is_external, {netloc('url')} = 'Www.Site.example.edu' AND ({is_file('url')}) AS is_file_link
  FROM (SELECT id, {join('base', 'href')} AS url FROM {L('lit_urls')})""",
    "link_context": f"""SELECT page_id, pos::INTEGER AS pos, substr(text, 1, 200) AS parent_text, '' AS heading_above, substr('<li><a href="' || href || '">' || text || '</a></li>', 1, 500) AS parent_block FROM {LINKS}""",
    "readable_text": f"SELECT page_id, CASE WHEN length(t) > 8000 THEN substr(t, 1, 8000) || '...' ELSE t END AS text FROM (SELECT page_id, {READABLE} AS t FROM pages)",
    "filter_links": rf"""SELECT page_id, pos::INTEGER AS pos, url, CASE WHEN back THEN 'back_link' WHEN first IS NOT NULL THEN CASE WHEN first % 4 = 0 THEN 'course_page' ELSE 'course_relevant' END
  WHEN regexp_matches(lower(text), '\b[a-z]{{2,4}}[-_ ]?\d{{3,4}}\b') THEN 'course_page' WHEN {has("(lower(url) || ' ' || lower(text))", ('course', 'teaching', 'syllabus', 'lecture', 'semester', 'class'))} THEN 'course_relevant' ELSE 'irrelevant' END AS bucket,
  CASE WHEN back THEN 'heuristic' ELSE 'model' END AS method
FROM (SELECT *, {back_link('url', 'text')} AS back, row_number() OVER (PARTITION BY page_id, {page_norm('url')} ORDER BY pos) AS k2 FROM {LINKS}) LEFT JOIN {CACHE} ON key = {cache_key('url')} WHERE k2 = 1""",
    "links_per_tag": f"SELECT 'a' AS tag, count(*) AS n FROM {LINKS} HAVING count(*) > 0",
    "internal_links": f"""SELECT page_id, pos::INTEGER AS pos, href, text FROM (SELECT page_id, pos, text, {scheme('source_url')} || '://' || {netloc('source_url')} || href AS href,
  row_number() OVER (PARTITION BY page_id, href ORDER BY pos) AS k FROM {ANCHORS} WHERE href <> '' AND NOT {starts('href', PAGE_SKIP_PREFIXES)}) WHERE k = 1""",
    "first_wins_global": f"SELECT page_id, pos::INTEGER AS pos, url FROM (SELECT *, row_number() OVER (PARTITION BY {page_norm('url')} ORDER BY page_id, pos) AS k2 FROM {LINKS}) WHERE k2 = 1",
    "dedup_removed": f"""SELECT bucket, count(*) AS n, count(DISTINCT norm) AS n_unique, count(*) - count(DISTINCT norm) AS n_removed FROM (
  SELECT CASE WHEN {back_link('url', 'text')} THEN 'back_link' ELSE 'other' END AS bucket, {page_norm('url')} AS norm FROM {LINKS}) GROUP BY bucket""",
    "page_title": rf"""SELECT page_id, trim(regexp_replace(replace(replace(replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&quot;', '"'), '&lt;', '<'), '&amp;', '&'), '\s+', ' ', 'g')) AS title FROM pages""",
    "visible_text_native": f"SELECT page_id, {TEXT_OF} AS text FROM pages",
    "html_chunks": f"""SELECT page_id, w AS "window", substr(html, (w * 8000 + 1)::BIGINT, 8000) AS chunk
  FROM (SELECT page_id, html, unnest(range(0, greatest((length(html) + 7999) // 8000, 1))) AS w FROM pages)""",
    "back_link_flag": f"SELECT id, {back_link('url', 'text')} AS is_back FROM {L('lit_links')}",
    "back_link_pages": f"SELECT page_id, pos::INTEGER AS pos, {back_link('url', 'text')} AS is_back FROM {LINKS}",
    "course_indicator_flag": rf"""SELECT id, regexp_matches(coalesce(text, ''), '(?i)\b[A-Z]{{2,4}}[-_\s]?\d{{3,4}}\b') OR ({has('lower(url)', COURSE_URL)} AND {has("lower(coalesce(text, ''))", COURSE_TEXT)}) AS has_indicators FROM {L('lit_links')}""",
    "bucket_classify": f"""SELECT id, {bucket('(heuristic OR back)', 'course', 'relevant', 'confidence')} AS bucket,
  CASE WHEN course THEN 'course_page' WHEN relevant THEN 'course_relevant' WHEN back THEN 'back_link' ELSE 'irrelevant' END AS unweighted FROM {L('lit_cls')}""",
    "bucket_stats": f"SELECT source, bucket, count(*) AS n FROM {JUDGED} GROUP BY source, bucket",
    "crawl_stats": f"""SELECT count(*) AS all_links, count_if(source = 'src1')::BIGINT AS external, (count(*) - count_if(source = 'src1'))::BIGINT AS same_domain, count_if(source = 'src2')::BIGINT AS file_links,
  {', '.join(f"count_if(bucket = '{b}')::BIGINT AS {b}" for b in ('back_link', 'course_page', 'course_relevant', 'irrelevant', 'inaccessible'))} FROM {JUDGED}""",
    "cache_hits": f"SELECT page_id, cache_key, first % 4 = 0 AS is_course_page, true AS from_cache FROM {KEYED} JOIN {CACHE} ON key = cache_key",
    "cache_misses": f"SELECT page_id, cache_key FROM {KEYED} WHERE cache_key NOT IN (SELECT key FROM {CACHE})",
    "cache_stats": f"""SELECT (SELECT count(*) FROM {CACHE}) AS cache_size, count(key)::BIGINT AS cache_hits, (count(*) - count(key))::BIGINT AS cache_misses, round(100.0::DOUBLE * count(key) / count(*), 6) AS hit_rate
  FROM {KEYED} LEFT JOIN {CACHE} ON key = cache_key""",
    "cache_upsert": """SELECT cache_key, version, value FROM (SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY version DESC) AS k FROM (
  SELECT 'u' || (user_id % 50)::VARCHAR AS cache_key, event_id AS version, value FROM events WHERE event_id % 2 = 0 OR event_type <> 'error')) WHERE k = 1""",
    "batch_ids": f"""SELECT page_id, pos::INTEGER AS pos, place, place // 7 AS batch_id, place % 7 AS place_in_batch
  FROM (SELECT page_id, pos, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS place FROM {LINKS})""",
    "batch_parse": rf"""WITH r AS (SELECT id, n, regexp_extract(response, '(?s)\[.*\]', 0) AS body FROM {L('lit_json')}),
  j AS (SELECT id, n, CASE WHEN json_valid(body) AND json_array_length(body::JSON) = n THEN body::JSON END AS a FROM r),
  i AS (SELECT id, a, unnest(range(0, n)) AS place, a IS NOT NULL AS ok FROM j)
SELECT id, place, CASE WHEN ok THEN is_back_link ELSE false END AS is_back_link, CASE WHEN ok THEN is_course_page ELSE false END AS is_course_page, CASE WHEN ok THEN is_course_relevant ELSE false END AS is_course_relevant,
  CASE WHEN ok THEN confidence ELSE 0.0::DOUBLE END AS confidence, CASE WHEN ok THEN reasoning ELSE 'Parse error' END AS reasoning
FROM (SELECT id, place, ok, {record("json_extract(a, '$[' || place || ']')", '0.5::DOUBLE', 'Batch classification')} FROM i)""",
    "single_parse": rf"""WITH r AS (SELECT id, response, regexp_extract(response, '(?s)\{{.*\}}', 0) AS body FROM {L('lit_single')}), j AS (SELECT *, CASE WHEN json_valid(body) THEN body::JSON END AS o, lower(response) AS low FROM r)
SELECT id, CASE WHEN body = '' THEN contains(low, 'back') OR contains(low, 'navigation') WHEN o IS NULL THEN false ELSE (o->>'is_back_link')::BOOLEAN END AS is_back_link,
  CASE WHEN body = '' THEN contains(low, 'course page') OR contains(low, 'course_page') WHEN o IS NULL THEN false ELSE coalesce((o->>'is_course_page')::BOOLEAN, false) END AS is_course_page,
  CASE WHEN body = '' THEN contains(low, 'course') AND contains(low, 'relevant') WHEN o IS NULL THEN false ELSE (o->>'is_course_relevant')::BOOLEAN END AS is_course_relevant,
  CASE WHEN body = '' THEN 0.5::DOUBLE WHEN o IS NULL THEN 0.0::DOUBLE ELSE (o->>'confidence')::DOUBLE END AS confidence,
  CASE WHEN body = '' THEN 'Fallback parsing used' WHEN o IS NULL THEN 'Failed to parse AI response' ELSE o->>'reasoning' END AS reasoning FROM j""",
    "key_rotation": f"SELECT n, key FROM {EVENTS}",
    "key_error_run": f"SELECT n, key, sum((NOT ok)::INT) OVER (PARTITION BY key, run ORDER BY n)::BIGINT AS errors FROM {RUNS}",
    "key_stats": f"SELECT key, count(*) AS requests, count_if(NOT ok AND run = last)::BIGINT AS errors FROM (SELECT *, max(run) OVER (PARTITION BY key) AS last FROM {RUNS}) GROUP BY key",
    "verify_decision": f"""SELECT id, CASE WHEN NOT coalesce(answered, false) THEN 'inaccessible' WHEN coalesce(is_course, false) AND coalesce(confidence, 0) > 0.5 THEN 'course_page'
  WHEN coalesce(n_links, 0) > 0 THEN 'course_relevant' ELSE 'dropped' END AS action FROM {L('lit_verify')}""",
    "crawl_levels": """WITH RECURSIVE t AS (SELECT 's' || l_suppkey AS src, 'p' || l_partkey AS dst FROM lineitem), e AS (SELECT src, dst FROM t UNION SELECT dst, src FROM t),
  r(node, depth) AS (SELECT 's1', 0 UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON r.node = e.src WHERE r.depth < 2) SELECT node, min(depth)::INTEGER AS depth FROM r GROUP BY node""",
    "course_code": f"SELECT id, code FROM {L('lit_text')} LEFT JOIN {CODE_OF} USING (id)",
    "semester": f"SELECT id, {SEMESTER} AS semester FROM {L('lit_text')}",
    "year_first": f"SELECT id, {FIRST_YEAR} AS year FROM {L('lit_text')}",
    "page_type_manual": rf"""SELECT id, CASE WHEN len(list_distinct({CODES})) > 5 THEN 'curricula_list_like' WHEN files >= 2 THEN 'notes_subpage_like' WHEN syllabus THEN 'syllabus_like'
  WHEN code IS NOT NULL AND ({SEMESTER} IS NOT NULL OR {FIRST_YEAR} IS NOT NULL) AND topics THEN 'course_page_like'
  WHEN len(regexp_extract_all(text, '{LOGISTICS}', 1)) >= 3 AND NOT regexp_matches(text, '{NOTES}') AND NOT regexp_matches(text, '{SYLLABUS}') THEN 'logistics_only_like' ELSE 'other' END AS page_type
FROM {L('lit_text')} LEFT JOIN {CODE_OF} USING (id)""",
    "year_int": f"SELECT id, {year_int('s')} AS year FROM {L('lit_years')}",
    "year_int_pages": f"SELECT page_id, {year_int('text')} AS year FROM (SELECT page_id, {TEXT_OF} AS text FROM pages)",
    "year_extract": f"SELECT id, {year_extract('s')} AS year FROM {L('lit_years')}",
    "norm_code": f"SELECT p_partkey, {norm_code(chr(39) + ' ' + chr(39) + ' || p_brand')} AS code FROM part",
    "norm_title": f"SELECT idx, {norm_code('course_code')} AS code, {norm_title('course_title')} AS title FROM {L('lit_rows')}",
    "merge_conflict": f"""SELECT id, conflict AS conflict_flag, conflict OR confidence = 'low' AS recheck_needed FROM (SELECT *, CASE manual WHEN 'syllabus_like' THEN 'syllabus_pdf_link' WHEN 'course_page_like' THEN 'course_page'
  WHEN 'notes_subpage_like' THEN 'notes_subpage' WHEN 'curricula_list_like' THEN 'curricula_list' WHEN 'logistics_only_like' THEN 'logistics_only' ELSE 'other' END <> ai AS conflict FROM {L('lit_merge')})""",
    "components": f"WITH RECURSIVE {components(PAGE_ROWS)} SELECT idx, component FROM cp",
    "canonical_rows": f"WITH RECURSIVE {components(PAGE_ROWS)}, {CANONICAL} SELECT component, canonical_code, canonical_title FROM cn",
    "resolved_rows": f"WITH RECURSIVE {components(L('lit_rows'))}, {CANONICAL} SELECT idx, canonical_code AS course_code, canonical_title AS course_title, year FROM cr JOIN cn USING (component)",
    "resolve_check": f"""WITH RECURSIVE {components(PAGE_ROWS)}, c AS (SELECT count(DISTINCT course_code) AS n_codes, count(DISTINCT course_title) AS n_titles,
  count(DISTINCT CASE WHEN course_code IS NOT NULL AND course_title IS NOT NULL THEN (course_code, course_title) END) AS n_pairs, count(DISTINCT component) AS n_groups FROM cr)
SELECT *, n_codes = n_titles AND n_titles = n_pairs AND n_pairs = n_groups AS consistent FROM c""",
    "group_tiers": f"SELECT idx, group_type, group_key FROM {grouped(L('lit_groups'))}",
    "group_tiers_pages": f"SELECT idx, group_type, group_key FROM {grouped(PAGE_ROWS)}",
    "group_index": f"""SELECT idx, group_key, (row_number() OVER (PARTITION BY group_type, group_key ORDER BY year_int DESC, idx))::INTEGER AS index, nullif(c, '') AS course_code, nullif(t, '') AS course_title,
  nullif(trim(semester), '') AS semester, nullif(trim(year), '') AS year, year_int FROM (SELECT *, {year_int("coalesce(nullif(year, ''), nullif(semester, ''))")} AS year_int FROM {grouped(L('lit_groups'))})""",
    "group_order": f"""SELECT group_key, group_type, count(*) AS n_links FROM {grouped(L('lit_groups'))} GROUP BY group_type, group_key
  ORDER BY CASE group_type WHEN 'course_code' THEN 0 WHEN 'course_title' THEN 1 ELSE 2 END, CASE WHEN group_type = 'singleton' THEN lpad(min(idx)::VARCHAR, 20, '0') ELSE group_key END LIMIT 4""",
    "material_type": f"SELECT id, CASE WHEN {ends('lower(url)', MATERIAL_FILES)} THEN {material('text', 'url')} END AS item_type FROM {L('lit_anchor')}",
    "material_dedup": f"""SELECT id, item_type, file_url FROM (SELECT *, row_number() OVER (PARTITION BY item_type, file_url ORDER BY id) AS k
  FROM (SELECT id, coalesce({material('text', 'url')}, 'unknown') AS item_type, url AS file_url FROM {L('lit_anchor')})) WHERE k = 1""",
    "friendly_title": f"""SELECT id, {_GENERIC} AS is_generic, CASE WHEN {_GENERIC} THEN {_FRIENDLY} ELSE text END AS title FROM {L('lit_anchor')}""",
    "sem_label": f"""SELECT idx, coalesce(nullif(concat_ws(' ', nullif(semester, ''), CASE WHEN year <> '' AND NOT contains(coalesce(semester, ''), year) THEN year END), ''), 'Course Materials') AS label FROM {L('lit_groups')}""",
    "generation_summary": """SELECT count(*) AS processed_count, count_if(page_id % 97 = 0)::BIGINT AS failed_count, sum(page_id % 5)::BIGINT AS items, count_if(page_id % 97 = 0)::BIGINT AS n_failed_urls FROM pages""",
}
_SUMMARY = "SELECT count(*) AS attempted, count(manual) AS processed, (count(*) - count(manual))::BIGINT AS failed, count_if(conflict_flag)::BIGINT AS conflicts, count_if(recheck_needed)::BIGINT AS recheck"
ORACLES["pipeline_summary"] = f"""{_SUMMARY}, count_if(useful)::BIGINT AS useful, count_if(manual IS NOT NULL AND NOT useful)::BIGINT AS not_useful, count_if(syllabus AND NOT useful)::BIGINT AS syllabus_only
  FROM {L('lit_merge')} JOIN ({ORACLES['merge_conflict']}) USING (id)"""


# The fixed site. Its extracted links are written out; what becomes of them is worked out here.
SITE = "'https://site.example.edu"
EXTRACTED = f"""(SELECT 1 AS page_id, row_number() OVER (ORDER BY own DESC, pos) - 1 AS pos, url, text, tag FROM (
    SELECT pos, url, text, 'a' AS tag, true AS own FROM {L('exp_anchor_links')} WHERE page_id = 1 UNION ALL SELECT pos, url, text, tag, false FROM {L('exp_resource_links')})
  UNION ALL SELECT page_id, pos, url, text, 'a' FROM {L('exp_anchor_links')} WHERE page_id <> 1)"""
JUDGED_LINKS = rf"""(SELECT e.*, p.url AS source, {netloc('e.url')} <> 'site.example.edu' AS is_external, {netloc('e.url')} = 'site.example.edu' AND ({is_file('e.url')}) AS is_file_link,
  CASE WHEN {back_link('e.url', 'e.text')} THEN 'back_link' WHEN regexp_matches(lower(e.text), '\b[a-z]{{2,4}}[-_ ]?\d{{3,4}}\b') THEN 'course_page'
    WHEN {has("(lower(e.url) || ' ' || lower(e.text))", ('course', 'teaching', 'syllabus', 'lecture', 'semester', 'class'))} THEN 'course_relevant' ELSE 'irrelevant' END AS bucket
  FROM {EXTRACTED} e JOIN {L('lit_html')} p USING (page_id))"""
# The site's links lead at most one level below its seeds.
CRAWLED = f"""sd(url) AS (VALUES ({SITE}/cs/cs102.html'), ({SITE}/cs/index.html')), jl AS (SELECT * FROM {JUDGED_LINKS}),
  vs(url, depth) AS (SELECT url, 0 FROM sd UNION SELECT jl.url, vs.depth + 1 FROM vs JOIN jl ON jl.source = vs.url WHERE NOT is_external AND NOT is_file_link AND bucket = 'course_relevant' AND vs.depth < 7),
  v AS (SELECT url, min(depth) AS depth FROM vs GROUP BY url),
  fl AS (SELECT jl.*, v.depth FROM jl JOIN v ON v.url = jl.source),
  gone AS (SELECT v.url, v.depth FROM v LEFT JOIN {L('lit_html')} p ON p.url = v.url WHERE p.html IS NULL),
  al AS (SELECT bucket, url, depth, page_id, pos FROM fl WHERE NOT is_external AND NOT is_file_link UNION ALL SELECT 'all_extracted', url, depth, page_id, pos FROM fl
    UNION ALL SELECT 'external', url, depth, page_id, pos FROM fl WHERE is_external UNION ALL SELECT 'file', url, depth, page_id, pos FROM fl WHERE is_file_link
    UNION ALL SELECT 'inaccessible', url, depth, 0, 0 FROM gone),
  bk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bucket, {page_norm('url')} ORDER BY depth, page_id, pos) AS k FROM al) WHERE k = 1)"""


def number_of(bucket: str) -> str:
    return f"(SELECT count(*) FROM bk WHERE bucket = '{bucket}')"


def shown(rows: str, cap: int) -> str:
    """``place, line`` of rows ``(place, line)``: the first ``cap``, and how many more there are."""
    return f"""SELECT place::INTEGER AS place, line FROM {rows} WHERE place <= {cap}
  UNION ALL SELECT {cap + 1}, '... and ' || (count(*) - {cap}) || ' more' FROM {rows} HAVING count(*) > {cap}"""


_SUMMARIES = " UNION ALL ".join(
    f"SELECT '{bucket}' AS bucket, * FROM ({shown(f"(SELECT row_number() OVER (ORDER BY depth, page_id, pos, url) AS place, url AS line FROM bk WHERE bucket = '{bucket}')", cap)})"
    for bucket, cap in (("course_page", 5), ("course_relevant", 3), ("file", 5), ("inaccessible", 5))
)
_INDICATORS = rf"""(regexp_matches(coalesce(text, ''), '(?i)\b[A-Z]{{2,4}}[-_\s]?\d{{3,4}}\b') OR ({has('lower(url)', COURSE_URL)} AND {has("lower(coalesce(text, ''))", COURSE_TEXT)}))"""
_CODE_TEXT = r"regexp_matches(lower(coalesce(text, '')), '\b[a-z]{2,4}[-_ ]?\d{3,4}\b')"
VISIBLE = f"(SELECT page_id, url, {TEXT_OF} AS text, html FROM pages)"
_FIELDS = rf"""(SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS course_title,
  nullif(regexp_extract(text, '\b([A-Z]{{2,3}}\s?\d{{2,5}})\b', 1), '') AS course_code, {FIRST_YEAR} AS year, {SEMESTER} AS semester,
  CASE WHEN len(regexp_extract_all(text, '{LOGISTICS}', 1)) >= 3 AND NOT regexp_matches(text, '{NOTES}') AND NOT regexp_matches(text, '{SYLLABUS}') THEN 'logistics_only_like' ELSE 'other' END AS manual_page_type
  FROM {VISIBLE})"""
INTERNAL = f"""(SELECT page_id, pos, text, href FROM (SELECT page_id, pos, text, {scheme('source_url')} || '://' || {netloc('source_url')} || href AS href,
  row_number() OVER (PARTITION BY page_id, href ORDER BY pos) AS k FROM {ANCHORS} WHERE href <> '' AND NOT {starts('href', PAGE_SKIP_PREFIXES)}) WHERE k = 1)"""
_COURSE_ROWS = f"""(SELECT f.*, CASE WHEN course_code IS NULL THEN 'other' ELSE 'course_page' END AS ai_page_type, CASE WHEN course_code IS NULL THEN 'low' ELSE 'high' END AS ai_confidence,
  CASE manual_page_type WHEN 'logistics_only_like' THEN 'logistics_only' ELSE 'other' END AS ai_of_manual, coalesce(n_internal, 0) AS n_internal, coalesce(links_json, '[]') AS links_json
  FROM {_FIELDS} f LEFT JOIN (SELECT page_id, count(*) AS n_internal, '[' || string_agg('{{"href":' || to_json(href) || ',"text":' || to_json(text) || '}}', ',' ORDER BY pos) || ']' AS links_json FROM {INTERNAL} GROUP BY page_id) USING (page_id))"""
_LABEL = "coalesce(nullif(concat_ws(' ', nullif(semester, ''), CASE WHEN year <> '' AND NOT contains(coalesce(semester, ''), trim(year)) THEN trim(year) END), ''), 'Course Materials')"


def markdown(index: str, bodies: str) -> str:
    """Catalogue pages of ``index`` (group_type, group_key, c, t, url, place, label) with the finished sections ``bodies`` of each place."""
    end = "chr(10) || chr(10)"
    return f"""WITH n AS ({index}), b AS ({bodies}),
  p AS (SELECT n.*, '## ' || label || {end} || '**Source:** [Course Page](' || url || ')' || {end} || CASE WHEN body IS NULL THEN '*No learning materials could be extracted from this page.*' || {end}
    ELSE body || '*Full course page: [' || url || '](' || url || ')*' || {end} END || '---' || chr(10) AS part
    FROM n LEFT JOIN b ON b.group_type = n.group_type AND b.group_key = n.group_key AND b.place = n.place),
  f AS (SELECT group_type, group_key, min(CASE WHEN t <> '' THEN place END) AS titled, max(place) AS last FROM n GROUP BY ALL),
  h AS (SELECT f.group_type, f.group_key, coalesce(max(CASE WHEN place = titled THEN t END), '') AS title,
    coalesce(max_by(c, place) FILTER (c <> '' AND place <= coalesce(titled, last)), any_value(f.group_key)) AS code, string_agg(part, chr(10) ORDER BY place) AS body
    FROM f JOIN p ON p.group_type = f.group_type AND p.group_key = f.group_key GROUP BY f.group_type, f.group_key),
  w AS (SELECT *, CASE WHEN title = '' THEN code WHEN title <> code THEN title || ' — ' || code ELSE title END AS shown FROM h)
SELECT group_type, group_key, substr(regexp_replace(group_key, '[^A-Za-z0-9_.-]', '_', 'g'), 1, 120) AS file,
  '---' || chr(10) || 'title: "' || shown || '"' || chr(10) || 'course_code: "' || code || '"' || chr(10) || CASE WHEN title <> '' THEN 'course_title: "' || title || '"' || chr(10) ELSE '' END || '---' || {end}
    || '# ' || shown || {end} || body AS markdown FROM w"""


ORACLES |= {
    "lit_resource_links": f"SELECT page_id, pos, tag, url, text, title FROM {L('exp_resource_links')}",
    "lit_links_per_tag": f"SELECT tag, count(*) AS n FROM {EXTRACTED} GROUP BY tag",
    "lit_anchor_links": f"SELECT * FROM {L('exp_anchor_links')}",
    "lit_page_files": f"SELECT * FROM {L('exp_files')}",
    "lit_blocks": f"SELECT * FROM {L('exp_blocks')}",
    "lit_materials": f"SELECT * FROM {L('exp_materials')}",
    "lit_model_materials": f"SELECT * FROM {L('exp_model_materials')}",
    "lit_course_table": f"SELECT * FROM {L('exp_course_rows')}",
    "lit_markdown": f"SELECT * FROM {L('exp_markdown')}",
    "lit_crawl": f"WITH RECURSIVE {CRAWLED} SELECT bucket, url, depth::INTEGER AS depth FROM bk",
    "lit_crawl_resumed": f"WITH RECURSIVE {CRAWLED} SELECT bucket, url, depth::INTEGER AS depth FROM bk WHERE bucket NOT IN ('all_extracted', 'external', 'file', 'inaccessible')",
    "lit_crawl_json": f"""WITH RECURSIVE {CRAWLED} SELECT 'https://site.example.edu/' AS base_url, (SELECT count(*) FROM v) AS n_visited, (SELECT count(*) FROM v) AS total_visited,
  {number_of('all_extracted')} AS total_links_extracted, {number_of('all_extracted')} - {number_of('external')} AS same_domain_links, {number_of('external')} AS external_links, {number_of('course_page')} AS course_pages,
  {number_of('course_relevant')} AS course_relevant, {number_of('back_link')} AS back_links, {number_of('irrelevant')} AS irrelevant, {number_of('file')} AS file_links, {number_of('inaccessible')} AS inaccessible""",
    # the one candidate with a page has no code that stands alone in its readable text, and links
    "lit_crawl_verified": f"""WITH RECURSIVE {CRAWLED} SELECT b.url, CASE WHEN p.html IS NULL THEN 'inaccessible' ELSE 'course_relevant' END AS action, CASE WHEN p.html IS NOT NULL THEN 'course_page' END AS reclassified_from,
  CASE WHEN p.html IS NOT NULL THEN 'has_other_course_links' END AS reason,
  CASE WHEN p.html IS NULL THEN 'Content verification failed – page may be inaccessible (forbidden or no response)' END AS error FROM bk b LEFT JOIN {L('lit_html')} p USING (url) WHERE bucket = 'course_page'""",
    "lit_crawl_summary": f"WITH RECURSIVE {CRAWLED} {_SUMMARIES}",
    "lit_course_pages": f"""SELECT (id % 3)::BIGINT AS page_id, url, CASE WHEN {back_link('url', 'text')} THEN 'back_link' WHEN NOT {_INDICATORS} THEN 'irrelevant' WHEN {_CODE_TEXT} THEN 'course_page'
  WHEN {has("(lower(url) || ' ' || lower(coalesce(text, '')))", ('course', 'teaching', 'syllabus', 'lecture', 'semester', 'class'))} THEN 'course_relevant' ELSE 'irrelevant' END AS bucket,
  CASE WHEN {back_link('url', 'text')} OR NOT {_INDICATORS} THEN 'heuristic' ELSE 'model' END AS method FROM {L('lit_links')}""",
    "json_answers": f"SELECT * FROM {L('exp_answers')}",
    "key_lists": f"SELECT * FROM {L('exp_keys')}",
    "csv_course_rows": f"SELECT url, coalesce(course_code, '') AS course_code, coalesce(course_title, '') AS course_title, coalesce(year, '') AS year FROM {L('lit_course_rows')}",
    "csv_url_list": "SELECT DISTINCT replace(url, 'http://', 'https://') AS url FROM pages",
    "csv_course_table": f"""SELECT url, course_title, manual_page_type, ai_page_type, ai_confidence, 'false' AS has_notes, (ai_of_manual <> ai_page_type)::VARCHAR AS conflict_flag,
  (ai_of_manual <> ai_page_type OR ai_confidence = 'low')::VARCHAR AS recheck_needed, '[]' AS all_files_json FROM {_COURSE_ROWS}""",
    "json_cache": """SELECT 'https://h/' || c_custkey AS cache_key, c_nationkey = 1 AS is_back_link, c_acctbal > 0 AS is_course_page, true AS is_course_relevant, ((c_custkey % 10) / 10)::DOUBLE AS confidence, c_mktsegment AS reasoning FROM customer""",
    "json_course_pages": "SELECT 'https://h/' || n_name AS url FROM nation",
    "files_by_group": f"""SELECT regexp_replace(group_key, '[^A-Za-z0-9_.-]', '_', 'g') || '.index.json' AS file, index, url, nullif(c, '') AS course_code, nullif(t, '') AS course_title, nullif(trim(semester), '') AS semester, nullif(trim(year), '') AS year
  FROM (SELECT *, (row_number() OVER (PARTITION BY group_type, group_key ORDER BY year_int DESC, idx))::INTEGER AS index FROM (SELECT *, {year_int("coalesce(nullif(year, ''), nullif(semester, ''))")} AS year_int FROM {grouped(L('lit_groups'))}))""",
    "failed_urls_shown": shown("(SELECT row_number() OVER (ORDER BY page_id) AS place, url AS line FROM pages WHERE page_id % 7 = 0)", 20),
    "head_of_courses": f"WITH RECURSIVE {components(PAGE_ROWS)}, {CANONICAL} SELECT idx, canonical_code AS course_code, canonical_title AS course_title FROM cr JOIN cn USING (component) ORDER BY idx LIMIT 20",
    "manual_fields": f"SELECT page_id, course_code, course_title, year, manual_page_type, 0::BIGINT AS n_files, n_internal::BIGINT AS n_internal FROM {_COURSE_ROWS}",
    "analyze_pages": f"""SELECT url, course_code, nullif(course_title, '') AS course_title, semester, year, manual_page_type, ai_page_type, ai_confidence, 'rules' AS ai_reasoning, false AS has_notes, 'no_notes' AS notes_type, '' AS notes_details,
  false AS further_course_related_data_present, false AS has_syllabus_or_logistics, course_code IS NOT NULL AS is_useful, ai_of_manual <> ai_page_type AS conflict_flag,
  ai_of_manual <> ai_page_type OR ai_confidence = 'low' AS recheck_needed, '[]' AS all_files_json, links_json AS all_internal_links_json FROM {_COURSE_ROWS}""",
    # no page of the table has a material file or inline code
    "page_materials": f"""SELECT page_id, NULL::VARCHAR AS url, pos::INTEGER AS pos, NULL::VARCHAR AS item_type, text AS title, text AS snippet, href AS file_url, 'medium' AS confidence
  FROM {ANCHORS} WHERE {ends('lower(href)', MATERIAL_FILES)}""",
    "generate_pages": markdown(
        f"SELECT *, row_number() OVER (PARTITION BY group_type, group_key ORDER BY year_int DESC, idx) AS place, year AS label FROM (SELECT *, {year_int('year')} AS year_int FROM {grouped(PAGE_ROWS)})",
        "SELECT NULL::VARCHAR AS group_type, NULL::VARCHAR AS group_key, 0 AS place, NULL::VARCHAR AS body WHERE false",
    ),
    "render_markdown": markdown(
        f"""SELECT *, row_number() OVER (PARTITION BY group_type, group_key ORDER BY year_int DESC, idx) AS place, {_LABEL} AS label
  FROM (SELECT *, {year_int("coalesce(nullif(year, ''), nullif(semester, ''))")} AS year_int FROM {grouped(L('lit_groups'))})""",
        f"""SELECT 'course_code' AS group_type, 'CS2' AS group_key, place, string_agg('### ' || label || chr(10) || chr(10) || lines, '' ORDER BY rank) AS body FROM (
    SELECT place, rank, label, string_agg('#### [' || name || '](' || url || ')' || chr(10) || CASE WHEN trim(text) <> '' THEN '> ' || trim(text) || chr(10) ELSE '' END || chr(10), '' ORDER BY id) AS lines
    FROM (SELECT id, url, text, id % 3 + 1 AS place, {material('text', 'url')} AS kind, CASE WHEN {_GENERIC} THEN {_FRIENDLY} ELSE text END AS name FROM {L('lit_anchor')})
    JOIN (VALUES (0, 'slides', 'Lecture Slides'), (1, 'question_papers', 'Question Papers'), (2, 'tutorials', 'Tutorials & Assignments'), (3, 'example_code', 'Example Code')) AS k(rank, kind, label) USING (kind)
    GROUP BY place, rank, label) GROUP BY place""",
    ),
    # no page is linked from another, so the crawl of all pages ends where it begins
    "crawl_pages": rf"""WITH j AS (SELECT *, CASE WHEN {back_link('url', 'text')} THEN 'back_link' WHEN regexp_matches(lower(text), '\b[a-z]{{2,4}}[-_ ]?\d{{3,4}}\b') THEN 'course_page'
    WHEN {has("(lower(url) || ' ' || lower(text))", ('course', 'teaching', 'syllabus', 'lecture', 'semester', 'class'))} THEN 'course_relevant' ELSE 'irrelevant' END AS bucket FROM {LINKS} WHERE {netloc('url')} = {netloc('source_url')})
SELECT url, bucket, 0 AS depth FROM (SELECT *, row_number() OVER (PARTITION BY bucket, {page_norm('url')} ORDER BY page_id, pos) AS k2 FROM j) WHERE k2 = 1""",
}
