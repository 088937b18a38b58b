"""Pluggable outside calls (M1-M3, M6, M8, M11, M12, M18, M19, S1-S3): offline and deterministic by default.

A provider is anything with the methods of ``HeuristicProvider``. It is sent to the executors, so it
has to be picklable; sessions and rate limits are set up there, once a partition.
"""

from __future__ import annotations

import json
import re
import time
import urllib.request
from dataclasses import dataclass, field

from pagewright.config import DEFAULT, Settings

# Fixed value: what stands in for the model's answer when a call fails.
AI_FALLBACK = {
    "ai_page_type": "other", "ai_confidence": "low", "ai_reasoning": "AI call failed; defaulted to 'other'.", "course_code": None, "course_title": None,
    "semester": None, "year": None, "has_notes": False, "notes_type": "unknown", "notes_details": "", "further_course_related_data_present": False,
    "has_syllabus_or_logistics": False, "is_useful": False,
}


#: Closing braces that a cut answer may lack.
MAX_BRACES = 5


class HeuristicProvider:
    """Answers from rules, as JSON text like a model's, so that parsing is exercised offline."""

    def classify_batch(self, links: list[dict]) -> str:
        answers = []
        for link in links:
            text, url = (link.get("text") or "").lower(), (link.get("url") or "").lower()
            course = bool(re.search(r"\b[a-z]{2,4}[-_ ]?\d{3,4}\b", text))
            relevant = any(w in url + " " + text for w in ("course", "teaching", "syllabus", "lecture", "semester", "class"))
            answers.append({"is_back_link": False, "is_course_page": course, "is_course_relevant": relevant or course, "confidence": 0.9 if course else 0.7 if relevant else 0.2, "reasoning": "rules"})
        return json.dumps(answers)

    def classify(self, link: dict) -> str:
        return json.dumps(json.loads(self.classify_batch([link]))[0])

    def verify(self, url: str, content: str) -> str:
        code = re.search(r"\b([A-Z]{2,3}\s?\d{2,5})\b", content)
        return json.dumps({"is_course_page": bool(code), "confidence": 0.8 if code else 0.3, "course_code": code[1].replace(" ", "") if code else None, "has_other_course_links": not code})

    def enrich(self, page: dict) -> str:
        return json.dumps({
            "page_type": "course_page" if page.get("course_code") else "other", "confidence": "high" if page.get("course_code") else "low", "ai_reasoning": "rules",
            "course_code": page.get("course_code"), "course_title": page.get("course_title"), "semester": page.get("semester"), "year": page.get("year"),
            "has_notes": bool(page.get("all_files")), "notes_type": "files_direct" if page.get("all_files") else "no_notes", "is_useful": bool(page.get("course_code")),
        })

    def materials(self, chunk: str) -> str:
        return json.dumps({"extracted_items": [], "special_marks": []})


# What a model is asked; the fields of its answers are those that the parsers read.
PROMPTS = {
    "classify_batch": "Classify each link of a university site. Answer with a JSON array that has one object for each link, in order, with the fields "
    "is_back_link, is_course_page, is_course_relevant (true or false), confidence (0 to 1) and reasoning.\n\nLinks:\n{{links}}",
    "classify": "Classify this link of a university site. Answer with a JSON object with the fields is_back_link, is_course_page, is_course_relevant "
    "(true or false), confidence (0 to 1) and reasoning.\n\nUrl: {{url}}\nText: {{text}}",
    "verify": "Is this the page of one course? Answer with a JSON object with the fields is_course_page, confidence, course_code, course_name, semester, "
    "reasoning and has_other_course_links.\n\nUrl: {{url}}\n\n{{content}}",
    "enrich": "Complete what was read from a course page. Answer with a JSON object with the fields page_type, confidence, ai_reasoning, course_code, "
    "course_title, semester, year, has_notes, notes_type, notes_details, further_course_related_data_present, has_syllabus_or_logistics and is_useful."
    "\n\nRead so far:\n{{fields}}\n\nPage:\n{{html}}",
    "materials": "List the learning materials in this part of a page. Answer with a JSON object with the field extracted_items, an array of objects with the "
    "fields item_type, title, snippet, file_url and confidence.\n\n{{chunk}}",
}


def batch_prompt(links: list[dict], template: str = PROMPTS["classify_batch"]) -> str:
    """M2: the links of a batch, numbered from 1, in the template."""
    listed = [f"{k}. Url: {link.get('url') or ''}\n   Text: {link.get('text') or ''}" for k, link in enumerate(links, 1)]
    return render(template, {"links": "\n".join(listed)})


@dataclass
class HttpProvider:
    """A chat endpoint that takes and gives JSON (``messages`` and ``choices``); a time-out raises ``TimeoutError``.

    ``post(url, body, headers, timeout_s) -> bytes`` sends a request; by default the standard library does.
    """

    endpoint: str
    model: str
    keys: KeyRing
    settings: Settings = DEFAULT
    prompts: dict[str, str] = field(default_factory=lambda: dict(PROMPTS))
    post: object = None

    def ask(self, prompt: str) -> str:
        key = self.keys.next()
        body = json.dumps({"model": self.model, "messages": [{"role": "user", "content": prompt}], "temperature": 0, "stream": False}).encode()
        headers = {"Content-Type": "application/json", "Accept": "application/json", "Authorization": f"Bearer {key}"}
        try:
            answer = json.loads((self.post or post_json)(self.endpoint, body, headers, self.settings.batch_timeout_s))
            text = answer["choices"][0]["message"]["content"]
        except Exception:
            self.keys.report(key, False)
            raise
        self.keys.report(key, True)
        return text

    def classify_batch(self, links: list[dict]) -> str:
        return self.ask(batch_prompt(links, self.prompts["classify_batch"]))

    def classify(self, link: dict) -> str:
        return self.ask(render(self.prompts["classify"], {"url": link.get("url") or "", "text": link.get("text") or ""}))

    def verify(self, url: str, content: str) -> str:
        return self.ask(render(self.prompts["verify"], {"url": url, "content": content}))

    def enrich(self, page: dict) -> str:
        fields = {k: v for k, v in page.items() if k not in ("html", "page_id")}
        return self.ask(render(self.prompts["enrich"], {"fields": json.dumps(fields, default=str), "html": (page.get("html") or "")[: self.settings.content_chars]}))

    def materials(self, chunk: str) -> str:
        return self.ask(render(self.prompts["materials"], {"chunk": chunk}))


def post_json(url: str, body: bytes, headers: dict, timeout_s: float) -> bytes:
    request = urllib.request.Request(url, data=body, headers=headers)
    with urllib.request.urlopen(request, timeout=timeout_s) as answer:
        return answer.read()


@dataclass
class HttpFetch:
    """A page's text by GET; errors of any kind are raised. Without a stated encoding it is found from the bytes."""

    timeout_s: float = DEFAULT.timeout_s
    agent: str = "Mozilla/5.0 (compatible; pagewright)"
    open: object = None

    def __call__(self, url: str) -> str:
        request = urllib.request.Request(url, headers={"User-Agent": self.agent})
        with (self.open or urllib.request.urlopen)(request, timeout=self.timeout_s) as answer:
            return decoded(answer.read(), answer.headers.get_content_charset())


def decoded(data: bytes, stated: str | None = None) -> str:
    """Text of a page: by its byte order mark, the stated encoding, its own ``charset``, UTF-8, or else Windows-1252."""
    own = re.search(rb"charset=[\"']?([A-Za-z0-9_.:-]+)", data[:4096])
    marked = "utf-8-sig" if data.startswith(b"\xef\xbb\xbf") else "utf-16" if data[:2] in (b"\xff\xfe", b"\xfe\xff") else None
    for name in (marked, stated, own and own[1].decode(), "utf-8"):
        try:
            if name:
                return data.decode(name)
        except (UnicodeDecodeError, LookupError):
            continue
    return data.decode("cp1252", "replace")


@dataclass
class RetryingProvider:
    """Wraps a provider: retries after time-outs with linear waits, and keeps to a pace.

    Calls follow each other by ``batch_gap_s`` (batches) or ``delay_s`` at least. ``sleep`` is a
    parameter, so that tests need not wait. Errors other than time-outs are not retried.
    """

    inner: object
    settings: Settings = DEFAULT
    wait_s: float = 5.0
    sleep: object = time.sleep
    calls: int = 0

    def call(self, method: str, *args) -> str:
        if self.calls:
            self.sleep(self.settings.batch_gap_s if method == "classify_batch" else self.settings.delay_s)
        for attempt in range(self.settings.max_retries + 1):
            try:
                self.calls += 1
                return getattr(self.inner, method)(*args)
            except TimeoutError:
                if attempt == self.settings.max_retries:
                    raise
                self.sleep(self.wait_s * (attempt + 1))
        raise AssertionError

    def classify_batch(self, links: list[dict]) -> str:
        return self.call("classify_batch", links)

    def classify(self, link: dict) -> str:
        return self.call("classify", link)

    def verify(self, url: str, content: str) -> str:
        return self.call("verify", url, content)

    def enrich(self, page: dict) -> str:
        return self.call("enrich", page)

    def materials(self, chunk: str) -> str:
        return self.call("materials", chunk)


@dataclass
class KeyRing:
    """Keys in rotation (S12, M16-M18, A7): the second key is handed out first; a success clears a key's errors."""

    keys: list[str]
    requests: dict[str, int] = field(default_factory=dict)
    errors: dict[str, int] = field(default_factory=dict)
    n: int = 0

    @classmethod
    def from_settings(cls, values: dict[str, str], name: str = "API_KEY") -> KeyRing:
        """A comma list wins as it stands, repeats and all; else the single key and numbered ones up to the first gap, without repeats."""
        listed = [k.strip() for k in values.get(f"{name}S", "").split(",") if k.strip()]
        if listed:
            return cls(listed)
        listed = [values[name].strip()] if values.get(name, "").strip() else []
        i = 1
        while values.get(f"{name}_{i}", "").strip():
            listed.append(values[f"{name}_{i}"].strip())
            i += 1
        return cls(list(dict.fromkeys(listed)))

    def next(self) -> str:
        if not self.keys:
            raise ValueError("no keys")
        self.n += 1
        key = self.keys[self.n % len(self.keys)]
        self.requests[key] = self.requests.get(key, 0) + 1
        return key

    def report(self, key: str, ok: bool) -> None:
        self.errors[key] = 0 if ok else self.errors.get(key, 0) + 1

    def remove(self, key: str) -> bool:
        if key not in self.keys or len(self.keys) == 1:
            return False
        self.keys.remove(key)
        return True

    def has_multiple(self) -> bool:
        return len(self.keys) > 1

    def stats(self) -> dict:
        requests, errors = sum(self.requests.values()), sum(self.errors.values())
        return {"total_keys": len(self.keys), "total_requests": requests, "total_errors": errors, "usage_per_key": dict(self.requests), "error_rate": errors / requests if requests else 0.0}


def _missing_braces(text: str) -> int:
    """How many objects are open where a JSON text ends; 0 if it ends inside a string or an array."""
    depth, quoted, at = [], False, 0
    while at < len(text):
        ch = text[at]
        if quoted:
            at += ch == "\\"
            quoted = ch != '"'
        elif ch == '"':
            quoted = True
        elif ch in "{[":
            depth.append(ch)
        elif ch in "}]" and depth:
            depth.pop()
        at += 1
    return 0 if quoted or "[" in depth else len(depth)


def parse_json_ladder(text: str) -> dict:
    """The JSON of an answer; else ``ValueError``.

    Taken in turn: all of it, what a code fence holds, from the first brace to the last, and from the
    first brace on with up to ``MAX_BRACES`` closing ones added.
    """
    bare = "".join(line for line in re.split(r"(```(?:json)?)", text) if not line.startswith("```")).strip(" \n\r\t`")
    first, last = bare.find("{"), bare.rfind("}")
    attempts = [text, bare]
    if first >= 0:
        attempts.append(bare[first : last + 1])
        missing = _missing_braces(bare[first:])
        if missing <= MAX_BRACES:
            attempts.append(bare[first:] + "}" * missing)
    for attempt in attempts:
        try:
            return json.loads(attempt)
        except ValueError:
            continue
    raise ValueError(f"an answer without JSON: {text[:400]!r}")


def ai_fields(answer: str | None) -> dict:
    """The model's fields with their types; the fallback if the answer cannot be read."""
    try:
        read = parse_json_ladder(answer)
        text = lambda key, other: str(read.get(key, other))
        flag = lambda key: bool(read.get(key, False))
        some = lambda key: None if not read.get(key) else str(read[key])
        return {
            "ai_page_type": text("page_type", "other"), "ai_confidence": text("confidence", "low"), "ai_reasoning": text("ai_reasoning", ""),
            "course_code": some("course_code"), "course_title": some("course_title"), "semester": some("semester"), "year": some("year"),
            "has_notes": flag("has_notes"), "notes_type": text("notes_type", "unknown"), "notes_details": text("notes_details", ""),
            "further_course_related_data_present": flag("further_course_related_data_present"), "has_syllabus_or_logistics": flag("has_syllabus_or_logistics"),
            "is_useful": flag("is_useful"),
        }
    except (ValueError, TypeError, AttributeError):
        return dict(AI_FALLBACK)


def render(template: str, values: dict[str, str]) -> str:
    """Placeholders ``{{name}}`` replaced as they stand."""
    for name, value in values.items():
        template = template.replace("{{" + name + "}}", value)
    return template
