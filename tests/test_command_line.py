"""The command line over a small site, and outside calls with their transport replaced."""

import io
import json
import pickle

import pytest
from pagewright.__main__ import main
from pagewright.config import Settings
from pagewright.plans.literals import frame
from pagewright.providers import HttpFetch, HttpProvider, KeyRing, RetryingProvider, batch_prompt, decoded
from pagewright.sources import tables

SITE = "https://site.example.edu/cs"


def test_all_stages(spark, tmp_path, capsys):
    frame(spark, "lit_html").write.parquet(f"{tmp_path}/pages")
    assert main(["crawl", "--url", f"{SITE}/cs102.html", "--pages", f"{tmp_path}/pages", "--output", f"{tmp_path}/crawl", "--state", f"{tmp_path}/state", "--depth", "3"]) == 0
    found = spark.read.parquet(f"{tmp_path}/crawl/links")
    assert {r.url for r in found.where("bucket = 'course_page'").collect()} == {"https://site.example.edu/course/cs103", "https://site.example.edu/course/cs104"}
    assert "course_relevant" in capsys.readouterr().out
    assert main(["analyze", "--pages", f"{tmp_path}/pages", "--output", f"{tmp_path}/rows"]) == 0
    assert "attempted: 5, processed: 3, failed: 2" in capsys.readouterr().out
    assert main(["resolve", "--input", f"{tmp_path}/rows", "--output", f"{tmp_path}/clean"]) == 0
    assert main(["generate", "--input", f"{tmp_path}/none", "--input", f"{tmp_path}/clean", "--pages", f"{tmp_path}/pages", "--output", f"{tmp_path}/md", "--no-llm"]) == 0
    text = "".join(r.value + "\n" for r in spark.read.text(f"{tmp_path}/md/md/file=CS102.md").collect())
    assert "Lecture 1" in text and "inline code snippet" in text
    assert main(["generate", "--input", f"{tmp_path}/none"]) == 2
    assert main(["generate", "--input", f"{tmp_path}/clean", "--dry-run"]) == 0


def test_pages_by_http(spark):
    class Answer(io.BytesIO):  # here, so that workers need not import this module
        @property
        def headers(self):
            return self

        def get_content_charset(self):
            return "latin-1"

    def opened(request, timeout):
        if "bad" in request.full_url:
            raise OSError("refused")
        return Answer("<p>é</p>".encode("latin-1"))

    urls = spark.createDataFrame([("https://h/ok",), ("https://h/bad",)], "url string")
    rows = tables.fetched(urls, HttpFetch(open=opened), retries=0).collect()
    assert {r.url: (r.html, r.error) for r in rows} == {"https://h/ok": ("<p>é</p>", None), "https://h/bad": (None, "refused")}


def test_encodings():
    assert decoded("é".encode()) == decoded("é".encode("cp1252")) == decoded(b"\xef\xbb\xbf" + "é".encode()) == "é"
    assert decoded("é".encode("utf-16")) == "é" and decoded("é".encode("latin-1"), "latin-1") == "é" and decoded(b"x", "no-such") == "x"
    assert decoded('<meta charset="iso-8859-2">ł'.encode("iso-8859-2")).endswith("ł")


def test_model_by_http():
    sent = []

    def post(url, body, headers, timeout):
        sent.append((url, json.loads(body), headers["Authorization"]))
        if len(sent) == 3:
            raise TimeoutError
        return json.dumps({"choices": [{"message": {"content": "answer"}}]}).encode()

    waits = []
    provider = HttpProvider("https://m/v1", "small", KeyRing(["a", "b"]), Settings(batch_timeout_s=3.0), post=post)
    paced = RetryingProvider(provider, Settings(batch_gap_s=2.0, delay_s=1.0), sleep=waits.append)
    assert paced.classify_batch([{"url": "u1", "text": "t1"}, {"url": "u2", "text": None}]) == "answer"
    assert [s[2] for s in sent] == ["Bearer b"] and "1. Url: u1\n   Text: t1\n2. Url: u2" in sent[0][1]["messages"][0]["content"]
    assert paced.verify("u", "content") == paced.enrich({"url": "u", "html": "x" * 9000}) == "answer"  # the second after a time-out
    assert waits == [1.0, 1.0, 5.0] and provider.keys.errors == {"a": 0, "b": 1}
    assert len(sent[-1][1]["messages"][0]["content"]) < 8700 and paced.materials("m") == paced.classify({"url": "u"}) == "answer"
    assert pickle.loads(pickle.dumps(HttpProvider("e", "m", KeyRing(["k"])))).endpoint == "e"
    assert batch_prompt([], "{{links}}") == ""
    with pytest.raises(ValueError):
        HttpProvider("e", "m", KeyRing([]), post=post).verify("u", "c")
