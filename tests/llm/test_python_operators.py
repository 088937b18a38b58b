"""WARC, embeddings, html text, language identification, token counts and BPE against brute force or round trips."""

import base64
import hashlib
import html
import io
import random
import re
import struct
import zipfile

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pagewright.llm import bpe, embed_dedup, html_text, lang_id, token_counts, warc
from pyspark.sql import functions as F

PAGES = "page_id long, url string, html string, payload string, refers_to string, n_chars string"


def test_warc_round_trip(spark):
    bodies = ["<p>é</p>", "<p>é</p>", "", None, "x" * 300_000, "<p>é</p>", "a\r\n\r\nb", "\n"]
    rows = [(i + 3, f"https://h/{i} x", h, None, "", "") for i, h in enumerate(bodies)] + [(3, "again", bodies[0], "", "", ""), (None, None, bodies[0], "", "", ""), (None, "n", "alone", "", "", "")]
    pages = spark.createDataFrame(rows, PAGES)
    path = warc.scratch.path(spark, "test-warc")
    warc.write(pages, path, archive_bytes=1000)
    got = warc.read(spark, path, payload=True).collect()
    first = {}
    for i, _, h, *_ in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h, *_ in rows:
        data, lead = (h or "").encode(), first.get(h or "")
        again = lead is not None and i != lead
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", lead if again else None, None if again else data))
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert spark.read.format("binaryFile").load(path).count() > 1
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_archives_are_zip_files_that_ranges_lead_through():
    records = [(f"https://h/{i}", warc.record(i, f"https://h/{i}", b"p%d" % i * i, None, False)) for i in range(50)]
    for zip64 in (False, True):
        data = warc.pack(records, zip64) + b"\n"
        with zipfile.ZipFile(io.BytesIO(data)) as archive:
            assert archive.testzip() is None and archive.namelist() == [warc.WARC_MEMBER, warc.INDEX_MEMBER]
        file = warc.Ranges("", data)
        found = [warc.parse(file.read(o, n)) for o, n in sorted(warc.locate(file))]
        assert [(r["page_id"], r["payload"]) for r in found] == [(i, b"p%d" % i * i) for i in range(50)]
        start, size = next((o, n) for name, _, o, n in warc.members(file) if name == warc.WARC_MEMBER)
        assert list(warc._walk(file, start, start + size)) == sorted(warc.locate(file))


def test_zip64_directory():
    """A directory whose counts and offsets stand in the ZIP64 records only."""
    data = warc.pack([("u", warc.record(1, "u", b"x", None, False))]) + b"\n"
    at = data.rindex(b"PK\x05\x06")
    count, size, offset = struct.unpack_from("<HII", data, at + 10)
    record = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, count, count, size, offset)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at, 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    file = warc.Ranges("", data[:at] + record + locator + end)
    assert [m[0] for m in warc.members(file)] == [warc.WARC_MEMBER, warc.INDEX_MEMBER]
    broken = bytearray(warc.record(1, "u", b"x" * 50, None, False))
    raw = warc.gzip.decompress(bytes(broken)).replace(b"x" * 50, b"y" * 50)
    with pytest.raises(ValueError, match="digest"):
        warc.parse(raw)


def brute_links(rows, cosine):
    good = {i: np.array(v, dtype=float) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = sorted(good)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= cosine]
    n, label = dict.fromkeys([i for i, _ in rows], 0), {i: i for i, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    for _ in rows:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {i: (n[i], label[i], label[i] == i) for i, _ in rows}


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 20)
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(60)]
    base = rng.standard_normal(16)
    rows += [(100 + i, (base * rng.uniform(0.1, 1e6) + 0).tolist()) for i in range(5)] + [(200 + i, base.tolist()) for i in range(40)]
    rows += [(300 + i, (base + rng.standard_normal(16) * 0.25).tolist()) for i in range(90)]
    rows += [(500, None), (501, [0.0] * 16), (502, [None] + [1.0] * 15), (503, [float("nan")] + [1.0] * 15), (504, [float("inf")] + [1.0] * 15), (505, []), (506, [-0.0] * 15 + [1.0]), (507, [0.0] * 15 + [2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("clash"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(vectors).collect()}
    assert got == brute_links(rows, 0.9)


def test_embeddings_of_nothing(spark):
    schema = "vec_id long, embedding array<float>"
    assert embed_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    assert embed_dedup.near_duplicates(spark.createDataFrame([(1, None), (None, [1.0])], schema)).count() == 2


def test_hash_parameters():
    for n in (100, 50_000, 10**9):
        k, l = embed_dedup.parameters(n, 0.9)
        assert (1 - embed_dedup.collision(np.sqrt(0.2)) ** k) ** l <= embed_dedup.MISS
        assert n * embed_dedup.collision(np.sqrt(2)) ** k <= embed_dedup.FILL or k == 4


FURNITURE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><p>a tagline that is long enough to count as text of its own</p></header>
<nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav><div class="cookie-notice"><p>We use cookies and so on, please accept all of them now.</p></div>
<div id="sidebar"><p>Side text which goes on and on for a while, really.</p></div><main><article><h1>Title &amp; more</h1><p>First   para with <b>bold</b>text &eacute;.<p>Second one.
<ul><li>item one<li>item two</ul><div class="ad">Buy now!</div><form><label>Name</label></form><script>var p="</p>";</script><p>Last</p></article>
<section id="comments"><article class="comment"><p>A reader says something long and windy about the article above, again.</p></article></section></main><footer>&copy; x</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(FURNITURE) == "Title & more First para with boldtext é. Second one. item one item two Last"
    for odd in (None, "", "<", "<p>", "<!-- x -->", "</div>" * 50, "<script>x"):
        assert html_text.main_text(odd) in ("", "<")
    assert html_text.main_text("just text") == "just text"
    long = "<article>" + "<p>word word word word</p>" * 20_000 + "</article>"
    assert len(html_text.main_text(long)) == 20_000 * 20 - 1
    plain = '<div class="menu"><a href=1>x</a></div><div><h2>Head</h2><p>A long paragraph of real text that is found by its ratio, because it is long.</p><p>short</p><p>Another long paragraph of text, found by ratio as well.</p></div><div><a href=2>one</a></div>'
    assert html_text.main_text(plain).startswith("Head A long") and html_text.main_text(plain).endswith("as well.") and " short " in html_text.main_text(plain)


def test_main_text_is_the_article_of_the_pages(spark):
    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.DOTALL).group(1)
        article = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", article))
        assert html_text.main_text(row.html) == " ".join(html.unescape(article).split())


def test_main_text_of_pages(spark):
    rows = spark.createDataFrame([(1, "u", FURNITURE, "", "", ""), (None, None, None, None, None, None), (1, "u", FURNITURE, "", "", "")], PAGES)
    got = html_text.extract(rows).collect()
    assert len(got) == 3 and all(r.n_chars == len(r.text) for r in got) and sum(r.text == "" for r in got) == 1


WORDS = {"aa": "the of and house water stone".split(), "bb": "der und ist wasser stein haus".split()}


def language_rows(n):
    rng = random.Random(4)
    return [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randrange(3, 60))), lang) for i in range(n) for lang in [rng.choice(sorted(WORDS))]]


def test_language(spark):
    rows = language_rows(300) + [(1000, None, "aa"), (1001, "123 !?", "bb"), (1002, "", None), (None, "the house", None), (1003, "der Stein " * 20_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in lang_id.identify(docs).collect()}
    wrong = [i for i, t, lang in rows if lang and t and i < 1000 and got[i].lang_pred != lang]
    assert not wrong and [got[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "bb", "aa"]
    assert all(0 <= r.score <= 1 and (r.held_out == (lang_id_crc(r.doc_id) % 4 == 2)) for r in got.values())
    assert {r.doc_id for r in lang_id.keep_known(docs).collect()} == {i for i, t, _ in rows if t and any(map(str.isalpha, t))}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lang_id.identify(unlabelled).collect()} == {"und"} and lang_id.keep_known(unlabelled).count() == lang_id.keep_known(docs).count()
    assert lang_id.identify(docs.limit(0)).count() == 0


def lang_id_crc(doc_id):
    import zlib

    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def test_code_lengths_against_plain_ppm():
    counts = {}
    for lang, words in WORDS.items():
        text = lang_id.fold((" ".join(words) + " ").encode() * 3)
        data = b" " * lang_id.ORDER + text
        grams = {}
        for i in range(len(text)):
            grams[data[i : i + lang_id.ORDER + 1]] = grams.get(data[i : i + lang_id.ORDER + 1], 0) + 1
        counts[lang] = grams
    model = lang_id.build(counts)

    def bits(grams, text):
        tree = {}
        for gram, n in grams.items():
            for cut in range(lang_id.ORDER + 1):
                own = tree.setdefault(gram[cut : lang_id.ORDER], {})
                own[gram[-1:]] = own.get(gram[-1:], 0) + n
        data, total = b" " * lang_id.ORDER + text, 0.0
        for i in range(len(text)):
            context, symbol = data[i : i + lang_id.ORDER], data[i + lang_id.ORDER : i + lang_id.ORDER + 1]
            while True:
                own = tree.get(context)
                if own:
                    times, kinds = sum(own.values()), len(own)
                    if symbol in own:
                        total -= np.log2(own[symbol] / (times + kinds))
                        break
                    total -= np.log2(kinds / (times + kinds))
                if not context:
                    total += np.log2(model.size)
                    break
                context = context[1:]
        return total

    texts = [b"the house und stein of", b"zzz the", b"a", b"wasser " * 400]
    folded = [lang_id.fold(t) for t in texts]
    want = [[bits(counts[lang], t) for lang in model.langs] for t in folded]
    assert np.allclose(lang_id.code_lengths(texts, model), want)


def greedy(text, vocabulary, longest):
    n = i = 0
    while i < len(text):
        k = next((k for k in range(min(longest, len(text) - i), 0, -1) if text[i : i + k] in vocabulary), 0)
        n, i = (n + 1, i + k) if k else (n + len(text[i].encode()), i + 1)
    return n


def test_token_counts(spark):
    rng = random.Random(0)
    for _ in range(200):
        vocabulary = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(8)}
        automaton = token_counts.Automaton(vocabulary)
        for _ in range(30):
            word = "".join(rng.choice("abcé") for _ in range(rng.randint(0, 15)))
            assert automaton.count(word) == greedy(word, vocabulary, 6)
    model = P.path("piece_bpe_32k.model")
    pieces = set(token_counts.model_pieces(model))
    texts = ["The house, 中文 naïve", None, "", " \t", "x" * 20_000, "▁a ▁", "a\x00b"]
    docs = spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)] + [(None, "a", ""), (0, texts[0], "")], "doc_id long, text string, n_tokens string")
    got = sorted(((r.doc_id if r.doc_id is not None else 99, r.n_words, r.n_tokens) for r in token_counts.token_counts(docs, model).collect()))
    count = lambda t: sum(greedy("▁" + w.decode(), pieces, 40) for w in (t or "").encode().split())
    assert got == sorted([(i, len((t or "").encode().split()), count(t)) for i, t in enumerate(texts)] + [(99, 1, count("a")), (0, 4, count(texts[0]))])


def test_bpe_as_the_library(spark):
    path = P.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    texts = ["".join(rng.choice("aabbcc eé中 \n\t'st<|endoftext|>😀") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    texts += ["a" * 5000, " " * 3000, "", None, "ab" * 4000, "abcabcab" * 500, "\u0000 "]
    docs = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], "doc_id long, text string, ids string, n_tokens string")
    got = {r.doc_id: r for r in bpe.encode_documents(docs, path, P.PATTERN).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert (got[i].ids, got[i].n_tokens) == (ids, len(ids))
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest() and got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_replay_takes_up_lower_ranks_first():
    """Ranks in no order of merging: the rank-greedy loop decides."""
    rng = random.Random(5)
    for _ in range(150):
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 268:
            tokens.add(rng.choice(sorted(t for t in tokens if set(t) <= set(b"abc"))) + rng.choice(sorted(t for t in tokens if set(t) <= set(b"abc"))))
        order = sorted(tokens)
        rng.shuffle(order)
        ranks = {t: i for i, t in enumerate(order)}
        pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14))) for _ in range(20)]
        got = bpe.replay(pieces, [ranks[bytes([b])] for b in range(256)], bpe.pair_ranks(ranks))
        for piece, ids in zip(pieces, got, strict=True):
            parts = [piece[i : i + 1] for i in range(len(piece))]
            while True:
                best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
                if best is None:
                    break
                parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            assert ids == [ranks[p] for p in parts]
