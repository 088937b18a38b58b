"""Odd tables: clashing names, nulls, repeats, emptiness, hot groups, more rounds; held-out scores against a fair base."""

import math
import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pytest
import test_minhash
from pagewright.llm import embed_dedup, exact_dedup, lang_id, lm_score, minhash, mixing
from pyspark.sql import functions as F
from test_native import ROWS, SCHEMA, brute_dedup
from test_python_operators import brute_links, language_rows

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["size", "target", "taken", "repeats", "u", "of", "bin", "lang_pred", "score", "held_out", "share", "hash", "rank", "gram", "n", "digest", "file", "kept", "print", "id", "component"]


def clashing(docs):
    for name in CLASHES:
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def odd_documents(spark):
    rng = random.Random(1)
    rows = [(i, t, lang, f"s{i % 3}", 1) for i, t, lang in language_rows(60)]
    rows += [(None, "the house of stone", "aa", None, None), (None, None, None, None, None), (3, rows[3][1], "bb", "s0", 1), (3, rows[3][1], "bb", "s0", 1), (70, "", "aa", None, 0)]
    rows += [(71, " ".join(rng.choice(["the", "und", "stein"]) for _ in range(60_000)), "bb", "s1", 1), (72, " \t\n", None, "s2", 1), (73, "12 34", "aa", "s2", 1)]
    return spark.createDataFrame(rows, DOCUMENTS)


def test_every_stage_takes_odd_tables(spark):
    for docs in (odd_documents(spark), odd_documents(spark).limit(0), clashing(odd_documents(spark))):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            before = docs.count()
            docs = stage(spark, docs, "")
            if name != "encoding":
                assert docs.columns == columns and docs.count() <= 2 * before
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]


def test_languages_decide_the_first_stage(spark):
    docs = odd_documents(spark)
    judged = lang_id.identify(docs, train=docs).collect()
    stay = Counter(r.doc_id for r in judged if r.lang_pred != "und" and r.score >= lang_id.MIN_SCORE)
    assert Counter(r.doc_id for r in lang_id.keep_known(docs).collect()) == stay
    assert Counter(r.doc_id for r in lang_id.keep_known(docs, min_score=0.999).collect()) == Counter(r.doc_id for r in judged if r.lang_pred != "und" and r.score >= 0.999)


def test_clashing_names_change_nothing(spark):
    plain, odd = odd_documents(spark), clashing(odd_documents(spark))
    for operator in (mixing.mix, lang_id.identify, exact_dedup.exact_dedup, minhash.near_duplicates):
        first, second = operator(plain), operator(odd)
        assert first.columns == second.columns
        assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))


def test_hot_groups_of_equal_texts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 2)
    rows = ROWS + [(100 + i, "hot  text" if i % 2 else "hot text") for i in range(40)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    got = exact_dedup.exact_dedup(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=str) == brute_dedup(rows)


def test_settings_of_the_stream_are_its_own(spark):
    before = {r["key"]: r["value"] for r in spark.sql("SET").collect()}
    exact_dedup.exact_dedup(odd_documents(spark)).count()
    assert {r["key"]: r["value"] for r in spark.sql("SET").collect()} == before


def test_vectors_in_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "ROUND_BYTES", 1)
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = rng.standard_normal(12)
    rows = [(i, rng.standard_normal(12).tolist()) for i in range(40)] + [(100 + i, (base + rng.standard_normal(12) * 0.3).tolist()) for i in range(50)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == brute_links(rows, 0.9)


def test_blocks_of_few_shingles(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 2)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 300)
    rows = list(enumerate(test_minhash.near_copies(60, 80, 7)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == test_minhash.brute(rows, 3, 85)


def test_overlaps_are_exact():
    left = [np.arange(0, 3_000_000, dtype=np.int64)]
    right = [np.arange(1, 2_900_002, dtype=np.int64)]
    assert minhash._overlaps(left, right).tolist() == [[2_900_001]]


def test_held_out_texts_score_above_a_fair_base(spark):
    """The base with its unseen mass dealt over spelled words: a word's characters by their frequencies in training words."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = Counter(w for i, t in rows if i not in held for w in (t or "").encode().lower().split())
    kinds = list(counts)
    letters = Counter(b for w in kinds for b in w)
    letters[-1] = len(kinds)  # a word's end
    total, n, singles = sum(letters.values()), sum(counts.values()), sum(c == 1 for c in counts.values())
    novel, ends = singles / n, len(rows) - len(held)

    def fair(word):
        spelled = sum(math.log10((letters[b] + 1) / (total + 257)) for b in word) + math.log10(letters[-1] / total)
        return math.log10((1 - novel) * counts[word] / n) if counts[word] else math.log10(novel) + spelled

    more = (n + 1) / (n + ends + 2)
    base = {i: sum(fair(w) + math.log10(more) for w in (t or "").encode().lower().split()) + math.log10(1 - more) for i, t in rows if i in held}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_score.score(docs, P.path("piece_bpe_32k.model")).collect()}
    assert sum(got[i] for i in held) > sum(base.values())


@pytest.mark.parametrize("n", [50_000, 500_000, 5_000_000])
def test_rounds_keep_disk_in_bounds(n):
    row = 64 * 4 + 32
    _, tables = embed_dedup.parameters(n, 0.9)
    together = max(1, embed_dedup.ROUND_BYTES // (n * row))
    assert min(tables, together) * n * row <= max(embed_dedup.ROUND_BYTES, n * row)
