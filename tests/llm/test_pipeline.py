"""The stages of the pipeline against brute force, each on its own input."""

import corpus_pipeline
import public_tokenizers as P
import pytest
import test_minhash
import tiktoken
from pagewright.llm import bpe, lang_id, mixing
from test_native import norm


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    texts = test_minhash.near_copies(40, 150, 5) + ["unique text number %d with words of its own %d" % (i, i * i) for i in range(60)] + ["dup  text"] * 5 + ["dup text "] * 2 + [None, "", "12 34", "é"]
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 5}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns

    known = corpus_pipeline.language(spark, docs, folder)
    texts = {r.doc_id: r.text for r in docs.collect()}
    judged = {r.doc_id: r for r in lang_id.identify(docs, train=docs).collect()}
    assert known.columns == columns and {r.doc_id for r in known.collect()} == {i for i, r in judged.items() if r.lang_pred != "und" and r.score >= lang_id.MIN_SCORE}
    assert {i for i, r in judged.items() if r.lang_pred == "und"} == {i for i, t in texts.items() if not (t and any(map(str.isalpha, t)))}

    once = corpus_pipeline.exact(spark, known, folder)
    kept = {r.doc_id for r in once.collect()}
    groups = {}
    for r in known.collect():
        groups.setdefault(norm(r.text), []).append((-len(r.text), r.doc_id))
    assert once.columns == columns and kept == {min(g)[1] for g in groups.values()}

    near = corpus_pipeline.near(spark, once, folder)
    brute = test_minhash.brute([(r.doc_id, r.text) for r in once.collect()], 5, 80)
    assert near.columns == columns and {r.doc_id for r in near.collect()} == {i for i, (_, _, stays) in brute.items() if stays}

    mixed = corpus_pipeline.mixture(spark, near, folder)
    repeats = {r.doc_id: r.repeats for r in mixing.mix(near).collect()}
    got = [r.doc_id for r in mixed.collect()]
    assert mixed.columns == columns and all(got.count(i) == n for i, n in repeats.items()) and set(repeats.values()) <= {0, 1, 2}

    coded = corpus_pipeline.encoding(spark, mixed, folder).collect()
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as file:
        library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(file.read()), special_tokens={})
    assert sorted((r.doc_id, r.ids) for r in coded) == sorted((i, library.encode_ordinary(texts[i])) for i in got)


def test_run_is_the_stages_in_order(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "mixture", "encoding"]
    first, again = corpus_pipeline.run(spark, folder), corpus_pipeline.run(spark, folder)
    key = lambda df: sorted((r.doc_id, r.ids_sha256) for r in df.collect())
    assert key(first) == key(again) and first.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
