"""Workers hand on batches in bounded parts, and keep the table of one operator only."""

import weakref

import public_tokenizers as P
import pyarrow as pa
import pytest
from pagewright.llm import bpe, lang_id, minhash

LONG = "eine sehr lange zeile " * 150_000  # 3.3 MB, more than any part
TEXTS = [f"text {i} " + "the quick brown fox " * 100 for i in range(2_000)] + [None, "", LONG, "é", "after the long one"]


@pytest.fixture
def functions(spark, monkeypatch):
    """The function that each operator runs in its workers, with the columns that it gets and the size of its parts."""
    docs = spark.createDataFrame([], "doc_id long, text string")
    caught = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema, *more: caught.append(run) or self)
    model = lang_id.build({"de": {b"zeile": 3, b"lange": 2}, "en": {b"quick": 3, b"brown": 2}})
    monkeypatch.setattr(lang_id, "learn", lambda train: model)
    lang_id.keep_known(docs, min_score=0.0)
    minhash.signatures(docs, 5)
    minhash.shingle_sets(docs.selectExpr("doc_id AS id", "text AS print", "text"), 5)
    bpe.encode_documents(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    return dict(zip(["language", "signatures", "sets", "encoding"], caught, strict=True))


def batch(name, texts):
    ids = pa.array(range(len(texts)), pa.int64())
    own = pa.array(texts, pa.string())
    if name in ("signatures", "sets"):
        own = own.cast(pa.binary())
    if name != "sets":
        return pa.RecordBatch.from_arrays([ids, own], names=["doc_id", "text"])
    prints = [minhash.blake2b(minhash.shingle_set(t and t.encode(), minhash.WordHashes(), 5).tobytes(), digest_size=16).digest() for t in texts]
    return pa.RecordBatch.from_arrays([ids, pa.array(prints, pa.binary()), own], names=["id", "print", "text"])


@pytest.mark.parametrize("name", ["language", "signatures", "sets", "encoding"])
def test_large_batches_leave_in_parts(functions, name):
    most = {"language": 2 << 20, "encoding": 1 << 20}.get(name, 2 << 20)
    out = list(functions[name](iter([batch(name, TEXTS)])))
    sizes = [[len(TEXTS[i] or "") for i in part.column(0).to_pylist()] for part in out]
    assert all(sum(s) <= most or len([x for x in s if x]) == 1 for s in sizes) and len(out) > 2
    ids = [i for part in out for i in part.column(0).to_pylist()]
    lost = {len(TEXTS) - 5, len(TEXTS) - 4} if name == "language" else set()  # null and empty texts have no language
    assert ids == [i for i in range(len(TEXTS)) if i not in lost]


@pytest.mark.parametrize("name", ["signatures", "sets", "encoding"])
def test_parts_change_no_row(functions, name):
    texts = TEXTS[:300] + TEXTS[-5:]
    whole = [r for part in functions[name](iter([batch(name, texts), batch(name, [])])) for r in part.to_pylist()]
    single = [r for part in functions[name](batch(name, [t]) for t in texts) for r in part.to_pylist()]
    key = "id" if name == "sets" else "doc_id"
    assert [r | {key: 0} for r in whole] == single


@pytest.mark.parametrize("name", ["language", "signatures", "sets"])
def test_the_table_of_pieces_goes_when_another_operator_comes(functions, name):
    list(functions["encoding"](iter([batch("encoding", ["some words"])])))
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as file:
        data = file.read()
    codec = weakref.ref(bpe.worker_codec(data, P.PATTERN))
    assert "some" in codec().packed  # the table of the task before
    list(functions["encoding"](iter([batch("encoding", ["more words"])])))
    assert {"some", " words", "more"} <= set(codec().packed)  # which goes on
    list(functions[name](iter([batch(name, ["other work"])])))
    assert codec() is None
