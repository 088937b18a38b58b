import random

import numpy as np
from pagewright.llm import minhash


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    label = {i: i for i in sets}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def near_copies(n, words, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(0, words // 12)):
            copy[rng.randrange(words)] = f"x{rng.randrange(30)}"
        out.append(" ".join(copy))
    return out


def test_components_of_many_near_copies(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 3)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "LEADERS", 1)
    texts = near_copies(120, 120, 1) + near_copies(6, 40, 2) + ["a b", "A\tB ", "a b c", "", "  ", None, "one", "one"]
    texts += [texts[0]] * 20 + [" ".join(f"u{i}{j}" for j in range(50)) for i in range(10)]
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, 3, 85)
    assert len(got) == len(rows)


def test_odd_tables(spark):
    schema = "doc_id long, text string, component_id string, print string, n_shingles string"
    assert minhash.near_duplicates(spark.createDataFrame([], schema), 3, 85).count() == 0
    rows = [(None, "a b c d", None, "", ""), (None, None, None, None, None), (5, "a b c d", "", "", ""), (5, "a b c d", "", "", ""), (7, "x " * 50_000, "", "", "")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, schema), 3, 85).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id) == [(5, 2, 5, True), (5, 2, 5, True), (7, 1, 7, True)]
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)


def test_keep_one_keeps_the_smallest_id(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([near_copies(1, 400, 3)[0] + f" tail{i}" for i in range(8)])], "doc_id long, text string, lang string")
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [0]


def test_sketch_fills_every_bin_and_estimates():
    rng = np.random.default_rng(0)
    for n in (1, 3, 50, 4000):
        assert (minhash.sketch(np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))) != np.iinfo(np.uint64).max).all()
    items = np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64))
    a, b = items[:2500], items[500:]
    share = np.mean([np.mean(minhash.sketch(minhash.mix(a + np.uint64(i))) == minhash.sketch(minhash.mix(b + np.uint64(i)))) for i in range(20)])
    assert abs(share - 2000 / 3000) < 0.05


def test_pairs_of_hot_leaders(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HOT_PAIRS", 3)
    rows = list(enumerate(near_copies(80, 60, 11) + ["something else %d %d %d %d" % (i, i, i * i, i) for i in range(20)]))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == brute(rows, 3, 85)


def test_few_links_cost_few_tables(spark, monkeypatch):
    written = []
    table = minhash.scratch.table
    monkeypatch.setattr(minhash.scratch, "table", lambda df, label, *more: written.append(label) or table(df, label, *more))
    rows = [(i, t) for i, t in enumerate(["a b c d e f g", "a b c d e f g", "other words of no other text", None, ""])]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, 3, 85)
    assert written.count("minhash-links") == 1  # no bucket is left open
    rows = list(enumerate(near_copies(60, 60, 5)))
    written.clear()
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, 3, 85)
    assert "cc-low" not in written and "minhash-same" not in written


def test_leftover_links_by_either_way(spark, monkeypatch):
    rows = list(enumerate(near_copies(60, 60, 7)))
    for small in (1, 1000):  # all open buckets are large, or small
        monkeypatch.setattr(minhash, "SMALL", small)
        monkeypatch.setattr(minhash, "LEADERS", 1)
        got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, 3, 85)
