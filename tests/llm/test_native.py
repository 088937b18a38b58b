"""Exact dedup and mixing against brute force."""

import re
from collections import defaultdict

from pagewright.llm import exact_dedup, mixing
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def norm(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def brute_dedup(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[norm(text)].append((-len(text or ""), doc_id is None, doc_id))
    keep = {k: min(v)[2] for k, v in groups.items()}
    return sorted(((i, keep[norm(t)], len(groups[norm(t)]), i == keep[norm(t)]) for i, t in rows), key=str)


ROWS = [
    (1, "a b"), (2, "ab"), (3, "a\tb "), (4, "a  b"), (5, None), (6, ""), (7, " \n"), (8, "é x"), (9, "éx"), (10, "e x"), (11, "x" * 100_000), (12, "x " * 100_000), (None, "ab c"), (13, "abc"), (None, None),
    (14, " ab"), (15, "Z"), (15, "Z"), (16, "z"), (17, "ab" * 3), (18, "a b a b a b"),
]


def test_exact_dedup(spark):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in ROWS], SCHEMA).withColumn("digest", F.lit("clash")).withColumn("keep_id", F.lit(0))
    got = exact_dedup.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=str) == brute_dedup(ROWS)
    weak = exact_dedup.exact_dedup(docs, lambda n: F.substring(F.sha2(n, 256), 1, 1)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in weak), key=str) == brute_dedup(ROWS)


def test_keep_first_returns_one_row_of_each_group(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in ROWS], SCHEMA)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(norm(r.text) for r in kept.collect()) == sorted({norm(t) for _, t in ROWS})


def test_exact_dedup_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.keep_first(empty).count() == 0


def test_stream_goes_on_from_its_state(spark, tmp_path):
    first, second = (spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA) for rows in (ROWS[:8], ROWS[8:]))
    at, state = f"file://{tmp_path}/in", f"file://{tmp_path}/state"
    for part in (first, second):
        narrow = exact_dedup.locators(part)
        narrow.write.mode("append").parquet(at)
        groups = exact_dedup.stream_groups(narrow, at, state)
    assert groups.agg(F.sum("group_size")).first()[0] == len(ROWS) and groups.count() == len({norm(t) for _, t in ROWS})


def water(sizes, weights, share, most):
    left, open_ = share * sum(sizes.values()), dict(sizes)
    target = {}
    while open_:
        total = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / total >= most * sizes[s]]
        if not over:
            return target | {s: left * weights[s] / total for s in open_}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        open_ = {s: n for s, n in open_.items() if s not in over}
    return target


def test_mixing(spark):
    rows = [(i, "w " * (1 + i % 13), "en", f"s{i % 7:02}" if i % 11 else None, 0) for i in range(900)]
    rows += [(1000 + i, "hot word", "en", "s03", 0) for i in range(2000)] + [(5000, None, None, "empty", None), (None, "a b", None, "s01", 1), (5001, "x " * 30_000, "en", "s06", 1), (1, "w w", "en", "s01", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len((text or "").split())
    order = sorted(s for s in sizes if s is not None) + [None]
    target = water(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5, 2)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again)) and sorted(map(key, got)) != sorted(map(key, mixing.mix(docs, seed=1).collect()))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.repeats for r in got)


def test_mixing_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = mixing.mix(spark.createDataFrame([(1, None, None, None, None)], SCHEMA)).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)]
