import itertools
import math
import random
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pagewright.llm import lm_score
from pyspark.sql import functions as F

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def pieces():
    logs = {"▁a": 0.2, "▁": 0.1, "a": 0.2, "b": 0.15, "ab": 0.1, "▁ab": 0.05, "ba": 0.1}
    logs |= {lm_score.byte_piece(b): 0.1 / 256 for b in range(256)}
    return {p: math.log(w) for p, w in logs.items()}


def ways(text, logs):
    if not text:
        yield 1.0, []
        return
    found = False
    for n in range(1, len(text) + 1):
        if text[:n] in logs:
            found = found or n == 1
            for rest, tail in ways(text[n:], logs):
                yield math.exp(logs[text[:n]]) * rest, [text[:n], *tail]
    if not found:
        spelled = [lm_score.byte_piece(b) for b in text[0].encode()]
        for rest, tail in ways(text[1:], logs):
            yield math.exp(sum(logs[p] for p in spelled)) * rest, [*spelled, *tail]


@pytest.mark.parametrize("safe", [1e-250, math.inf])
def test_lattice_sums_all_segmentations(safe, monkeypatch):
    monkeypatch.setattr(lm_score.Lattice, "SAFE", safe)
    logs, rng = pieces(), random.Random(1)
    lattice = lm_score.Lattice(logs)
    for _ in range(60):
        word = "".join(rng.choice("aabbé") for _ in range(rng.randrange(0, 7)))
        every = list(ways("▁" + word, logs))
        total = sum(p for p, _ in every)
        assert lattice.log10(word) == pytest.approx(math.log10(total))
        expected: Counter = Counter()
        for p, tail in every:
            for piece in tail:
                expected[piece] += 3 * p / total
        got: dict = {}
        lattice.expect(word, 3.0, got)
        assert got == pytest.approx(dict(expected))


def test_long_words_do_not_underflow():
    lattice = lm_score.Lattice(lm_score.normalised(lm_score.vocabulary(MODEL)).logs)
    assert -math.inf < lattice.log10("中x" * 3000) < -3000


def brute_base(rows):
    counts, ends = Counter(), 0
    for doc_id, text in rows:
        if zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 != 2:
            counts.update((text or "").encode().lower().split())
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
        out.append((doc_id, len(words) + 1, sum(counts[w] > 0 for w in words) + (ends > 0), n, round(base, 6)))
    return sorted(out, key=str)


def test_base_and_score_do_not_depend_on_what_is_sent_to_workers(spark):
    rng = random.Random(2)
    words = ["the", "OF", "and", "łąka", "zebra"] + [f"w{i}é" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 80)))) for i in range(40)]
    rows += [(100, None), (101, ""), (None, "the the"), (102, "x" * 40_000), (103, "  a b"), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for clash in ("word", "key", "uid", "c", "times", "chance", "known", "held", "base", "own", "score", "n_tokens"):
        docs = docs.withColumn(clash, F.lit("clash"))
    few = lm_score.score(docs, MODEL, top=3).collect()
    many = lm_score.score(docs, MODEL).collect()
    key = lambda r: (str(r.doc_id), r.n_tokens, round(r.score, 6))
    assert sorted(map(key, few)) == sorted(map(key, many))
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in few), key=str) == brute_base(rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in few)


def test_nothing_to_learn_from(spark):
    empty = lm_score.score(spark.createDataFrame([], "doc_id long, text string"), MODEL)
    assert empty.count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = lm_score.score(spark.createDataFrame([(held, "some words")], "doc_id long, text string"), MODEL).collect()[0]
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0) and row.base_score == 0 and row.score < -3


TINY = {"▁a": 0.2, "▁": 0.1, "a": 0.2, "b": 0.15, "ab": 0.1, "▁ab": 0.05, "ba": 0.1, "bab": 0.02}


def brute_scores(rows, vocabulary):
    """The score from its definition: every segmentation listed, no lattice."""
    train = [t for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in (t or "").split())
    n, singles = sum(counts.values()), sum(c == 1 for c in counts.values())

    def normal(weights, words):
        first, later = (sum(w for p, w in weights.items() if (p[0] == "▁") == is_first) for is_first in (True, False))
        stop = words / (later + words) if words else 0.5
        return {p: w / first if p[0] == "▁" else w / later * (1 - stop) for p, w in weights.items()}, stop

    def paths(word, weights):
        return [(p, tail) for p, tail in ways("▁" + word, {k: math.log(v) for k, v in weights.items()})]

    weights, stop = normal(vocabulary, 0)
    if counts:
        expected = dict.fromkeys(vocabulary, lm_score.PRIOR)
        for word in counts:
            every = paths(word, weights)
            for p, tail in every:
                for piece in tail:
                    expected[piece] += p / sum(q for q, _ in every)
        weights, stop = normal(expected, len(counts))
    novel, more = (max(singles, 1) / n if n > 1 else 1.0), (n + 1) / (n + len(train) + 2)

    def word_chance(word):
        spelled = sum(p for p, _ in paths(word, weights)) * stop / (1 - weights["▁"] * stop)
        return novel * spelled + (1 - novel) * counts[word] / max(n, 1)

    return [(i, sum(math.log10(more * word_chance(w)) for w in (t or "").split()) + math.log10(1 - more)) for i, t in rows]


def test_score_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "vocabulary", lambda path: dict(TINY))
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(0, 9)))) for i in range(60)]
    rows += [(70, None), (None, "ab ab"), (5, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for top in (0, 1000):
        got = [(r.doc_id, r.score) for r in lm_score.score(docs, "", top=top).collect()]
        want = brute_scores(rows, TINY)
        assert [i for i, _ in sorted(got, key=str)] == [i for i, _ in sorted(want, key=str)]
        assert sorted(s for _, s in got) == pytest.approx(sorted(s for _, s in want))
    held = [(i, "ab a") for i in range(20) if zlib.crc32(str(i).encode()) % 7 == 2]  # nothing to learn from
    got = lm_score.score(spark.createDataFrame(held, "doc_id long, text string"), "").collect()
    assert [r.score for r in got] == pytest.approx([s for _, s in brute_scores(held, TINY)])


@pytest.mark.parametrize("counts", [{}, {"a": 1}, {"ab": 3, "b": 1}, {"ab": 30, "b": 1, "ba": 7, "abab": 2}])
def test_all_probabilities_sum_to_one(spark, counts):
    words = spark.createDataFrame([*counts.items(), ("bb", 0)], "word string, c long")
    model = lm_score.model_of(words, 2, dict(TINY))
    lattice, total = lm_score.Lattice(model.weights.logs), 0.0
    for n in range(1, 15):
        total += sum(10 ** model.chance(lattice, "".join(w), counts.get("".join(w), 0)) for w in itertools.product("ab", repeat=n))
    assert total <= 1 + 1e-9 and total == pytest.approx(1, abs=0.02)
    texts = sum((1 - model.more) * model.more**n for n in range(2000))
    assert texts == pytest.approx(1)


def test_marks_inside_a_word_and_unknown_characters():
    weights = lm_score.normalised(lm_score.vocabulary(MODEL))
    lattice = lm_score.Lattice(weights.logs)
    spelled = sum(weights.logs[lm_score.byte_piece(b)] for b in "▁".encode())
    assert lattice.log10("▁") == pytest.approx((weights.logs["▁"] + spelled) / math.log(10))
    first = sum(math.exp(w) for p, w in weights.logs.items() if p.startswith("▁"))
    assert first == pytest.approx(1) and sum(math.exp(w) for w in weights.logs.values()) - first + weights.stop == pytest.approx(1)
