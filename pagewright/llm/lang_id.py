r"""Language identification by prediction by partial matching (PPM).

Method: for every language a context tree over bytes holds how often each symbol followed each
context of up to ``ORDER`` symbols. A symbol costs ``-log2(n / (T + D))`` bits in the longest
context that the language knows, or that context's escape ``-log2(D / (T + D))`` and then its cost
in the next shorter one (PPM's method C; T: times the context was seen, D: its distinct symbols),
down to a uniform order -1. Statistics are frozen after learning, so a text's code length is exact,
and the language with the shortest code is predicted.

For speed the trees of up to ``TOGETHER`` languages are laid over each other as one automaton: a state
is the longest known suffix of what was read, and the symbols seen there have their successor and cost
in every language; others are looked for in the next shorter state, after the escape. Texts are scored whole: they are cut into runs that are read side by side, each after the
``ORDER`` symbols before it, which is all that a state depends on; so the sum is that of one pass.

Symbols are bytes, with A-Z lower-cased, runs of ASCII that is no letter as one separator, and bytes
that learning never met as one more.

Learning: from ``text`` and non-null ``lang`` of the rows given, by a sample bounded by
``DOCS_PER_LANG`` whole documents a language (those with the least hash of doc_id). Every language,
and every context and symbol of the sampled documents, is kept.

Defined results: ``und`` with score 0 if the text is null or has no letter (of any script), or if
nothing could be learned; a tie goes to the first language in code-point order; rows without a
doc_id count as crc32 of the empty string and are not held out; repeated rows each give a row; other
columns are passed over. The score is the posterior probability of the predicted language for
``WINDOW`` symbols at the text's mean code lengths (all of a shorter text).

Scale: one narrow aggregate (its row a language is broadcast), one bounded sample, one count, then
scoring without a shuffle. The model grows with the sample, so with languages but not with rows, and
is sent with the tasks; scoring takes a pass for every ``TOGETHER`` languages.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.worker import parts, tidy

ORDER = 4
DOCS_PER_LANG = 1000
#: Languages whose trees share an automaton.
TOGETHER = 8
WINDOW = 64
#: A text whose best language is less likely than this is rejected by ``keep_known``.
MIN_SCORE = 0.5
UNKNOWN = "und"
RUN = 1024
SEPARATOR = 0x20
#: Odd factor that spreads keys over a table of hashes.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Characters that are scored side by side.
PART = 2 << 20

FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else SEPARATOR for b in range(256))
ASCII_LETTER = re.compile(rb"[A-Za-z]")


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def fold(text: bytes) -> bytes:
    return b" ".join(text.translate(FOLD).split())


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode()))


def _sample(train: DataFrame) -> DataFrame:
    """At most ``DOCS_PER_LANG`` rows ``(lang, text)`` of each language."""
    rows = train.where("lang is not null and text is not null")
    share = rows.groupBy(F.col("lang").alias("of")).agg(F.least(F.lit(1.0), F.lit(1.5 * DOCS_PER_LANG) / F.count("*")).alias("share"))
    hashed = rows.select("lang", "text", F.xxhash64("doc_id").alias("hash"))
    unit = F.pmod(F.col("hash"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    near = hashed.join(F.broadcast(share), F.col("lang") == F.col("of")).where(unit <= F.col("share"))
    order = Window.partitionBy("lang").orderBy(unit, "hash")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= DOCS_PER_LANG).select("lang", "text")


def _gram_counts(sample: DataFrame) -> DataFrame:
    """``(lang, gram, n)``: grams of ``ORDER + 1`` bytes as numbers, with separators before each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                found = []
                for text in texts:
                    data = np.frombuffer(bytes([SEPARATOR]) * ORDER + fold(text), dtype=np.uint8).astype(np.int64)
                    n = len(data) - ORDER
                    code = np.zeros(n, dtype=np.int64)
                    for i in range(ORDER + 1):
                        code = code << 8 | data[i : i + n]
                    found.append(code)
                grams, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], names=["lang", "gram", "n"])

    counted = sample.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Automaton:
    """Frozen statistics of a few languages, of what was seen only.

    A state is a context, ``entry`` a pair of state and symbol: its cost in each language and its next
    state. A pair without an entry costs ``escape`` and is looked for in the ``shorter`` state; the root
    has every symbol. Entries are found by ``state * size + symbol`` in an open table of hashes.
    """

    size: int
    shorter: np.ndarray
    escape: np.ndarray
    after: np.ndarray
    bits: np.ndarray
    keys: np.ndarray
    entries: np.ndarray
    root: int
    start: int

    def slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * SPREAD) >> np.uint64(65 - len(self.keys).bit_length())).astype(np.int64)

    def put(self, key: np.ndarray) -> None:
        left, slot = np.arange(len(key)), self.slots(key)
        while len(left):
            free = self.keys[slot] < 0
            self.entries[slot[free]] = left[free]
            self.keys[slot[free]] = key[self.entries[slot[free]]]
            out = self.entries[slot] != left
            left, slot = left[out], (slot[out] + 1) & (len(self.keys) - 1)

    def find(self, key: np.ndarray) -> np.ndarray:
        """Entries of the keys, -1 where there is none."""
        slot = self.slots(key)
        there = self.keys[slot]
        other = np.flatnonzero((there != key) & (there >= 0))
        while len(other):
            slot[other] = (slot[other] + 1) & (len(self.keys) - 1)
            there[other] = self.keys[slot[other]]
            other = other[(there[other] != key[other]) & (there[other] >= 0)]
        return np.where(there == key, self.entries[slot], -1)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost in each language, and next states."""
        entry = self.find(state * self.size + symbol)
        lost = np.flatnonzero(entry < 0)
        here, escapes = state[lost], []
        while len(lost):
            escapes.append((lost, self.escape[here]))
            here = self.shorter[here]
            found = self.find(here * self.size + symbol[lost])
            entry[lost] = found
            lost, here = lost[found < 0], here[found < 0]
        cost = self.bits[entry]
        for at, paid in escapes:
            cost[at] += paid
        return cost, self.after[entry]


@dataclass
class Model:
    """Automata of up to ``TOGETHER`` languages each, in the order of ``langs``."""

    langs: list[str]
    symbols: bytes  # byte to symbol
    size: int  # number of symbols
    automata: list[Automaton]


def _automaton(lang: np.ndarray, gram: np.ndarray, n: np.ndarray, kinds: int, size: int, space: int) -> Automaton:
    """The automaton of ``kinds`` languages' trees, from counts of grams of symbols, eight bits each."""
    start = sum(space << 8 * i for i in range(ORDER))
    low = [(1 << 8 * j) - 1 for j in range(ORDER + 2)]
    seen = []  # for each length of context: language, context and symbol, count
    for j in range(ORDER + 1):
        pair, which = np.unique(lang << 40 | gram & low[j + 1], return_inverse=True)
        seen.append((pair >> 40, pair & low[5], np.bincount(which, n)))

    states: list[np.ndarray] = [np.zeros(1, dtype=np.int64)] * (ORDER + 1)
    longer = np.array([start], dtype=np.int64)
    for j in range(ORDER, 0, -1):  # a state's every part is a state, else the longest suffix is not found
        states[j] = np.unique(np.concatenate([longer, seen[j][1] >> 8]))
        longer = np.concatenate([states[j] >> 8, states[j] & low[j - 1]])
    first = np.cumsum([0] + [len(s) for s in states])
    index = lambda j, context: first[j] + np.searchsorted(states[j], context)
    shorter = np.concatenate([np.full(1, -1)] + [index(j - 1, states[j] & low[j - 1]) for j in range(1, ORDER + 1)])

    escape = np.zeros((first[-1], kinds))
    keys, after, bits = [], [], []
    for j, (owner, pair, count) in enumerate(seen):
        context, which, distinct = np.unique(owner << 40 | pair >> 8, return_inverse=True, return_counts=True)
        times = np.bincount(which, count)
        escape[index(j, context & low[4]), context >> 40] = -np.log2(distinct / (times + distinct))
        found = np.unique(np.concatenate([pair, states[j + 1] if j < ORDER else pair])) if j else np.arange(size)
        at = index(j, found >> 8)
        if j:
            cost = escape[at] + bits[-1][np.searchsorted(last, found & low[j])]
        else:
            cost = escape[at] + np.log2(size)
        cost[np.searchsorted(found, pair), owner] = -np.log2(count / (times + distinct)[which])
        onward = np.zeros(len(found), dtype=np.int64)
        for m in range(1, min(j + 1, ORDER) + 1):
            tail = found & low[m]
            place = np.minimum(np.searchsorted(states[m], tail), len(states[m]) - 1)
            onward = np.where(states[m][place] == tail, first[m] + place, onward)
        keys.append(at * size + (found & 255))
        after.append(onward)
        bits.append(cost)
        last = found
    key = np.concatenate(keys)
    slots = 1 << (2 * len(key)).bit_length()
    made = Automaton(size, shorter, escape, np.concatenate(after), np.concatenate(bits), np.full(slots, -1), np.full(slots, -1), 0, int(index(ORDER, start)))
    made.put(key)
    return made


def _model(langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    digits = [gram >> 8 * i & 255 for i in range(ORDER + 1)]
    seen = sorted({int(b) for d in digits for b in np.unique(d)} | {SEPARATOR})
    size = len(seen) + 1  # and the symbol of all other bytes
    number = np.zeros(256, dtype=np.int64)
    number[seen] = np.arange(size - 1)
    symbols = bytes(int(number[FOLD[b]]) if FOLD[b] in seen else size - 1 for b in range(256))
    gram = sum(number[d] << 8 * i for i, d in enumerate(digits))
    automata = []
    for low in range(0, len(langs), TOGETHER):
        own = (lang >= low) & (lang < low + TOGETHER)
        automata.append(_automaton(lang[own] - low, gram[own], n[own], min(TOGETHER, len(langs) - low), size, int(number[SEPARATOR])))
    return Model(langs, symbols, size, automata)


def build(counts: dict[str, dict[bytes, int]]) -> Model:
    """The model from counts of grams of ``ORDER + 1`` bytes."""
    langs = sorted(counts)
    rows = [(k, int.from_bytes(gram, "big"), n) for k, lang in enumerate(langs) for gram, n in counts[lang].items()]
    return _model(langs, *(np.array(column, dtype=np.int64) for column in zip(*rows, strict=True)))


def learn(train: DataFrame) -> Model | None:
    rows = _gram_counts(_sample(train)).toArrow()
    if not rows.num_rows:
        return None
    lang = rows["lang"].combine_chunks().dictionary_encode()
    names = lang.dictionary.to_pylist()
    langs = sorted(names)
    place = {name: k for k, name in enumerate(langs)}
    number = np.array([place[name] for name in names], dtype=np.int64)
    return _model(langs, number[lang.indices.to_numpy()], rows["gram"].to_numpy(), rows["n"].to_numpy())


def code_lengths(texts: list[bytes], model: Model) -> np.ndarray:
    """Bits of each text in each language."""
    runs: list[np.ndarray] = []
    owner, warm = [], []
    for k, text in enumerate(texts):
        data = np.frombuffer(fold(text).translate(model.symbols), dtype=np.uint8)
        for low in range(0, len(data), RUN):
            before = min(low, ORDER)
            runs.append(data[low - before : low + RUN])
            owner.append(k)
            warm.append(before)
    out = np.zeros((len(texts), len(model.langs)))
    if not runs:
        return out
    lengths = np.array([len(r) for r in runs])
    order = np.argsort(-lengths, kind="stable")
    lengths, warm, owner = lengths[order], np.array(warm)[order], np.array(owner)[order]
    side = np.zeros((len(runs), lengths[0]), dtype=np.uint8)
    for row, k in enumerate(order):
        side[row, : len(runs[k])] = runs[k]
    side = np.ascontiguousarray(side.T)
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # runs longer than each step
    for k, automaton in enumerate(model.automata):
        state = np.where(warm == 0, automaton.start, automaton.root).astype(np.int64)
        cost = np.zeros((len(runs), automaton.bits.shape[1]))
        for step in range(lengths[0]):
            m = active[step]
            paid, state[:m] = automaton.step(state[:m], side[step, :m])
            if step < ORDER:
                paid[warm[:m] > step] = 0
            cost[:m] += paid
        np.add.at(out[:, k * TOGETHER : k * TOGETHER + cost.shape[1]], owner, cost)
    return out


def predict(texts: list[bytes | None], model: Model | None) -> list[tuple[str, float]]:
    out = [(UNKNOWN, 0.0)] * len(texts)
    if model is None:
        return out
    rows = [i for i, t in enumerate(texts) if t and has_letter(t)]
    low = 0
    while low < len(rows):
        high, total = low, 0
        while high < len(rows) and (high == low or total + len(texts[rows[high]]) <= PART):
            total += len(texts[rows[high]])
            high += 1
        part = [texts[i] for i in rows[low:high]]
        bits = code_lengths(part, model)
        best = bits.argmin(axis=1)
        n = np.array([len(t) for t in part])
        gap = (bits - bits.min(axis=1, keepdims=True)) * np.minimum(1, WINDOW / n)[:, None]
        score = 1 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1)
        for i, k, s in zip(rows[low:high], best, score, strict=True):
            out[i] = (model.langs[k], float(s))
        low = high
    return out


def identify(docs: DataFrame, train: DataFrame | None = None, mod: int = 4, held_out: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs``.

    ``train``: labelled rows; by default those of ``docs`` whose crc32(doc_id) mod ``mod`` is not ``held_out``.
    """
    held = remainder(F.col("doc_id"), mod) == held_out
    model = learn(docs.where(~held) if train is None else train)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in parts(batch, 2, PART)):
            found = predict(part.column(2).to_pylist(), sent.value)
            langs, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), langs, scores], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held.alias("held_out"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the documents that identification rejects.

    Rejected are those with the prediction ``und``, and those whose predicted language has a score
    below ``min_score``: the learned languages tell nothing about them. Learning needs no held-out
    rows here. Predictions are attached row by row; no identifier is joined. With nothing to learn
    from, only texts without any letter go.
    """
    model = learn(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in parts(batch, "text", PART)):
            texts = [t.encode() if t is not None else None for t in part.column("text").to_pylist()]
            if sent.value is None:
                known = [bool(t) and has_letter(t) for t in texts]
            else:
                known = [lang != UNKNOWN and score >= min_score for lang, score in predict(texts, sent.value)]
            yield part.filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
