r"""Language-model scores: the marginal likelihood of a text over all its subword segmentations.

Method: a text is a sequence of words and an end; each word, after its mark ``U+2581``, is a lattice
whose edges are pieces of an existing vocabulary, and the sum over all paths is the word's
probability, by a forward recursion in log space. Because only pieces with the mark begin a word, no
edge crosses from word to word, so the text's sum over all segmentations is the product of its
words' sums. In the lattice

* a first piece has the share ``NOVEL`` times its weight, a later piece its weight, and the word ends
  with the weight ``stop``; first weights sum to 1, later ones and ``stop`` sum to 1, and the word of
  no characters is taken out, so that spelled words sum to 1;
* a word seen in training has one more edge from its begin to its end, with the share ``1 - NOVEL``
  times its relative frequency.

``NOVEL`` is the Good-Turing estimate of unseen words (singletons over words). After each word the
text goes on or ends by the share of ends among training tokens. So probabilities of all texts sum to
1 (to less only by what byte sequences take that spell no word, or characters that have a piece).

Weights: the vocabulary's scores, which for this kind of model are negative ranks, give the first
weights (inverse to the rank); one pass of expected counts over every distinct training word makes
them the corpus's. Each word counts once there, because the pieces have to foresee new words, which
are like the rare ones.

Tokens: A-Z lower-cased, runs of ``[^\x20\x09-\x0D]``, then one end. The base score is the sum of
``log10((c + 1) / (N + V + 1))`` over tokens; both scores learn from rows whose crc32(doc_id) mod 7
is not 2.

Defined results: null text is empty and scores its end alone; a row without a doc_id counts as crc32
of the empty string; repeated rows each give a row and each count in training; with nothing to learn
from, N and V are 0, every word is spelled by the vocabulary's own weights, ``stop`` is ``STOP`` and
the share of ends one half; characters that the vocabulary lacks, and the mark inside a word, are
spelled in bytes; other columns are passed over. Texts are never cut.

Scale: words of all texts are counted map-side first; all distinct words, with their lattice sums,
stay in a distributed table, computed once a word. The most frequent, at most ``TOP``, are sent to
the workers (a bound on size, not on what is counted); every other word is looked up exactly, by a
join on the word, so a text is one row and a row for each of its rarer words. Hot words are never
keys of that join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright import scratch
from pagewright.llm.lang_id import remainder

TOP = 200_000
#: Distinct words that a task counts before it hands its counts on.
FLUSH = 400_000
MARK = "▁"
#: Added to ranks, so that the first pieces do not take all the weight.
RANK_SHIFT = 20.0
#: Added to each piece's expected count.
PRIOR = 0.05
#: Weight of a word's end where nothing was learned.
STOP = 0.5


def vocabulary(model_path: str) -> dict[str, float]:
    """Weights of pieces, and of the 256 bytes as chr(0xE000 + byte), from a model's scores.

    The scores of this kind of model are the negative ranks of pieces; a piece's first weight is
    inverse to its rank. Pieces with a mark after their first character stand for white space and
    can be part of no word.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    size = model.get_piece_size()
    weights: dict[str, float] = {byte_piece(b): 1e-7 for b in range(256)}
    for i in range(size):
        piece = model.id_to_piece(i)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or MARK in piece[1:]):
            weights[piece] = 1.0 / (RANK_SHIFT + min(-model.get_score(i), 1e6))
    return weights


@dataclass(frozen=True)
class Weights:
    """Log weights of first and later pieces, and the weight of a word's end."""

    logs: dict[str, float]
    stop: float

    @property
    def ending(self) -> float:
        """log10 of what every spelled word is multiplied by: its end, over all words but the empty one."""
        empty = math.exp(self.logs[MARK]) * self.stop if MARK in self.logs else 0.0
        return math.log10(self.stop) - math.log10(1 - empty)


def normalised(weights: dict[str, float], words: float | None = None) -> Weights:
    """First pieces sum to 1, later ones and the end of ``words`` words too."""
    first = sum(w for piece, w in weights.items() if piece.startswith(MARK))
    later = sum(w for piece, w in weights.items() if not piece.startswith(MARK))
    stop = STOP if words is None else words / (later + words)
    logs = {piece: math.log(w / first if piece.startswith(MARK) else w / later * (1 - stop)) for piece, w in weights.items()}
    return Weights(logs, stop)


def byte_piece(byte: int) -> str:
    return chr(0xE000 + byte)


class Lattice:
    """Forward and backward sums over the segmentations of words.

    The recursion is in log space; where its sums cannot underflow (``SAFE``, most words) the same
    recursion is done on the numbers themselves, which saves the logarithms.
    """

    SAFE = 1e-250

    def __init__(self, logs: dict[str, float]):
        self.logs = logs
        self.trie: dict = {}
        for piece, weight in logs.items():
            node = self.trie
            for ch in piece:
                node = node.setdefault(ch, {})
            node[""] = (math.exp(weight), weight, piece)

    def edges(self, text: str) -> list[tuple[int, int, float, float, str | None]]:
        """``(start, end, weight, log weight, piece)`` of all pieces in the text, by start; no piece: spelled in bytes."""
        out, n = [], len(text)
        for start in range(n):
            node, end = self.trie.get(text[start]), start + 1
            if start and text[start] == MARK:
                node = None
            if node is None or "" not in node:
                log = sum(self.logs[byte_piece(b)] for b in text[start].encode())
                out.append((start, end, math.exp(log), log, None))
            while node is not None:
                found = node.get("")
                if found is not None:
                    out.append((start, end, *found))
                if end == n:
                    break
                node = node.get(text[end])
                end += 1
        return out

    @staticmethod
    def forward(edges: list, n: int) -> list[float]:
        """Log sums of the ways to each position."""
        terms: list[list[float]] = [[] for _ in range(n + 1)]
        terms[0].append(0.0)
        total, done = [0.0] * (n + 1), 0
        for start, end, _, log, _ in edges:
            while done <= start:
                total[done] = log_sum(terms[done])
                done += 1
            terms[end].append(total[start] + log)
        while done <= n:
            total[done] = log_sum(terms[done])
            done += 1
        return total

    def log10(self, word: str) -> float:
        """log10 of the word's probability, summed over its segmentations."""
        text = MARK + word
        n, edges = len(text), self.edges(text)
        ways = [0.0] * (n + 1)
        ways[0] = 1.0
        for start, end, weight, _, _ in edges:
            ways[end] += ways[start] * weight
        if ways[n] > self.SAFE:
            return math.log10(ways[n])
        return self.forward(edges, n)[n] / math.log(10)

    def expect(self, word: str, times: float, into: dict[str, float]) -> None:
        """Add the expected number of each piece in ``times`` occurrences of the word."""
        text = MARK + word
        n, edges = len(text), self.edges(text)
        ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
        ahead[0] = behind[n] = 1.0
        for start, end, weight, _, _ in edges:
            ahead[end] += ahead[start] * weight
        if ahead[n] > self.SAFE:
            part = times / ahead[n]
            for start, end, weight, _, piece in reversed(edges):
                through = weight * behind[end]
                behind[start] += through
                share = part * ahead[start] * through
                if piece is not None:
                    into[piece] = into.get(piece, 0.0) + share
                else:
                    self._spell(text[start], share, into)
            return
        logs = self.forward(edges, n)
        terms: list[list[float]] = [[] for _ in range(n)] + [[0.0]]
        for start, end, _, log, piece in sorted(edges, key=lambda e: -e[1]):
            if len(terms[end]) > 1:
                terms[end] = [log_sum(terms[end])]
            through = log + terms[end][0]
            terms[start].append(through)
            share = times * math.exp(logs[start] + through - logs[n])
            if piece is not None:
                into[piece] = into.get(piece, 0.0) + share
            else:
                self._spell(text[start], share, into)

    @staticmethod
    def _spell(ch: str, share: float, into: dict[str, float]) -> None:
        for byte in ch.encode():
            into[byte_piece(byte)] = into.get(byte_piece(byte), 0.0) + share


def log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top if len(terms) == 1 else top + math.log(sum([math.exp(t - top) for t in terms]))


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []  # just A-Z and [\x20\x09-\x0D]


def word_counts(docs: DataFrame, held: Column) -> DataFrame:
    """``(word, c)`` of all words of the texts; c: how often it stands in those that are not held out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
            counts.clear()
            return batch

        for batch in batches:
            for text, is_held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if is_held:
                    counts.update(dict.fromkeys(words_of(text), 0))
                else:
                    counts.update(words_of(text))
                if len(counts) > FLUSH:
                    yield out()
        yield out()

    partial = docs.select(F.col("text").cast("binary").alias("text"), held.alias("held")).mapInArrow(run, "word string, c long")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


def fitted(words: DataFrame, vocabulary: dict[str, float]) -> Weights:
    """The weights after one pass of expected counts over the words."""
    first = normalised(vocabulary)
    sent = words.sparkSession.sparkContext.broadcast(first.logs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, total, n = Lattice(sent.value), {}, 0
        for batch in batches:
            for word in batch.column(0).to_pylist():
                lattice.expect(word, 1.0, total)
                n += 1
        total[""] = float(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.float64())], names=["piece", "n"])

    rows = words.select("word").mapInArrow(run, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    table = rows.toArrow()  # as many rows as the vocabulary has pieces, at most, and the number of words
    found = dict(zip(table["piece"].to_pylist(), table["n"].to_pylist(), strict=True))
    n = found.pop("", 0.0)
    return normalised({piece: found.get(piece, 0.0) + PRIOR for piece in vocabulary}, n) if n else first


@dataclass(frozen=True)
class Model:
    """What is learned: weights of pieces, and counts of training tokens."""

    weights: Weights
    words: int  # training words
    ends: int  # training texts
    novel: float

    @property
    def more(self) -> float:
        """The probability that a text goes on."""
        return (self.words + 1) / (self.words + self.ends + 2)

    def chance(self, lattice: Lattice, word: str, c: int) -> float:
        """log10 of a word's probability, of all paths through its lattice."""
        spelled = lattice.log10(word) + self.weights.ending + math.log10(self.novel)
        if not c or self.novel == 1:
            return spelled
        whole = math.log10((1 - self.novel) * c / self.words)
        top = max(spelled, whole)
        return top + math.log10(10 ** (spelled - top) + 10 ** (whole - top))


def model_of(words: DataFrame, ends: int, vocabulary: dict[str, float]) -> Model:
    """Learn from ``(word, c)`` of the training texts and their number."""
    row = words.agg(F.sum("c"), F.count_if(F.col("c") == 1)).first()
    total, singles = row[0] or 0, row[1]
    novel = max(singles, 1) / total if total > 1 else 1.0
    return Model(fitted(words.where("c > 0"), vocabulary), total, ends, novel)


def with_chance(words: DataFrame, model: Model) -> DataFrame:
    """``(word, c, chance)``: log10 of each word's probability."""
    sent = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(sent.value.weights.logs)
        for batch in batches:
            found = [sent.value.chance(lattice, word, c) for word, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["word", "c", "chance"])

    return words.select("word", "c").mapInArrow(run, "word string, c long, chance double")


def _most_frequent(counts: DataFrame, top: int) -> DataFrame:
    """The words above the least count that at most ``top`` words reach; counts are told apart by eighths of their powers of two.

    A histogram of a few hundred rows finds the limit, so that no task sorts or gathers candidates.
    """
    counts = counts.where("c > 0")
    level = F.floor(F.log2("c") * 8)
    held, least = 0, math.inf
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        if held + row["count"] > top:
            break
        held, least = held + row["count"], row["level"]
    return counts.where(level >= F.lit(least))


def score(docs: DataFrame, model_path: str, mod: int = 7, held_out: int = 2, top: int = TOP) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    context = docs.sparkSession.sparkContext
    held = remainder(F.col("doc_id"), mod) == held_out
    words = scratch.table(word_counts(docs, held), "lm-counts")
    ends = docs.where(~held).count()
    model = model_of(words, ends, vocabulary(model_path))
    n_train, n_kinds = model.words + ends, words.where("c > 0").count() + (ends > 0)
    bottom = n_train + n_kinds + 1
    words = scratch.table(with_chance(words, model), "lm-words")
    head = _most_frequent(words, top).toArrow()
    sent = context.broadcast((head["word"].to_pylist(), head["c"].to_numpy(), head["chance"].to_numpy()))
    more, last = math.log10(model.more), math.log10(1 - model.more)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"uid long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, own double, word string, times long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top_words, count, chance = sent.value
        number = {w.encode(): i for i, w in enumerate(top_words)}
        base_log = np.log10((count + 1) / bottom)
        uid = TaskContext.get().partitionId() << 33

        for batch in batches:
            cols: list[list] = [[] for _ in range(9)]
            for doc_id, is_held, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                counted = Counter(words_of(text))
                n = counted.total()
                rare = [(word, times) for word, times in counted.items() if word not in number]
                often = [(number[word], times) for word, times in counted.items() if word in number]
                at, times = np.array(often, dtype=np.int64).reshape(-1, 2).T
                base = float(base_log[at] @ times) + math.log10((ends + 1) / bottom)
                own = float(chance[at] @ times) + n * more + last
                for col, value in zip(cols, (uid, doc_id, is_held, n + 1, int(times.sum()) + (ends > 0), base, own, None, None), strict=True):
                    col.append(value)
                k = len(rare)
                cols[0].extend([uid] * k)
                for col in cols[1:7]:
                    col.extend([None] * k)
                cols[7].extend(word.decode() for word, _ in rare)
                cols[8].extend(times for _, times in rare)
                uid += 1
            types = [pa.int64(), batch.schema.field(0).type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.int64()]
            names = ["uid", "doc_id", "held_out", "n_tokens", "known", "base", "own", "word", "times"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types, strict=True)], names=names)

    parts = docs.select("doc_id", held.alias("held_out"), F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)
    # a text's own row meets no word; its key deals such rows evenly (no word holds a space)
    key = F.coalesce("word", F.concat(F.lit(" "), F.col("uid").cast("string")))
    joined = parts.withColumn("key", key).join(words.select(F.col("word").alias("key"), "c", "chance"), "key", "left")
    rare, times = F.col("word").isNotNull(), F.col("times")
    base = F.log10((F.col("c") + 1) / F.lit(float(bottom)))
    return (
        joined.groupBy("uid")
        .agg(
            F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
            F.sum(F.when(rare, F.when(F.col("c") > 0, times).otherwise(0)).otherwise(F.col("known"))).cast("long").alias("n_known"),
            F.lit(n_train).cast("long").alias("train_tokens"),
            F.sum(F.when(rare, times * base).otherwise(F.col("base"))).alias("base_score"),
            F.sum(F.when(rare, times * F.col("chance")).otherwise(F.col("own"))).alias("score"),
        )
        .drop("uid")
    )
