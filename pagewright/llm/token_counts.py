r"""Token counts by a linear longest-match automaton.

Method: greedy word pieces (at each position the longest vocabulary piece) in one pass over the
characters of a word. The vocabulary is a trie; each node has a failure link, the node of what is
left after the pieces are taken that the node's string is known to begin with, and beside it not
those pieces but only their number, counted beforehand. Reading a character either goes down the
trie, or follows failure links and adds up their numbers; no piece is ever built.

A word is a run of ``[^\x20\x09-\x0D]`` behind the mark ``U+2581`` that the vocabulary puts before
words. A character that no piece begins with there counts as its UTF-8 bytes, as byte fall-back
does, and matching starts anew behind it.

Defined results: null or empty text has no words and no tokens; rows with equal or null ids each
give a row; other columns are passed over. Texts are never cut.

Scale: no shuffle. The vocabulary (under ``MAX_PIECES`` pieces, checked) is sent with the tasks and
turned into the automaton once a worker; counts of words are kept in a table that is emptied when
it is full.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PIECES = 500_000
WORDS_KEPT = 500_000
MARK = "▁"


class Automaton:
    """Trie with failure links and popped-token counts over ``pieces``."""

    def __init__(self, pieces: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for ch in piece:
                if ch not in self.next[node]:
                    self.next[node][ch] = len(self.next)
                    self.next.append({})
                    final.append(False)
                node = self.next[node][ch]
            final[node] = node != 0
        #: The node to go on from when no child fits, and how many tokens are taken by going there.
        self.fail, self.popped = [0] * len(self.next), [0] * len(self.next)
        level = [(0, ch, node) for ch, node in self.next[0].items()]
        while level:
            below = []
            for parent, ch, node in level:
                if final[node]:  # the string itself is its longest piece
                    self.popped[node] = 1
                elif parent == 0:
                    self.popped[node] = len(ch.encode())
                else:
                    at, count = self.fail[parent], self.popped[parent]
                    while at and ch not in self.next[at]:
                        at, count = self.fail[at], count + self.popped[at]
                    child = self.next[at].get(ch, 0)
                    self.fail[node] = child
                    self.popped[node] = count if child else count + len(ch.encode())
                below.extend((node, c, child) for c, child in self.next[node].items())
            level = below

    def count(self, text: str) -> int:
        """How many tokens the greedy longest match cuts ``text`` into."""
        total = node = 0
        children, fail, popped = self.next, self.fail, self.popped
        for ch in text:
            child = children[node].get(ch)
            while child is None and node:
                total += popped[node]
                node = fail[node]
                child = children[node].get(ch)
            if child is None:
                total += len(ch.encode())
            else:
                node = child
        while node:
            total += popped[node]
            node = fail[node]
        return total


class Counter(dict):
    """Tokens of words, remembered."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        count = self[word] = self.automaton.count(MARK + word.decode())
        return count


_COUNTERS: dict[int, Counter] = {}


def worker_counter(pieces: list[str]) -> Counter:
    """The counter of this Python worker, which later tasks of the worker go on using."""
    key = hash(tuple(pieces))
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(Automaton(pieces))
    return _COUNTERS[key]


def model_pieces(model_path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model file: no control, unknown or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, n_tokens`` of every row."""
    pieces = model_pieces(model_path)
    if len(pieces) > MAX_PIECES:
        raise ValueError("the vocabulary has more than MAX_PIECES pieces")
    sent = docs.sparkSession.sparkContext.broadcast(pieces)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(sent.value)
        for batch in batches:
            words, tokens = [], []
            for text in batch.column(1).to_pylist():
                own = text.split() if text else []  # bytes.split knows just [\x20\x09-\x0D]
                words.append(len(own))
                tokens.append(sum(map(counter.__getitem__, own)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=[id_col, "n_words", "n_tokens"])

    return docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, f"{id_col} {kind}, n_words long, n_tokens long")
