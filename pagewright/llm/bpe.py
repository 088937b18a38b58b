r"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Method: a part of a batch of documents (``PART``) is one small corpus, its new pieces replayed by ``REPLAYED``. Its texts are cut by the tokenizer's pattern;
the distinct pieces that the worker has not met before form one sequence of bytes with breaks
between pieces. An inverted index leads from each adjacent token pair to the positions where it
stands (the first pairs enter it sorted, as arrays); merges are replayed in the order of their ranks, each at all of its positions from
left to right, and a merge touches its two neighbours only (two new pairs enter the index). The ids of a piece are kept: it is
replayed once for a worker, however often it occurs, unless it leaves the table.

That gives each piece the merges that the rank-greedy loop of the usual library does: always the
lowest rank, then the leftmost. A pair that a merge creates with a lower rank than the current one
is taken up before the current rank goes on.

Defined results: null text is empty; an empty text has no tokens, and the hashes of no bytes; no
special tokens are known, their strings are ordinary text; rows with equal or null ids each give a
row; columns other than id and text are passed over. Texts are never cut; a very long text is held
once by one worker. Lone surrogates do not occur in Spark's strings.

Scale: there is no shuffle. The rank file (its path is a parameter; read by the driver, under
``MAX_RANK_BYTES``) is sent with the tasks; a worker's table of pieces loses, at ``PIECES_KEPT``, those that came in one part only
since it was last full. What leaves is replayed again when it comes again; no text is passed over.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from hashlib import sha256
from heapq import heappop, heappush
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.worker import kept, parts, tidy

#: Rank files are sent to every worker, so larger ones are refused.
MAX_RANK_BYTES = 16 << 20
PIECES_KEPT = 300_000
#: Bytes of texts that are encoded, and handed on, at a time; and of new pieces that are replayed at a time.
PART = 1 << 20
REPLAYED = 1 << 17
#: Ids that are decoded at a time.
DECODED = 1 << 16


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines ``base64 rank`` of a rank file."""
    ranks: dict[bytes, int] = {}
    for line in data.splitlines():
        if line:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks


class Pairs(NamedTuple):
    """What two tokens make: ``follow[left][right]`` and ``lead[right][left]`` are the merged token's rank, ``first`` that of two bytes (-1: none)."""

    follow: dict[int, dict[int, int]]
    lead: dict[int, dict[int, int]]
    first: np.ndarray


def pair_ranks(ranks: dict[bytes, int]) -> Pairs:
    """Every way to put a token together from two."""
    pairs = Pairs({}, {}, np.full(1 << 16, -1, np.int64))
    for token, rank in ranks.items():
        if len(token) == 2:
            pairs.first[token[0] << 8 | token[1]] = rank
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs.follow.setdefault(left, {})[right] = rank
                pairs.lead.setdefault(right, {})[left] = rank
    return pairs


def _replayed(pieces: list[bytes], singles: list[int], pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pieces after all merges, one piece after another, and where each piece's ids end."""
    breaks = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1) - 1
    n = int(breaks[-1]) + 1 if pieces else 0
    inside = np.ones(n + 1, bool)
    inside[breaks] = inside[n] = False
    laid = np.zeros(n + 1, np.uint16)
    laid[inside] = np.frombuffer(b"".join(pieces), np.uint8)
    tokens = np.where(inside, np.array(singles, np.int64)[laid], -1).tolist()  # -1: a break between pieces, -2: taken up by the token before it
    places = np.flatnonzero(inside[:-1] & inside[1:])
    found = pairs.first[laid[places] << 8 | laid[places + 1]]
    places, found = places[found >= 0], found[found >= 0]
    places = places[np.argsort(found, kind="stable")]
    queue, counts = np.unique(found, return_counts=True)
    queue, ends = queue.tolist(), np.cumsum(counts).tolist()  # in order, so a heap
    index: dict[int, list[int]] = {}  # rank of the merged pair: positions of its left part
    at = [-1] * (n + 1)  # the rank of the pair whose left part stands here
    for rank, low, high in zip(queue, [0, *ends], ends, strict=False):
        index[rank] = places[low:high].tolist()
        for left in index[rank]:
            at[left] = rank
    del inside, laid, places, found
    numbers = list(range(-1, n + 2))
    after, before = numbers[2:], numbers[:-2]
    del numbers
    none: dict[int, int] = {}
    while queue:
        rank = heappop(queue)
        places = index.pop(rank)
        places.sort()
        follows, leads = pairs.follow.get(rank, none).get, pairs.lead.get(rank, none).get
        for k, left in enumerate(places):
            if at[left] != rank:
                continue  # one of the two was merged meanwhile
            right = after[left]
            after[left] = beyond = after[right]
            before[beyond] = left
            tokens[left], tokens[right], at[right] = rank, -2, -1
            lower = False
            at[left] = new = follows(tokens[beyond], -1)
            if new >= 0:
                if new in index:
                    index[new].append(left)
                else:
                    index[new] = [left]
                    heappush(queue, new)
                lower = new < rank
            ahead = before[left]
            at[ahead] = new = leads(tokens[ahead], -1)
            if new >= 0:
                if new in index:
                    index[new].append(ahead)
                else:
                    index[new] = [ahead]
                    heappush(queue, new)
                lower = lower or new < rank
            if lower:
                rest = places[k + 1 :]  # the lower rank goes first, then this one again
                if rest:
                    index[rank] = rest
                    heappush(queue, rank)
                break
    ids = np.array(tokens, np.int64)
    whole = ids >= 0
    return ids[whole], np.cumsum(whole)[breaks]


def replay(pieces: list[bytes], singles: list[int], pairs: Pairs) -> list[list[int]]:
    """The ids of each piece after all merges. ``singles``: the rank of each byte."""
    ids, ends = _replayed(pieces, singles, pairs)
    return [own.tolist() for own in np.split(ids, ends)[:-1]]


class Codec:
    """Encodes batches of texts and decodes ids, with the pieces it has met kept as packed ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.singles = [ranks[bytes([byte])] for byte in range(256)]
        self.pairs = pair_ranks(ranks)
        tokens = {rank: token for token, rank in ranks.items()}
        self.known = np.array(sorted(tokens), np.int64)
        self.bytes = np.frombuffer(b"".join(tokens[rank] for rank in self.known.tolist()), np.uint8)
        self.sizes = np.array([len(tokens[rank]) for rank in self.known.tolist()], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.find = regex.compile(pattern).findall
        self.packed: dict[str, bytes] = {}
        self.again: set[str] = set()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        pieces = [self.find(text) for text in texts]
        self._make_room()
        met = set().union(*pieces)
        new = met.difference(self.packed)
        met -= new
        if len(self.again) < PIECES_KEPT // 3:
            self.again |= met
        for run in _runs(new):
            ids, ends = _replayed([p.encode() for p in run], self.singles, self.pairs)
            data, low = ids.astype("<u4").tobytes(), 0
            for piece, high in zip(run, (4 * ends).tolist(), strict=True):
                self.packed[piece] = data[low:high]
                low = high
        get = self.packed.__getitem__
        return [np.frombuffer(b"".join(map(get, own)), dtype="<u4") for own in pieces]

    def _make_room(self) -> None:
        """A full table keeps the pieces that came in another part, too, since it was last full; a third of it at most."""
        if len(self.packed) > PIECES_KEPT:
            self.packed = dict(islice(((p, ids) for p, ids in self.packed.items() if p in self.again), PIECES_KEPT // 3))
            self.again = set()

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, each looked up in the tokens laid end to end; an unknown id is an error."""
        return b"".join(self._decode(ids[low : low + DECODED]) for low in range(0, len(ids), DECODED))

    def _decode(self, ids: np.ndarray) -> bytes:
        if self.known[-1] != len(self.known) - 1:  # ranks with gaps
            own = np.searchsorted(self.known, ids)
            if not np.array_equal(self.known.take(own, mode="clip"), ids):
                raise IndexError("an id that no rank has")
            ids = own
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - ends + sizes, sizes)
        at += np.arange(len(at))
        return self.bytes[at].tobytes()


def worker_codec(data: bytes, pattern: str) -> Codec:
    """The codec of this Python worker, which later tasks of the worker go on using until another operator's come."""
    return kept(("bpe", sha256(data).digest(), pattern), lambda: Codec(parse_ranks(data), pattern))


def _runs(pieces: Iterable[str]) -> Iterator[list[str]]:
    """The pieces in runs of about ``REPLAYED`` characters: a replay holds some hundred bytes for each."""
    run, total = [], 0
    for piece in pieces:
        if run and total + len(piece) > REPLAYED:
            yield run
            run, total = [], 0
        run.append(piece)
        total += len(piece)
    if run:
        yield run


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` and, with ``keep_ids``, the ids themselves (array<long>)."""
    with open(ranks_path, "rb") as file:
        data = file.read(MAX_RANK_BYTES + 1)
    if len(data) > MAX_RANK_BYTES:
        raise ValueError("the rank file is larger than MAX_RANK_BYTES")
    sent = docs.sparkSession.sparkContext.broadcast(data)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>" if keep_ids else "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(sent.value, pattern)
        for part in (p for batch in batches for p in parts(batch, 1, PART)):
            counts, ids_sha, decoded_sha, all_ids = [], [], [], []
            for ids in codec.encode([t or "" for t in part.column(1).to_pylist()]):
                counts.append(len(ids))
                ids_sha.append(sha256(ids.tobytes()).hexdigest())
                decoded_sha.append(sha256(codec.decode(ids)).hexdigest())
                if keep_ids:
                    all_ids.append(ids.astype(np.int64))
            columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(tidy(run, keeps=True), schema)
