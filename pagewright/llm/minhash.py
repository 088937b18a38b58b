r"""Near-duplicate documents by MinHash over word shingles.

Method: fast similarity sketching. A sketch has ``T`` bins; in round ``i`` every shingle is thrown
into one hashed bin with the value ``(i, hash)``, in round ``T + j`` all go to bin ``j``, and rounds
end when no bin is empty, which at the latest the second ``T`` rounds guarantee. A bin keeps its
least value, so equal bins of two sketches estimate the Jaccard similarity with strong
concentration. Sketches are banded; documents that share a band are candidates; links are confirmed
on full shingle sets.

Words are runs of ``[^\x20\x09-\x0D]`` after lower-casing A-Z; a document's set is its distinct
``width``-word shingles, or its whole word sequence as one if it has fewer words. Documents link if
``100 * intersection >= percent * union``.

Defined results: documents without words, and rows without a doc_id, are linked with nothing (their
component is their own id); rows that repeat a doc_id each give a row by their own text; other
columns are passed over whatever their names; an empty table gives an empty result. Texts are never
cut.

Scale: documents with equal sets are one class, so a group of copies costs one class. In a bucket
every class is first checked against ``LEADERS`` of its classes, those least under as many hashes of
the id (pairs linear in rows; the pairs of a leader that has many are dealt over copies of its row). Only a class that this leaves outside the bucket's largest component
is then compared with the rest of its bucket: in small buckets by pairs that size and sketch leave,
in larger ones by full sets in blocks of about ``BLOCK`` by ``BLOCK`` sets (fewer where sets are large:
about ``BLOCK_SHINGLES`` shingles a side), which return links and no
pairs. So no pair of a bucket is lost, nothing unbounded meets in one task, and there is no cap on
buckets. Per-word hashes are kept in a table that is emptied when it is full; that affects speed only.

Recall: with 32 bands of 4 a pair at the limit of 0.85 is missed with probability
``(1 - 0.85**4)**32 = 6e-11`` (at 0.8 with 5e-8). The sketch filter of leaders' pairs and of buckets
up to ``SMALL`` lets pass what is up to ``SLACK`` standard deviations below the limit, so it loses a pair
at the limit with a probability of about 1e-8 (the normal tail at 5.6; 3e-7 by the binomial of 128
bins); pairs above the limit less often still. Larger buckets are compared without a filter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright import scratch
from pagewright.llm.blocks import fixed, grouped
from pagewright.llm.worker import parts, tidy
from pagewright.operators.components import connected_components

T = 128
ROWS = 4
#: Classes of a bucket that are each compared with all of its classes.
LEADERS = 3
#: A leader is hot above this many pairs, and above one in ``HOT_IDS`` of all pairs.
HOT_PAIRS = 256
HOT_IDS = 50_000
#: Buckets up to this size list the pairs that are left; larger ones are compared block by block.
SMALL = 32
BLOCK = 256
BLOCK_SHINGLES = 1 << 20
#: Shingles that a block is compared by at a time.
COLUMNS = 8192
#: Standard deviations below the limit down to which a sketch's estimate has a pair checked on full sets.
SLACK = 5.6
#: Lower limits need other bands to be found with certainty.
LEAST_PERCENT = 70
#: Entries of a worker's table of word hashes.
WORDS_KEPT = 400_000
#: Bytes of texts that are worked on, and handed on, at a time.
PART = 2 << 20
#: Hash values computed at a time for short documents.
CHUNK = 2048

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public SplitMix64 constants)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


SEEDS = mix(np.arange(1, 2 * T + 1, dtype=U) * U(0x9E3779B97F4A7C15))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes | None, hashes: WordHashes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    # bytes.lower and bytes.split know just A-Z and [\x20\x09-\x0D]
    words = text.lower().split() if text else []
    n = len(words)
    if n < width:
        return np.array([xxhash.xxh3_64_intdigest(b"%d " % n + b" ".join(words))] if n else [], dtype=U)
    one = np.fromiter(map(hashes.__getitem__, words), dtype=U, count=n)
    total = np.zeros(n - width + 1, dtype=U)
    for i in range(width):
        total = mix(total + one[i : n - width + 1 + i] + U(i + 1))
    return np.unique(total)


def sketch(items: np.ndarray) -> np.ndarray:
    """``T`` bins of the round (8 bits) and hash (56 bits) that fill them first."""
    bins = np.full(T, np.iinfo(U).max, dtype=U)
    done = 0
    while done < 2 * T:
        rounds = np.arange(done, min(2 * T, done + max(1, CHUNK // len(items))), dtype=U)
        hashed = mix(items[None, :] ^ SEEDS[rounds.astype(int)][:, None])
        at = np.where(rounds[:, None] < T, hashed & U(T - 1), rounds[:, None] - U(T)).astype(np.intp)
        np.minimum.at(bins, at.ravel(), ((rounds[:, None] << U(56)) | (hashed >> U(8))).ravel())
        done += len(rounds)
        if (bins != np.iinfo(U).max).all():
            break
    return bins


def bands(bins: np.ndarray) -> np.ndarray:
    rows = bins.reshape(-1, ROWS)
    keys = np.arange(1, len(rows) + 1, dtype=U)
    for i in range(ROWS):
        keys = mix(keys * U(0x9E3779B97F4A7C15) + rows[:, i])
    return keys.view(np.int64)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, print, bands, sketch``; the last three null where nothing can be linked."""
    schema = "doc_id long, n_shingles long, print binary, bands array<long>, sketch binary"
    arrow = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for part in (p for batch in batches for p in parts(batch, 1, PART)):
            ids = part.column(0).to_pylist()
            out: list[tuple] = []
            for doc_id, text in zip(ids, part.column(1).to_pylist(), strict=True):
                items = shingle_set(text, hashes, width)
                if doc_id is None or not len(items):
                    out.append((len(items), None, None, None))
                    continue
                bins = sketch(items)
                out.append((len(items), blake2b(items.tobytes(), digest_size=16).digest(), bands(bins), bins.astype(np.uint8).tobytes()))
            sizes, prints, keys, small = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(small, pa.binary())], schema=arrow)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(tidy(run), schema)


def shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """``(id, set)`` of the rows ``(id, print, text)`` whose text has that print."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for part in (p for batch in batches for p in parts(batch, 2, PART)):
            ids, sets = [], []
            for doc_id, print_, text in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                items = shingle_set(text, hashes, width)
                if blake2b(items.tobytes(), digest_size=16).digest() == print_:
                    ids.append(doc_id)
                    sets.append(items.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])

    return texts.select("id", "print", F.col("text").cast("binary").alias("text")).mapInArrow(tidy(run), "id long, set array<long>")


def _near(share: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether full sets have to be compared: sizes are near enough, and so are sketches."""
    limit = percent / 100
    floor = limit - SLACK * (limit * (1 - limit) / T) ** 0.5
    return (share >= floor * T) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))


def _hot(pairs: DataFrame) -> DataFrame:
    """``(b, salts)`` of ids that are in more than ``HOT_PAIRS`` pairs and in more than one in ``HOT_IDS`` of all: fewer than ``HOT_IDS``."""
    limit = max(HOT_PAIRS, pairs.count() // HOT_IDS)
    counts = pairs.groupBy("b").agg(F.ceil(F.count("*") / limit).cast("long").alias("salts")).where("salts > 1")
    return scratch.table(counts, "minhash-hot")


def _attached(pairs: DataFrame, side: str, own: DataFrame, hot: DataFrame | None) -> DataFrame:
    """``pairs`` with the columns of ``own`` for the id in ``side``; rows of a hot id are dealt over as many copies of its row."""
    if hot is None:
        return pairs.join(own, side)
    known = F.broadcast(hot.select(F.col("b").alias(side), "salts"))  # of bounded size
    salts = F.coalesce("salts", F.lit(1))
    dealt = pairs.join(known, side, "left").withColumn("salt", F.pmod(F.xxhash64("a", "b"), salts)).drop("salts")
    copies = own.join(known, side, "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("salts")
    return dealt.join(copies, [side, "salt"]).drop("salt")


def _likely(pairs: DataFrame, classes: DataFrame, percent: int, hot: DataFrame | None = None) -> DataFrame:
    """Pairs ``(a, b)`` that sizes and sketches leave; ``hot``: of the ids ``b``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                equal = (fixed(batch.column("sa"), "u1", T) == fixed(batch.column("sb"), "u1", T)).sum(axis=1)
                near = _near(equal, batch.column("na").to_numpy(), batch.column("nb").to_numpy(), percent)
                yield batch.select(["a", "b"]).filter(pa.array(near))

    for side in "ab":
        own = classes.select(F.col("id").alias(side), F.col("n_shingles").alias(f"n{side}"), F.col("sketch").alias(f"s{side}"))
        pairs = _attached(pairs, side, own, hot if side == "b" else None)
    sized = pairs.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    return sized.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, hot: DataFrame | None = None) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    for side in "ab":
        own = sets.select(F.col("id").alias(side), F.col("set").alias(f"set_{side}"))
        pairs = _attached(pairs, side, own, hot if side == "b" else None)
    both = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - both
    return pairs.where(100 * both >= percent * either).select("a", "b")


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``(key, id, own, major, m, strays, n, stray_n)`` of buckets that hold several components; major: the largest there, n: shingles."""
    known = members.select("key", "id", "n").join(labels.select(F.col("node").alias("id"), F.col("component").alias("own")), "id", "left")
    known = scratch.table(known.select("key", "id", "n", F.coalesce("own", "id").alias("own")), "minhash-known")
    parts = known.groupBy("key", "own").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    top = F.max(F.struct("m", "own", "n")).alias("top")
    parts = parts.groupBy("key").agg(top, F.sum("m").alias("m"), F.sum("n").alias("n"), F.count("*").alias("parts")).where("parts > 1")
    rest = [(F.col(c) - F.col(f"top.{c}")).alias(name) for c, name in (("m", "strays"), ("n", "stray_n"))]
    opened = parts.select("key", F.col("top.own").alias("major"), "m", "n", *rest)
    return scratch.table(known.drop("n").join(scratch.table(opened, "minhash-opened"), "key"), "minhash-open")


def _pairs_in_small(opened: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Likely pairs ``(a, b)`` of different components in buckets of at most ``SMALL`` classes."""

    def handle(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, own, n = (table[c].to_numpy() for c in ("id", "own", "n_shingles"))
        small = fixed(table["sketch"], "u1", T)
        found: list[np.ndarray] = []
        for low, high in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
            part = slice(low, high)
            equal = (small[part][:, None, :] == small[part][None, :, :]).sum(axis=2)
            near = _near(equal, n[part][:, None], n[part][None, :], percent) & (own[part][:, None] != own[part][None, :])
            p, q = np.nonzero(np.triu(near, 1))
            found.append(np.stack([ids[part][p], ids[part][q]]))
        pairs = np.concatenate(found, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs.min(axis=0)), pa.array(pairs.max(axis=0))], names=["a", "b"])

    rows = opened.where(F.col("m") <= SMALL).select("key", "id", "own").join(classes.select("id", "n_shingles", "sketch"), "id")
    return grouped(rows, ["key"], handle, "a long, b long").distinct()


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The size of the intersection of each set on the left with each on the right."""
    sets = left + right
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    for low in range(0, int(column[-1]) + 1, COLUMNS):
        part = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        held = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        held[owner[part], column[part] - low] = 1
        out += (held[: len(left)] @ held[len(left) :].T).astype(np.int64)  # a part's counts are exact
    return out


def _links_in_large(opened: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` of strays in buckets of more than ``SMALL`` classes, checked on full sets block by block.

    A stray gives one link for each component that it is linked with in a block, so what comes out
    is linear in what goes in even where thousands of documents are almost similar enough.
    """
    rows = F.ceil(F.greatest(F.col("strays") / BLOCK, F.col("stray_n") / BLOCK_SHINGLES)).cast("long")
    cols = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("n") / BLOCK_SHINGLES)).cast("long")
    cells = opened.where(F.col("m") > SMALL).join(sets, "id").withColumns({"rows": rows, "cols": cols, "hash": F.xxhash64("id")})
    row, col = F.pmod("hash", "rows").cast("long").alias("i"), F.pmod("hash", "cols").cast("long").alias("j")
    zero = F.lit(0).cast("long")
    each = F.transform(F.sequence(zero, F.col("rows") - 1), lambda i: F.struct(i.alias("i"), col, F.lit(0).alias("stray")))
    stray = F.transform(F.sequence(zero, F.col("cols") - 1), lambda j: F.struct(row, j.alias("j"), F.lit(1).alias("stray")))
    spots = F.explode(F.when(F.col("own") == F.col("major"), each).otherwise(F.concat(each, stray))).alias("at")
    dealt = cells.select("key", spots, "id", "own", "set").select("key", "at.i", "at.j", "at.stray", "id", "own", "set")

    def handle(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, own, stray = (table[c].to_numpy() for c in ("id", "own", "stray"))
        found: list[tuple[int, int]] = []
        for low, high in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
            x, y = (low + np.flatnonzero(stray[low:high] == k) for k in (1, 0))
            if not len(x) or not len(y):
                continue
            held = [np.asarray(s.values) for s in table["set"].slice(low, high - low)]
            left, right = [held[i - low] for i in x], [held[i - low] for i in y]
            both = _overlaps(left, right)
            either = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - both
            linked = (100 * both >= percent * either) & (own[x][:, None] != own[y][None, :])
            for p in np.flatnonzero(linked.any(axis=1)):
                q = np.flatnonzero(linked[p])
                _, first = np.unique(own[y[q]], return_index=True)
                found.extend((int(ids[x[p]]), int(ids[y[k]])) for k in q[first])
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return grouped(dealt, ["key", "i", "j"], handle, "a long, b long")


def _more_links(opened: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links ``(a, b)`` that the leaders left over, by the ways that the sizes of the open buckets ask for; none: no bucket is open."""
    least, most = opened.agg(F.min("m"), F.max("m")).first()
    ways = []
    if least is not None and least <= SMALL:
        ways.append(_confirmed(_pairs_in_small(opened, classes, percent), sets, percent))
    if most is not None and most > SMALL:
        ways.append(_links_in_large(opened, sets, percent))
    return scratch.table(reduce(DataFrame.unionByName, ways), "minhash-links") if ways else None


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    if percent < LEAST_PERCENT:
        raise ValueError(f"percent under {LEAST_PERCENT}: the bands would miss pairs")
    sigs = scratch.table(signatures(docs, width), "minhash-signatures")
    linkable = sigs.where("print is not null")
    first = F.min(F.struct("doc_id", "n_shingles", "bands", "sketch")).alias("first")  # a map-side combine leaves a row a print and task
    classes = linkable.groupBy("print").agg(first).select(F.col("first.doc_id").alias("id"), "print", "first.n_shingles", "first.bands", "first.sketch")
    classes = scratch.table(classes, "minhash-classes")

    banded = classes.select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    least = [F.min(F.struct(F.xxhash64(F.lit(i), "id"), "id"))["id"] for i in range(LEADERS)]
    buckets = banded.groupBy("key").agg(F.array(*least).alias("leaders"), F.count("*").alias("m")).where("m > 1")
    members = scratch.table(banded.join(scratch.table(buckets, "minhash-buckets"), "key"), "minhash-members")

    wanted = members.select("id").distinct().join(classes.select("id", "print"), "id")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(wanted, "id")
    sets = scratch.table(shingle_sets(texts, width), "minhash-sets")

    led = members.select("id", F.explode("leaders").alias("leader")).where("id <> leader")
    pairs = scratch.table(led.select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct(), "minhash-pairs")
    hot = _hot(pairs)
    links = scratch.table(_confirmed(_likely(pairs, classes, percent, hot), sets, percent, hot), "minhash-links")
    labels = connected_components(links, "a", "b")
    more = _more_links(_open_buckets(members, labels), classes, sets, percent)
    if more is not None and not more.isEmpty():
        labels = connected_components(links.unionByName(more), "a", "b")

    labels = labels.select(F.col("node").alias("id"), "component")
    component = classes.join(labels, "id", "left").select("print", F.coalesce("component", "id").alias("component"))
    out = sigs.select("doc_id", "n_shingles", "print").join(component, "print", "left")
    out = out.withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the one with the smallest doc_id."""
    found = near_duplicates(docs, width, percent)
    dropped = found.where("not kept").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, docs.doc_id == F.col("_dropped"), "left_anti")
