r"""Near-duplicate embeddings by Euclidean p-stable hashing.

Method: vectors are brought to unit length, so that cosine ``c`` is the distance ``sqrt(2 - 2c)``. A
hash is ``floor((a . v + b) / WIDTH)`` with normal ``a`` and uniform ``b``; ``k`` hashes make a
table's bucket, and a pair is a candidate if it shares a bucket in any of ``l`` tables. Candidates
are confirmed by their cosine in double precision.

``k`` grows with the logarithm of the number of vectors so that unrelated vectors fill a bucket with
about ``FILL`` members; ``l`` follows from the wanted miss probability at the limit (``MISS``); both
come from the collision probability of p-stable hashing, none from the data. Projections are sums of
integers that doubles hold exactly, so the same vector has the same hashes wherever it is computed.

Tables are taken in rounds of as many as ``ROUND_BYTES`` of copied vectors allow (one at least). A
round is a job of its own, whose shuffle files go when it ends, so disk holds the table twice (as
read, and its classes) and one round, however many tables there are. The copies that are sent in all
are ``l`` of each vector: ``l`` grows as the number of vectors to the power of 0.27.

Links are counted without listing pairs: bitwise equal vectors are one class with a weight; buckets
are cut into blocks of about ``BLOCK`` classes, and every pair of blocks of a bucket is compared once
by a matrix product. A pair that shares several buckets counts in the first of its tables only. A
block pair returns each vector's number of links and one edge a vector to what it is linked with
inside, from which components follow.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components is
linked with nothing, as is a row without a vec_id (component null); vectors of each length are
compared among themselves, in rounds of their own; rows of a length that repeat a vec_id are vectors
of their own that share an id, so their counts are added; labels and other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright import scratch
from pagewright.llm.blocks import fixed, grouped
from pagewright.operators.components import connected_components
from pagewright.session import separate

WIDTH = 2.5
FILL = 512
MISS = 2.5e-4
BLOCK = 1024
#: Copies of vectors that a round may hold on disk, beyond those of one table.
ROUND_BYTES = 256 << 20
#: A round's shuffle files are deleted at its end; its frames are used once.
ROUND_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Fixed-point steps of a unit vector's component and of a projection's.
STEP = float(1 << 20)


def collision(distance: float) -> float:
    """Probability that one p-stable hash of ``WIDTH`` agrees at a distance."""
    r = WIDTH / distance
    normal = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def parameters(n: int, cosine: float) -> tuple[int, int]:
    """``(k, l)`` for ``n`` vectors."""
    far = collision(math.sqrt(2))
    k = max(4, math.ceil(math.log(max(n, 2) / FILL) / -math.log(far)))
    near = collision(math.sqrt(2 - 2 * cosine)) ** k
    return k, math.ceil(math.log(MISS) / math.log1p(-near))


class Hashes:
    """The projections of ``l`` tables of ``k`` hashes for vectors of one dimension."""

    def __init__(self, dim: int, k: int, l: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.k, self.l = k, l
        self.planes = np.rint(rng.standard_normal((dim, k * l)) * STEP)
        self.shift = np.rint(rng.uniform(0, WIDTH, k * l) * STEP * STEP)
        self.salt = rng.integers(1, 1 << 62, k, dtype=np.int64).astype(np.uint64) | np.uint64(1)

    def buckets(self, unit: np.ndarray, low: int, high: int) -> np.ndarray:
        """The bucket number of each row in each of the tables from ``low`` to before ``high``."""
        part = slice(low * self.k, high * self.k)
        projected = np.rint(unit * STEP) @ self.planes[:, part] + self.shift[part]
        cells = np.floor(projected / (WIDTH * STEP * STEP)).astype(np.int64).astype(np.uint64).reshape(len(unit), high - low, self.k)
        mixed = np.zeros(cells.shape[:2], dtype=np.uint64)
        for i in range(self.k):
            mixed = (mixed ^ (cells[:, :, i] * self.salt[i])) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return mixed.view(np.int64)


def unit_rows(raw: np.ndarray) -> np.ndarray:
    wide = raw.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def _compare(a: np.ndarray, b: np.ndarray, same: bool, tables: np.ndarray, hashes: Hashes, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of ``a`` and ``b`` that are linked and do not share a table before ``tables``."""
    p, q = np.nonzero(np.triu(a @ b.T >= cosine, 1) if same else a @ b.T >= cosine)
    if len(p) and tables:
        rows, at_p = np.unique(p, return_inverse=True)
        cols, at_q = np.unique(q, return_inverse=True)
        ha, hb = hashes.buckets(a[rows], 0, tables), hashes.buckets(b[cols], 0, tables)
        fresh = np.ones(len(p), dtype=bool)
        for low in range(0, len(p), 1 << 16):
            part = slice(low, low + (1 << 16))
            fresh[part] = ~(ha[at_p[part]] == hb[at_q[part]]).any(axis=1)
        p, q = p[fresh], q[fresh]
    return p, q


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    value = F.col(vector_col)
    narrow = vectors.select(F.col(id_col).cast("long").alias("vec_id"), value.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    some = F.exists("v", lambda x: x != 0)
    sound = narrow.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad & some)
    code = "<f8" if dict(vectors.dtypes)[vector_col] == "array<double>" else "<f4"
    unsound = F.col("vec_id").isNull() | F.col("v").isNull() | F.coalesce(bad, F.lit(True)) | ~F.coalesce(some, F.lit(False))
    rows = narrow.where(unsound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for length in sorted(r["n"] for r in sound.select(F.size("v").alias("n")).distinct().collect()):
        rows = rows.unionByName(_of_length(sound.where(F.size("v") == length), length, code, cosine))
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _of_length(sound: DataFrame, dim: int, code: str, cosine: float) -> DataFrame:
    """``vec_id, n_links, component_id`` of sound vectors ``(vec_id, v)`` of one length."""

    def pack(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).flatten().to_numpy().astype(code).reshape(-1, dim) + 0  # no negative zeros
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in raw], pa.binary())], names=["vec_id", "v"])

    own = separate(sound.sparkSession, **ROUND_CONF)
    packed = sound.mapInArrow(pack, "vec_id long, v binary").withColumn("print", F.unhex(F.sha2("v", 256)))
    packed = scratch.table(packed, "embed-packed", own)
    classes = packed.groupBy("print").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.first("v").alias("v"))
    classes = scratch.table(classes, "embed-classes")
    n = classes.count()
    k, l = parameters(n, cosine)
    together = max(1, ROUND_BYTES // (max(n, 1) * (dim * np.dtype(code).itemsize + 32)))

    def hashed(low: int, high: int) -> DataFrame:
        """Each class in each of the tables from ``low`` to before ``high``."""

        def keys(batches) -> Iterator[pa.RecordBatch]:
            hashes = Hashes(dim, k, l)
            tables = np.arange(low, high, dtype=np.int64)
            for batch in batches:
                for first in range(0, batch.num_rows, 2048):
                    part = batch.slice(first, 2048)
                    found = hashes.buckets(unit_rows(fixed(part.column(0), code, dim)), low, high)
                    rows = pa.array(np.arange(part.num_rows).repeat(len(tables)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.tile(tables, part.num_rows)), pa.array(found.ravel()), part.column(1).take(rows), part.column(2).take(rows), part.column(0).take(rows)],
                        names=["table", "bucket", "id", "weight", "v"],
                    )

        return classes.select("v", "id", "weight").mapInArrow(keys, "table long, bucket long, id long, weight long, v binary")

    def cells_of(low: int, high: int) -> DataFrame:
        rows = hashed(low, high)
        large = rows.groupBy("table", "bucket").agg(F.count("*").alias("m")).where(F.col("m") > BLOCK)
        large = scratch.table(large.select("table", "bucket", F.ceil(F.col("m") / BLOCK).alias("blocks")), "embed-large")
        cells = rows.join(large, ["table", "bucket"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        cells = cells.withColumn("own", F.pmod(F.xxhash64("id"), "blocks"))
        cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        return cells.select("table", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "weight", "v")

    def handle(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(dim, k, l)
        tables, i, j, own, ids, weights = (table[c].to_numpy() for c in ("table", "i", "j", "own", "id", "weight"))
        sizes = np.diff(np.append(starts, table.num_rows))
        out: list[list] = [[], [], []]
        for low, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            unit = unit_rows(fixed(table["v"].slice(low, n), code, dim))
            rows = np.arange(low, low + n)
            if i[low] == j[low]:
                left = right = rows
                p, q = _compare(unit, unit, True, int(tables[low]), hashes, cosine)
            else:
                is_left = own[low : low + n] == i[low]
                left, right = rows[is_left], rows[~is_left]
                p, q = _compare(unit[is_left], unit[~is_left], False, int(tables[low]), hashes, cosine)
            if not len(p):
                continue
            p, q = left[p], right[q]
            links, root = np.zeros(n, dtype=np.int64), ids[low : low + n].copy()
            p, q = p - low, q - low
            np.add.at(links, p, weights[low + q])
            np.add.at(links, q, weights[low + p])
            while True:  # each takes the least id that it is linked with, until none changes
                least = np.minimum(root[p], root[q])
                if (root[p] == least).all() and (root[q] == least).all():
                    break
                np.minimum.at(root, p, least)
                np.minimum.at(root, q, least)
            linked = np.flatnonzero(links)
            for col, values in zip(out, (low + linked, links[linked], root[linked]), strict=True):
                col.append(values)
        if out[0]:
            at, n_links, roots = (np.concatenate(col) for col in out)
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(n_links), pa.array(roots)], names=["id", "n", "root"])

    at = scratch.path(own, "embed-found")
    schema = "id long, n long, root long"
    for low in range(0, l, together):
        cells = cells_of(low, min(l, low + together))
        grouped(cells, ["table", "bucket", "i", "j"], handle, schema).write.mode("overwrite").parquet(f"{at}/round={low}")
    found = own.read.schema(schema).parquet(at).select("id", "n", "root")
    labels = connected_components(found, "id", "root")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    known = classes.select("print", "id", "weight").join(counts, "id", "left").join(labels.select(F.col("node").alias("id"), "component"), "id", "left")
    known = known.select("print", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    known = packed.select("vec_id", "print").join(scratch.table(known, "embed-known"), "print").select("vec_id", "n_links", "component_id")
    return scratch.table(known, "embed-links", sound.sparkSession)
