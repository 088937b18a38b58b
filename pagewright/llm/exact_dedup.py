r"""Exact deduplication as a stateful stream (native: DataFrame functions only).

Method: every document leaves a narrow *locator* (digest, stable identifier, code points, file) in a
table. A stream reads locators and keeps one row of state for each digest, without expiry, in the
disk-backed RocksDB store: the group's size and the locator of the document that stays. Later
streams can continue from the same state. Digest hits are then checked on full bytes: texts are
found by their locators (file and identifier), and each hit's normalised text is compared with the
text that the stored locator names.

Equal: identical after deleting every character of ``[\x20\x09-\x0D]``. Of equal texts the one with
the most code points in its original stays, then the smallest ``doc_id``.

Defined results: null text counts as empty, so null and empty and all-white texts are one group;
rows without a doc_id take part and lose ties; rows that repeat a doc_id with an equal text each
give a row (``exact_dedup``), and one of them is returned by ``keep_first``; an empty table gives an
empty result; other columns are ignored whatever their names. Very long texts are never cut.

Scale: one key may hold a third of all rows. State is updated after a map-side combine. Groups with
more than ``HOT_ROWS`` rows, and more than one in ``HOT_GROUPS`` of all rows, are fewer than
``HOT_GROUPS`` whatever the table, so they are sent to the rows by a broadcast of bounded size; only
rows of the other groups are dealt by digest, none of which is hot. The byte check deals each group
over ``ceil(size / SALT_ROWS)`` salts. The store's settings belong to a session of the stream's own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright import scratch
from pagewright.session import separate

#: Members of a group that one task compares with the kept text.
SALT_ROWS = 4096
#: A group is hot above this many rows, and above one in ``HOT_GROUPS`` of all rows.
HOT_ROWS = 256
HOT_GROUPS = 50_000
#: State on disk; without files that RocksDB makes large beforehand, of which each partition has several,
#: and with one bound on its memory for all partitions of an executor. A partition's store is closed when its task has
#: committed: else an executor keeps all that it has met open, in this stage and beyond it.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "192",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: Column) -> Column:
    """The text without white space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def sha256(norm: Column) -> Column:
    return F.sha2(norm, 256)


def locators(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``(doc_id, digest, n_code, file)``: what is known of a document without its text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        digest(normalised(F.col("text"))).alias("digest"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_code"),
        F.input_file_name().alias("file"),
    )


def stream_groups(narrow: DataFrame, at: str, state: str | None = None) -> DataFrame:
    """Run the stateful stream over the locator table at path ``at``: ``(digest, group_size, best)``.

    ``state``: folder of an earlier run's checkpoint and groups, to go on from; a new one by default.
    """
    spark = narrow.sparkSession
    state = state or scratch.path(spark, "dedup-state")
    own = separate(spark, **STATE_CONF)
    groups = f"{state}/groups"
    best = F.max(F.struct("n_code", F.bitwise_not("doc_id").alias("not_id"), "file")).alias("best")
    stream = own.readStream.schema(narrow.schema).option("maxBytesPerTrigger", str(4 << 30)).parquet(at)
    updates = stream.groupBy("digest").agg(F.count("*").alias("group_size"), best)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # a batch that is run again after a failure overwrites what it had written
        batch.write.mode("overwrite").parquet(f"{groups}/batch={batch_id}")

    query = (
        updates.writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    read = spark.read.schema(updates.schema).parquet(groups)
    # a digest's size and best document only grow from batch to batch
    return read.groupBy("digest").agg(F.max("group_size").alias("group_size"), F.max("best").alias("best"))


def _verdict(narrow: DataFrame, groups: DataFrame) -> DataFrame:
    """``(doc_id, digest, file, keep_id, group_size, keep_file)``: locators with what is known of their groups."""
    limit = max(HOT_ROWS, narrow.count() // HOT_GROUPS)
    hot = groups.select("digest", "group_size", "keep_id", "keep_file").where(F.col("group_size") > limit)
    hot = hot.select(F.struct("*").alias("hot"))
    known = narrow.join(F.broadcast(hot), narrow.digest == F.col("hot.digest"), "left")
    found = known.where("hot is not null").select("doc_id", narrow.digest, "file", "hot.keep_id", "hot.group_size", "hot.keep_file")
    rest = known.where("hot is null").select("doc_id", narrow.digest, "file").join(groups.where(F.col("group_size") <= limit), "digest")
    return found.unionByName(rest.select(*found.columns))


def _differing(docs: DataFrame, verdict: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests under which some document's bytes differ from the kept document's."""
    hits = verdict.where("group_size > 1").dropDuplicates(["doc_id", "file", "digest"])
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.input_file_name().alias("at"), F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(hits, texts.id.eqNullSafe(hits.doc_id) & (texts["at"] == hits.file))
    found = found.withColumn("norm", normalised(F.col("text"))).where(digest(F.col("norm")) == F.col("digest"))  # an id may stand for several texts
    salts = F.ceil(F.col("group_size") / SALT_ROWS).cast("int")
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("at") == F.col("keep_file"))
    found = scratch.table(
        found.select("digest", "norm", salts.alias("salts"), F.pmod(F.xxhash64("id"), salts).cast("int").alias("salt"), kept.alias("kept")), "dedup-hits"
    )
    keepers = found.where("kept").groupBy("digest", "salts").agg(F.first("norm").alias("kept_norm"))
    keepers = keepers.select("digest", "kept_norm", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return found.join(keepers, ["digest", "salt"]).where("norm <> kept_norm").select("digest").distinct()


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    narrow = locators(docs, digest)
    at = scratch.path(docs.sparkSession, "dedup-locators")
    narrow.write.mode("overwrite").parquet(at)
    narrow = docs.sparkSession.read.schema(narrow.schema).parquet(at)
    best = [F.bitwise_not("best.not_id").alias("keep_id"), F.col("best.file").alias("keep_file")]
    groups = scratch.table(stream_groups(narrow, at).select("digest", "group_size", *best), "dedup-groups")
    verdict = scratch.table(_verdict(narrow, groups), "dedup-verdict")
    differing = scratch.table(_differing(docs, verdict, digest), "dedup-differing")
    verdict = verdict.select("doc_id", "digest", "keep_id", "group_size")
    if not differing.isEmpty():
        verdict = _resolved(docs, verdict, differing, digest)
    return verdict.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _resolved(docs: DataFrame, verdict: DataFrame, differing: DataFrame, digest) -> DataFrame:
    """Group anew, by full bytes, the documents whose digest stands for more than one text."""
    norm = normalised(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), norm.alias("norm"), F.length(F.coalesce("text", F.lit(""))).alias("n"))
    rows = rows.withColumn("digest", digest(F.col("norm"))).join(differing, "digest", "left_semi")
    best = F.max(F.struct("n", F.bitwise_not("doc_id").alias("not_id")))
    by_text = rows.groupBy("digest", "norm").agg(F.count("*").alias("group_size"), F.bitwise_not(best["not_id"]).alias("keep_id"))
    again = rows.join(by_text, ["digest", "norm"]).select("doc_id", "digest", "keep_id", "group_size")
    return verdict.join(differing, "digest", "left_anti").select(*again.columns).unionByName(again)


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that exact deduplication drops, with all their columns."""
    verdict = scratch.table(exact_dedup(docs).select("doc_id", "kept", "text_sha256"), "dedup-verdict")
    own = sha256(normalised(F.col("text")))

    def without(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias("_key_id"), F.col("text_sha256").alias("_key_sha")).distinct()
        same = F.col("doc_id").cast("long").eqNullSafe(F.col("_key_id")) & (own == F.col("_key_sha"))
        return rows.join(keys, same, how)

    stay = without(docs, verdict.where("not kept"), "left_anti")
    repeated = scratch.table(verdict.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1"), "dedup-repeated")
    if repeated.isEmpty():
        return stay
    once = without(docs, repeated, "left_semi").withColumn("_sha", own)
    return without(stay, repeated, "left_anti").unionByName(once.dropDuplicates(["doc_id", "_sha"]).drop("_sha"))
