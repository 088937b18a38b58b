r"""Mixing sources to target weights by capped water-filling (native: DataFrame functions only).

Method: the mix holds ``share`` times all words. Each source's target is its weight's part of that,
clamped at ``max_epochs`` times its own size; what a clamp frees is dealt again over the sources that
are not clamped, in proportion to their weights, until no target is above its cap. A document is
then taken ``floor(target / size)`` times, and once more if its seeded hash falls under its source's
threshold. The threshold is found by two rounds of histograms over the hash (4,096 bins, then 4,096
bins inside the crossing one), so the words taken come within the words of a 16-millionth of the
source of the target, instead of a binomial sample's error.

Weights: the sources in code-point order, null last, weigh ``weights`` in turn.

Defined results: null or empty text has size 0 and its document's ``taken`` is 0; a null source is a
source of its own; a source with no words has target 0; null doc_ids hash as the empty string, and
rows with equal doc_ids are taken equally often; an empty table gives an empty result; other columns
are passed over whatever their names. Reruns agree: the hash sees seed and doc_id only.

Scale: sizes are counted once into a narrow table; a hot source is only ever aggregated (map side
first) or joined as the split side of a sort-merge join. The source table (a row a source) is ranked
in one task; bins are at most 4,096 rows a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright import scratch

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
BINS = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def seeded(doc_id: Column, seed: int) -> Column:
    """A number from 0 to 2**32 - 1 that depends on the seed and the document alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to ``(source, source_size, weight)``, the words that the mix should hold of each source."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = F.when(F.col("weight") > 0, cap / F.col("weight"))
    ranked = sources.withColumns({"cap": cap, "level": level})
    # In order of the level at which a source is full: those before k are clamped as long as the
    # water that is left for k and those after it stands above k's own level.
    up_to = Window.orderBy(F.col("level").asc_nulls_last(), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(up_to), F.lit(0.0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(up_to), F.lit(0))
    ranked = ranked.withColumn("water", F.when(weights > 0, left / weights))
    ranked = ranked.withColumn("full", F.coalesce(F.col("level") <= F.col("water"), F.lit(False)))
    free = ranked.withColumn("height", F.min(F.when(~F.col("full"), F.struct("level", "water"))).over(everything)["water"])
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("height") * F.col("weight")))
    return free.withColumn("target", F.coalesce(target, F.lit(0.0))).select(*sources.columns, "target")


def _crossing(rows: DataFrame, bin_: Column, wanted: str) -> DataFrame:
    """For each source the bin at which the words of the bins so far pass ``wanted``, and the words before it."""
    bins = rows.groupBy("source", wanted, bin_.alias("bin")).agg(F.sum("size").alias("words"))
    bins = bins.withColumn("so_far", F.sum("words").over(Window.partitionBy("source").orderBy("bin")))
    first = F.min(F.struct("bin", (F.col("so_far") - F.col("words")).alias("before"), "words")).alias("at")
    return bins.where(F.col("so_far") > F.col(wanted)).groupBy("source", wanted).agg(first)


def sizes(docs: DataFrame, seed: int = 0) -> DataFrame:
    """``(doc_id, source, size, u)``, written once: every later step reads this and no text."""
    hashed, words = seeded(F.col("doc_id"), seed), n_words(F.col("text"))
    return scratch.table(docs.select("doc_id", F.col("source").cast("string").alias("source"), words.alias("size"), hashed.alias("u")), "mix-sizes")


def plan(narrow: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """A row a source: ``of, source_size, target, whole, part, limit``."""
    if share > max_epochs:
        raise ValueError("share may not exceed max_epochs: there are too few words")
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(rank - 1, F.lit(len(weights))) + 1)
    targets = water_fill(sources.withColumn("weight", turn), share, max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("whole", F.floor(ratio))
    targets = targets.withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    targets = scratch.table(targets.withColumnRenamed("source", "of"), "mix-targets")

    coarse, fine = F.floor(F.col("u") / F.lit(1 << 20)), F.floor(F.pmod(F.col("u"), F.lit(1 << 20)) / F.lit(1 << 8))
    rows = narrow.join(targets.select("of", "part"), narrow.source.eqNullSafe(F.col("of"))).drop("of")
    first = _crossing(rows, coarse, "part").select(
        F.col("source").alias("of"), F.col("at.bin").alias("bin"), (F.col("part") - F.col("at.before")).alias("rest")
    )
    first = scratch.table(first, "mix-bins")
    inside = narrow.join(first, narrow.source.eqNullSafe(first.of) & (coarse == F.col("bin"))).drop("of")
    # the document at the crossing is taken if that comes nearer to the target
    over = (2 * (F.col("rest") - F.col("at.before")) >= F.col("at.words")).cast("long")
    second = _crossing(inside, fine, "rest").select(F.col("source").alias("in"), (F.col("at.bin") + over).alias("step"))
    limits = first.join(second, first.of.eqNullSafe(second["in"]), "left")
    limits = limits.select(F.col("of").alias("in"), (F.col("bin") * (1 << 20) + F.coalesce("step", F.lit(0)) * (1 << 8)).alias("limit"))
    return scratch.table(targets.join(limits, targets.of.eqNullSafe(limits["in"]), "left").drop("in"), "mix-plan")


def _repeats(u: Column, pre: str = "") -> Column:
    """How often a document is taken, from its hash and its source's plan."""
    limit, part, size, whole = (F.col(pre + c) for c in ("limit", "part", "source_size", "whole"))
    # no crossing bin: every document's part is wanted, up to rounding, or none is
    once = F.when(limit.isNotNull(), u < limit).otherwise(part >= size)
    return (whole + F.when((part > 0) & once, 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, source, repeats``."""
    narrow = sizes(docs, seed)
    sources = plan(narrow, **options)
    rows = narrow.join(sources, narrow.source.eqNullSafe(sources.of))
    repeats = _repeats(F.col("u"))
    return rows.select(
        "doc_id", "size", "source_size", "target", (repeats * F.col("size")).alias("taken"), "source", repeats.alias("repeats")
    )


def mixed(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    sources = plan(sizes(docs, seed), **options).select(*[F.col(c).alias(f"_mix_{c}") for c in ("of", "source_size", "whole", "part", "limit")])
    rows = docs.join(sources, F.col("source").cast("string").eqNullSafe(F.col("_mix_of")))
    rows = rows.withColumn("_mix_repeats", _repeats(seeded(F.col("doc_id"), seed), "_mix_").cast("int")).where("_mix_repeats > 0")
    return rows.withColumn("_mix_k", F.explode(F.sequence(F.lit(1), F.col("_mix_repeats")))).select(*docs.columns)
