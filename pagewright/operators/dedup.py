"""First-wins deduplication (D-1 to D-8): always by an explicit order, never by arrival."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import url as U


def first_wins(rows: DataFrame, keys: list[str | Column], order: list[str]) -> DataFrame:
    """The row of each key that is first in ``order``.

    The kept row is the least of a struct, so each task keeps one row a key before anything is
    shuffled: a key that a third of all rows share costs no more than any other.
    """
    named = {f"_key{i}": F.col(k) if isinstance(k, str) else k for i, k in enumerate(keys)}
    least = F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")
    return rows.withColumns(named).groupBy(*named).agg(least).select("_row.*")


def first_in_page(rows: DataFrame, keys: list[str | Column], order: list[str]) -> DataFrame:
    """The same within each page, where a key's rows are a page's links at most.

    Rows are dealt by page alone: what follows by page (counts, batches, numbers) needs no other
    shuffle, and columns that nobody reads are pruned before it.
    """
    named = {f"_key{i}": F.col(k) if isinstance(k, str) else k for i, k in enumerate(keys)}
    place = F.row_number().over(Window.partitionBy("page_id", *named).orderBy(*order))
    return rows.repartition("page_id").withColumns(named).withColumn("_place", place).where("_place = 1").drop("_place", *named)


def first_in_array(rows: DataFrame, name: str, key: Callable[[Column], Column]) -> DataFrame:
    """The first element of each ``key`` in the array column ``name``, in order: without a shuffle, in n log n steps a row."""
    keyed = rows.withColumn("_keyed", F.sort_array(F.transform(F.col(name), lambda x, i: F.struct(key(x).alias("key"), i.alias("at")))))
    fresh = F.filter("_keyed", lambda x, i: (i == 0) | ~F.get(F.col("_keyed"), i - 1)["key"].eqNullSafe(x["key"]))
    places = keyed.withColumn("_keyed", F.array_sort(F.transform(fresh, lambda x: x["at"])))
    return places.withColumn(name, F.transform("_keyed", lambda at: F.get(F.col(name), at))).drop("_keyed")


def bucket_dedup(links: DataFrame, order: list[str]) -> DataFrame:
    """D-2, D-3: the first link of each bucket and page-norm."""
    return first_wins(links, ["bucket", U.page_norm(F.col("url"))], order)


def removed_by_bucket(links: DataFrame) -> DataFrame:
    """D-3: how many rows the final deduplication takes out of each bucket."""
    counts = links.groupBy("bucket").agg(F.count("*").alias("n"), F.countDistinct(U.page_norm(F.col("url"))).alias("n_unique"))
    return counts.select("bucket", "n", "n_unique", (F.col("n") - F.col("n_unique")).alias("n_removed"))


def new_rows(rows: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key was not seen before."""
    return rows.join(seen.select(*keys).distinct(), keys, "left_anti")


def material_dedup(items: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """D-6, D-7: by kind and file, or title where there is no file."""
    what = F.coalesce(F.when(F.col("file_url") != "", F.col("file_url")), F.col("title"))
    return first_wins(items, [*group, "item_type", what], order)
