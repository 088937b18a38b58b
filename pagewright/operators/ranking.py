"""Numbering rows in a global order without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright import scratch


def numbered(rows: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """``rows`` with their 1-based place in ``order`` (nulls first; ties by the order of the sort).

    Rows are dealt by ranges of the order and numbered inside each range; a range's first number is
    the sum of the sizes before it. Only those sizes, a row a partition, meet in one task. The dealt
    rows are written first, so that a range is the same whenever it is read.
    """
    dealt = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    dealt = scratch.table(dealt, "numbered")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_range", before.alias("_before"))
    placed = dealt.withColumn("_inside", inside).join(sizes, "_range")
    return placed.withColumn(name, (F.col("_inside") + F.col("_before")).cast("long")).select(*rows.columns, name)
