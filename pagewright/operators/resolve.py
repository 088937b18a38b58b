"""Rows that describe the same course."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.operators.components import connected_components


def edges(rows: DataFrame) -> DataFrame:
    """Each row with the first row of its code and of its title; null keys link nothing.

    Stars instead of chains: the same components, and no key's rows have to be sorted in one task.
    """
    def star(key: str) -> DataFrame:
        known = rows.where(F.col(key).isNotNull())
        first = known.groupBy(key).agg(F.min("idx").alias("dst"))
        return known.join(first, key).select(F.col("idx").alias("src"), "dst").where("src <> dst")

    return star("norm_code").unionByName(star("norm_title"))


def components(rows: DataFrame) -> DataFrame:
    """Rows ``(idx, course_code, course_title, year)`` with norms and ``component``, their smallest idx."""
    named = rows.withColumns({
        "norm_code": T.norm_code(F.col("course_code")), "norm_title": T.norm_title(F.col("course_title")), "year_num": T.year_extract(F.col("year")),
    })
    labels = connected_components(edges(named))
    return named.join(labels.select(F.col("node").alias("idx"), "component"), "idx", "left").withColumn("component", F.coalesce("component", "idx"))


def canonical(rows: DataFrame) -> DataFrame:
    """Per component the code of its latest year (first row on ties, first row without any year) and its most frequent title (first on ties)."""
    year = F.when(F.col("year_num") > 0, F.col("year_num")).otherwise(-1)
    latest = rows.groupBy("component").agg(F.min_by(F.struct("course_code"), F.struct(-year, "idx")).alias("latest"))
    counts = rows.where(F.col("course_title").isNotNull()).groupBy("component", "course_title").agg(F.count("*").alias("n"), F.min("idx").alias("first"))
    title = counts.groupBy("component").agg(F.min_by("course_title", F.struct(-F.col("n"), "first")).alias("canonical_title"))
    return latest.select("component", F.col("latest.course_code").alias("canonical_code")).join(title, "component", "left")


def resolved(rows: DataFrame) -> DataFrame:
    """Every row with its component's code and title; helper columns gone (K4)."""
    named = components(rows)
    best = canonical(named)
    out = named.join(best, "component").withColumns({"course_code": F.col("canonical_code"), "course_title": F.col("canonical_title")})
    return out.select(*rows.columns)
