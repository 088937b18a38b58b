"""Course rows from pages."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from pagewright.functions import html as H
from pagewright.functions import text as T
from pagewright.functions import url as U
from pagewright.operators import links as L
from pagewright.operators.dedup import first_in_array
from pagewright.providers import AI_FALLBACK, ai_fields
from pagewright.schemas import AI_FIELDS, COURSE_COLUMNS


def manual_fields(pages: DataFrame) -> DataFrame:
    """``page_id, url, course_code, course_title, semester, year, all_files, all_internal_links, manual_page_type``."""
    rows = H.parsed(pages)
    text, anchors = F.col("parsed.visible"), F.col("parsed.anchors")
    files = L.listed(anchors, F.col("url"), lambda a: F.lit(True), lambda a, source: U.is_course_file(a["href"]))
    same = lambda a, source: U.scheme(a["href"]).isin("http", "https") & U.same_domain(a["href"], U.netloc(source))
    inside = L.listed(anchors, F.col("url"), lambda a: ~U.page_skips(a["href"]), same)
    rows = rows.select(
        "page_id", "url", text.alias("visible"), T.course_code(text).alias("course_code"),
        T.page_title(F.col("parsed.h1"), F.col("parsed.h2"), F.col("parsed.title")).alias("course_title"), T.semester(text).alias("semester"),
        T.first_year(text).alias("year"), files.alias("all_files"), inside.alias("all_internal_links"), F.col("parsed.blocks").alias("blocks"),
    )
    for name in ("all_files", "all_internal_links"):
        rows = first_in_array(rows, name, lambda a: a["href"])
        rows = rows.withColumn(name, F.transform(name, lambda a: F.struct(a["href"].alias("href"), a["text"].alias("text"))))
    kind = T.page_type(F.col("visible"), F.col("course_code"), F.col("semester"), F.col("year"), F.col("all_files"), F.col("blocks"))
    return rows.withColumn("manual_page_type", kind).drop("visible", "blocks")


def enriched(fields: DataFrame, provider) -> DataFrame:
    """The provider's fields in a struct ``ai``; the fallback where a call or its answer fails."""
    schema = StructType([*fields.schema.fields, *StructType.fromDDL(f"ai {AI_FIELDS}").fields])
    kind = to_arrow_type(schema["ai"].dataType)

    def call(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                try:
                    found.append(ai_fields(provider.enrich(row)))
                except Exception:  # any failure of an outside call gives the fallback
                    found.append(dict(AI_FALLBACK))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, "ai"])

    return fields.mapInArrow(call, schema)


def merged(rows: DataFrame) -> DataFrame:
    """The course row of each page; code, title, term and year are the model's alone."""
    conflict = T.ai_type(F.col("manual_page_type")) != F.col("ai.ai_page_type")
    flat = rows.select(
        "url", *[F.col(f"ai.{c}") for c in ("course_code", "course_title", "semester", "year")], "manual_page_type",
        *[F.col(f"ai.{c}") for c in COURSE_COLUMNS[6:15]], conflict.alias("conflict_flag"), (conflict | (F.col("ai.ai_confidence") == "low")).alias("recheck_needed"),
        F.to_json("all_files").alias("all_files_json"), F.to_json("all_internal_links").alias("all_internal_links_json"),
    )
    return flat.select(*COURSE_COLUMNS)


def analyze_pages(pages: DataFrame, provider) -> DataFrame:
    """R2: pages to course rows; pages without html give none."""
    return merged(enriched(manual_fields(pages.where("html is not null and html <> ''")), provider))
