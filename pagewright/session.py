"""Session helper, and shipping of this package to executors."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent


def get_spark(app: str = "pagewright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every query of this package expects (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def separate(spark: SparkSession, **conf: str) -> SparkSession:
    """A session with the SQL settings of ``spark`` and those given, which no query of ``spark`` sees."""
    own = spark.newSession()
    for row in spark.sql("SET").collect():
        if row["key"].startswith("spark.sql.") and spark.conf.isModifiable(row["key"]):
            own.conf.set(row["key"], row["value"])
    for key, value in conf.items():
        own.conf.set(key, value)
    return own


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Executors need not share a file system with the driver: Spark's own file server hands the
    archive out, so Python workers can import the package wherever they run.
    """
    context = spark.sparkContext
    if getattr(context, "_pagewright_shipped", False):
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(PACKAGE.rglob("*.py")):
            archive.write(path, f"{PACKAGE.name}/{path.relative_to(PACKAGE)}")
    folder = tempfile.mkdtemp(prefix="pagewright-")
    target = os.path.join(folder, "pagewright_src.zip")
    Path(target).write_bytes(buffer.getvalue())
    context.addPyFile(target)
    context._pagewright_shipped = True
