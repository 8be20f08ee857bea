"""Sessions for the engine, and the package's way to the Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def session(name: str = "strandloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that results depend on (UTC) and adaptive execution; conf adds or overrides."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in {**defaults, **conf}.items():
        builder = builder.config(k, v)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors once for each context, so that Python workers find it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_strandloom_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="strandloom-")) / "strandloom_package.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._strandloom_shipped = True
    return spark
