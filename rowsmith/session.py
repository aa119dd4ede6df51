"""Session settings the library relies on; cluster sizing stays with the caller."""

from __future__ import annotations

from pyspark.sql import SparkSession

ENGINE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM interprets methods above 8000 bytes. Wide projections generate such methods
    # unless Spark is told to split them, and then run several times slower.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    app_name: str = "rowsmith",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Create or reuse a session. ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
