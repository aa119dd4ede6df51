"""Result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def metric_lines(metrics: DataFrame) -> DataFrame:
    """One text line ``model metric: value`` per metric row, to four decimals."""
    return metrics.select(
        F.format_string("%s %s: %.4f", "model", "metric", "value").alias("value")
    )


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Write the metric table as Parquet and as text lines below ``path``.

    The lines come from the written table, so that the metrics are computed once.
    """
    metrics.write.parquet(f"{path}/table")
    written = metrics.sparkSession.read.schema(metrics.schema).parquet(f"{path}/table")
    metric_lines(written).write.text(f"{path}/lines")
