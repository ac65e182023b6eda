"""Sinks: recommendations as parquet, reports as one text file."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_recommendations(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Flat ``(…, userId, rnk, movieId, title, score)`` rows, clustered by user."""
    df.repartition("userId").sortWithinPartitions("userId", "rnk").write.mode(mode).parquet(path)


def write_report(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Report lines ``(line_no, value)`` as a single text file, in line order.

    A report holds M users x N items, so one output file is the intended shape; the
    lines are ordered by a range exchange and merged into one partition.
    """
    (lines.repartitionByRange(1, "line_no").sortWithinPartitions("line_no")
     .select("value").write.mode(mode).text(path))
