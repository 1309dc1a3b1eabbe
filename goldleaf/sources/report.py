"""Sink for the one-row summary report."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(report: DataFrame, path: str) -> None:
    """Write the report, a single row by construction, as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)
