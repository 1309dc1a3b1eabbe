"""Sums of the call log that are kept up to date with it, so that roll-ups need not read the log."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.operators.costs import fine_sums

SUMS = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("agent", "model")],
        *[T.StructField(c, T.LongType()) for c in ("calls", "input_tokens", "output_tokens", "total_tokens")],
        T.StructField("cost_usd", T.DecimalType(28, 8)),
        *[T.StructField(c, T.StringType()) for c in ("batch_id", "wave")],
    ]
)


def save_sums(calls: DataFrame, path: str, batch_id: str, wave: str = "0") -> None:
    """Sums per agent and model of one wave of a run: a row for each.

    The wave owns its folder, so a repeated one replaces its sums and counts nothing twice.
    """
    sums = fine_sums(calls).withColumn("cost_usd", F.col("cost_usd").cast(SUMS["cost_usd"].dataType))
    sums.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}/wave={wave}")


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    """All sums under the path; no rows while nothing has been saved."""
    try:
        return spark.read.schema(SUMS).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SUMS)
