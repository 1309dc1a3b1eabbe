"""The call log: JSON lines, one folder per run."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.schemas import CALL_LOG


def append_calls(calls: DataFrame, path: str, batch_id: str, wave: str = "0") -> None:
    """Add the calls of one wave of a run.

    The wave owns its folder, so repeating it adds nothing twice.
    """
    lines = calls.drop("batch_id").withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    )
    lines.write.mode("overwrite").json(f"{path}/batch_id={batch_id}/wave={wave}")


def read_calls(spark: SparkSession, path: str) -> DataFrame:
    """All calls under the path, or no rows while nothing has been logged."""
    raw = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType)
            for f in CALL_LOG
        ]
    )
    try:
        # Run ids can look like numbers; the given schema keeps them text.
        lines = spark.read.schema(raw).json(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CALL_LOG)
    return lines.select(
        F.to_timestamp("timestamp").alias("timestamp"), *[f.name for f in CALL_LOG][1:]
    )
