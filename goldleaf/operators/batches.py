"""Splitting records into batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.operators.running import row_numbers


def numbered_batches(records: DataFrame, id_col: str, size: int = 50) -> DataFrame:
    """Ids with the index of their fixed-size batch, counted in id order."""
    # Copies of an id may be numbered in any order, so they need not stay in one slice.
    spread = records.select(id_col).withColumn("_tie", F.monotonically_increasing_id())
    numbered = row_numbers(spread, [id_col, "_tie"], "_n")
    return numbered.select(id_col, F.floor(F.col("_n") / size).cast("bigint").alias("batch"))


def wave(id_col: str, waves: int) -> Column:
    """Wave of a record: depends on its id alone, so it is the same after a restart."""
    return F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(waves))
