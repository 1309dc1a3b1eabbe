"""Readers of the input table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from goldleaf.schemas import SILVER


def read_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A catalog table, or no rows of the given schema while it does not exist."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType = SILVER) -> DataFrame:
    """Files that each hold one JSON list of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def fetch_by_ids(silver: DataFrame, ids: Sequence | DataFrame, id_col: str = "review_id") -> DataFrame:
    """The records with these ids, ordered by id; none for an empty list.

    Ids are data, never part of a query text. No join is hinted: adaptive execution broadcasts
    ids that turn out small.
    """
    if isinstance(ids, DataFrame):
        wanted = ids.select(id_col)
    else:
        kind = silver.schema[id_col].dataType
        wanted = silver.sparkSession.createDataFrame(
            [(i,) for i in ids], T.StructType([T.StructField(id_col, kind)])
        )
    return silver.join(wanted, id_col, "left_semi").orderBy(id_col)
