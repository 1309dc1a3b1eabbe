"""Which records of the input are still to be enriched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.functions.text import non_blank
from goldleaf.plans.agents import EnrichSpec


def not_in(silver: DataFrame, gold_ids: DataFrame | None, id_col: str) -> DataFrame:
    """Records whose id the output does not hold; all of them without an output.

    Null ids stay: they equal nothing. Only the key of the output is read.
    """
    if gold_ids is None:
        return silver
    return silver.join(gold_ids.select(F.col(id_col)), id_col, "left_anti")


def pending(silver: DataFrame, gold_ids: DataFrame | None, spec: EnrichSpec = EnrichSpec()) -> DataFrame:
    """Records with a text that are not in the output yet."""
    return not_in(silver.where(non_blank(F.col(spec.text_col))), gold_ids, spec.id_col)


def fetch_pending(
    silver: DataFrame,
    gold_ids: DataFrame | None,
    spec: EnrichSpec = EnrichSpec(),
    limit: int | None = None,
) -> DataFrame:
    """Pending records by id; a limit of 0 or None takes all.

    With a limit the first ids are found on their own, and only their records are fetched.
    """
    if not limit:
        return pending(silver, gold_ids, spec).orderBy(spec.id_col)
    kept = silver.where(non_blank(F.col(spec.text_col)))
    first = not_in(kept.select(spec.id_col), gold_ids, spec.id_col).orderBy(spec.id_col).limit(limit)
    ids = first.distinct().select(F.col(spec.id_col).alias("_first"))
    hit = kept.join(ids, F.col(spec.id_col).eqNullSafe(F.col("_first")), "left_semi")
    return hit.orderBy(spec.id_col).limit(limit)


def count_pending(silver: DataFrame, gold_ids: DataFrame | None, spec: EnrichSpec = EnrichSpec()) -> DataFrame:
    """Number of records not in the output. Blank texts count here, unlike in `pending`."""
    return not_in(silver.select(spec.id_col), gold_ids, spec.id_col).agg(F.count("*").alias("n"))
