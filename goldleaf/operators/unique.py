"""One row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per(df: DataFrame, keys: list[str], newest: list[str] = (), tie: list[str] | None = None) -> DataFrame:
    """The newest row per key by the given columns; a hash of the `tie` columns settles the rest.

    An aggregate, not a window: copies of a hot key are reduced before the shuffle.
    """
    rank = F.struct(*newest, F.xxhash64(*(tie or df.columns)).alias("_tie"))
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row") if rest else F.max(rank).alias("_row"))
    # The keys come from the grouping, so that what follows can reuse its partitioning.
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])
