"""Joins with a table that knows how often each of its keys occurs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys with more than one in so many of all counted rows are joined by broadcast: fewer than this many.
SHARE = 1000


def join_counted(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join with a table of one row per key and the number of rows the key has.

    The most frequent keys can be fewer than SHARE, whatever the data, so they are broadcast and their rows stay where they are;
    only the others are shuffled. Both sides are read twice, so they should be written tables.
    """
    total = table.agg(F.sum(count)).scalar()
    hot = F.col(count) * SHARE > total
    large = rows.join(F.broadcast(table.where(hot)), key)
    return large.unionByName(rows.join(table.where(~hot), key))
