"""Exact interpolated percentiles per group, for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.operators.running import ranged, totals_over


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows per key and distinct value, as column `n`; equal values meet before the shuffle."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def percentiles(counts: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """One row per key with a column per probability, from `value_counts`.

    Between two neighbouring values the result is interpolated linearly. `F.percentile`
    holds every distinct value of a group in one task; here running counts tell which two
    values matter, and only those are brought together.
    """
    return percentiles_of(ranged(counts, keys, [value]), keys, value, probs)


def percentiles_of(saved: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """`percentiles` of a table of counts from `ranged`. The rows stay in their slices, hot keys too:
    running counts and group sizes both come from the slices' own sums."""
    ranked = totals_over(saved, keys, [value], {"upto": "n"}, wholes={"_size": "n"})
    picks = []
    for name, prob in probs.items():
        place = (F.col("_size") - 1) * F.lit(prob)
        for end, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            held = (F.col("upto") - F.col("n") <= at) & (at < F.col("upto"))
            picks.append(F.max(F.when(held, F.col(value))).alias(f"_{name}_{end}"))
    found = ranked.groupBy(*keys).agg(*picks, F.max("_size").alias("_size"))

    def between(name: str, prob: float):
        lo, hi = F.col(f"_{name}_lo").cast("double"), F.col(f"_{name}_hi").cast("double")
        place = (F.col("_size") - 1) * F.lit(prob)
        return (lo + (hi - lo) * (place - F.floor(place))).alias(name)

    return found.select(*keys, *[between(n, p) for n, p in probs.items()])
