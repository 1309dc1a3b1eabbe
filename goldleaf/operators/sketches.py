"""Quantiles, distinct counts and frequent values as sketches that are saved per part and merged, so old rows are never read again.

The exact operators stay the default; these are for tables that grow by parts too large to be read anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.session import written

#: Size of a quantile sketch: ranks are off by about 1.3 % at most, with a confidence of 99 %.
QUANTILE_K = 200
RANK_ERROR = 0.0133
#: Registers of a distinct count as a power of two: a standard error of 1.6 %.
DISTINCT_LOG = 12
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_LOG / 2)
#: Values a sketch of frequent ones tracks, and the share of all rows its counts may be off by.
TRACKED = 4096
COUNT_ERROR = 3.5 * 0.75 / TRACKED


def quantile_sketches(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One sketch per key; combined per task before the shuffle."""
    kept = rows.where(F.col(value).isNotNull())
    return kept.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(QUANTILE_K)).alias("sketch"))


def merged_quantiles(keys: list[str], *parts: DataFrame) -> DataFrame:
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, wanted: dict[str, float]) -> DataFrame:
    """The number of values, and the quantiles by name."""
    found = {name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))) for name, q in wanted.items()}
    return sketches.withColumns({"n": F.kll_sketch_get_n_double("sketch"), **found}).drop("sketch")


def distinct_sketches(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(DISTINCT_LOG)).alias("sketch"))


def merged_distinct(keys: list[str], *parts: DataFrame) -> DataFrame:
    """United sketches; one that is united twice changes nothing."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct(sketches: DataFrame) -> DataFrame:
    return sketches.withColumn("n", F.hll_sketch_estimate("sketch")).drop("sketch")


def frequent_sketches(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One sketch per key and the number of its values."""
    kept = rows.where(F.col(value).isNotNull())
    made = F.call_function("approx_top_k_accumulate", F.col(value), F.lit(TRACKED))
    return kept.groupBy(*keys).agg(made.alias("sketch"), F.count("*").alias("rows"))


def merged_frequent(keys: list[str], *parts: DataFrame) -> DataFrame:
    every = reduce(DataFrame.unionByName, parts)
    merged = F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(TRACKED))
    return every.groupBy(*keys).agg(merged.alias("sketch"), F.sum("rows").alias("rows"))


def _ranked(counts: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc("n"), value)
    return counts.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def top_values(rows: DataFrame, sketches: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """The k most frequent values of each key with their exact counts, and `proven`.

    The sketches name the candidates, at most TRACKED of a key, and only their rows are counted. What a
    sketch does not list occurs at most 2 * COUNT_ERROR of the key's rows, or as often as the last it
    lists. A key whose k-th value is not above that is not `proven` by its sketch: all its values are counted.
    """
    listed = sketches.select(*keys, "rows", F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(TRACKED)).alias("_list"))
    full = F.when(F.size("_list") >= TRACKED, F.array_min(F.transform("_list", lambda x: x["count"]))).otherwise(0)
    limits = written(
        listed.select(*keys, F.greatest(full, F.ceil(2 * COUNT_ERROR * F.col("rows"))).alias("_limit"), "_list"), "candidates"
    )
    named = limits.select(*keys, F.explode(F.transform("_list", lambda x: x["item"])).alias(value))
    counted = rows.join(named, [*keys, value], "left_semi").groupBy(*keys, value).agg(F.count("*").alias("n"))
    first = written(_ranked(counted, keys, value, k), "first")
    # A row per key.
    last = first.where(F.col("place") == k).select(*keys, F.col("n").alias("_last"))
    judged = limits.drop("_list").join(last, keys, "left").select(*keys, (F.coalesce("_last", F.lit(0)) > F.col("_limit")).alias("proven"))
    proven = first.join(judged.where("proven"), keys)
    open_keys = judged.where(~F.col("proven")).select(*keys)
    rest = rows.where(F.col(value).isNotNull()).join(open_keys, keys, "left_semi").groupBy(*keys, value).agg(F.count("*").alias("n"))
    return proven.unionByName(_ranked(rest, keys, value, k).withColumn("proven", F.lit(False)))
