"""Analysis of the output table: one lazy frame per figure or table.

Columns are pruned to what each needs, counts are reduced before any shuffle, and top-k
lists never sort more than k rows per task. Where counts are used twice they are written in
between, so that the output table itself is read once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.operators.percentiles import percentiles, percentiles_of, value_counts
from goldleaf.operators.running import SLICE, ranged
from goldleaf.schemas import CONFIDENCE_THRESHOLD, ENTITY_COLUMNS, SENTIMENTS
from goldleaf.session import written

ENRICHED = ["sentiment", "sentiment_confidence", "category", "subcategory", *ENTITY_COLUMNS]
BINS = 20


def overview(gold: DataFrame) -> DataFrame:
    failed = F.col("enrichment_error").cast("int")
    return gold.agg(
        F.count("*").alias("records"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.coalesce(F.sum(failed), F.lit(0)).alias("errors"),
        F.avg(failed).alias("error_rate"),
    )


def null_rates(gold: DataFrame) -> DataFrame:
    """Share of nulls per enrichment column, all in one pass."""
    rates = gold.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in ENRICHED])
    return rates.unpivot([], ENRICHED, "column_name", "null_rate")


def counts(gold: DataFrame, column: str) -> DataFrame:
    """Rows per value, nulls left out."""
    return gold.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def shares(gold: DataFrame, column: str) -> DataFrame:
    """Share of each value among non-null rows, to 4 places."""
    per_value = written(counts(gold, column), "counts")
    total = per_value.select(F.sum("n")).scalar()
    return per_value.select(column, F.round(F.col("n") / total, 4).alias("share"))


def top(per_value: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value."""
    return per_value.orderBy(F.desc("n"), column).limit(k)


def top_categories(gold: DataFrame, k: int = 15) -> DataFrame:
    return top(counts(gold, "category"), "category", k)


def _pairs(gold: DataFrame, column: str) -> DataFrame:
    """Rows per category and another column's value."""
    known = gold.where(F.col("category").isNotNull())
    return written(known.groupBy("category", column).agg(F.count("*").alias("n")), "pairs")


def category_sentiment(gold: DataFrame, k: int = 8) -> DataFrame:
    """Sentiment counts and percentages within each of the k top categories.

    A sentiment that never occurs still gets its column.
    """
    per_pair = _pairs(gold, "sentiment")
    # Sizes count rows without a sentiment too; the percentages do not.
    best = per_pair.groupBy("category").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "category").limit(k)
    table = (
        per_pair.where(F.col("sentiment").isNotNull())
        .join(F.broadcast(best.select("category")), "category", "left_semi")
        .groupBy("category")
        .pivot("sentiment", SENTIMENTS)
        .agg(F.sum("n"))
        .na.fill(0, SENTIMENTS)
    )
    total = reduce(lambda a, b: a + b, [F.col(s) for s in SENTIMENTS])
    return table.select(
        "category", *SENTIMENTS, *[(F.col(s) / total * 100).alias(f"{s}_pct") for s in SENTIMENTS]
    )


def top_subcategories(gold: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent subcategories within the most frequent category."""
    per_pair = _pairs(gold, "subcategory")
    first = per_pair.groupBy("category").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "category").limit(1)
    within = per_pair.where(F.col("subcategory").isNotNull()).join(
        F.broadcast(first.select("category")), "category", "left_semi"
    )
    return top(within.select("subcategory", "n"), "subcategory", k)


def _scored(gold: DataFrame) -> DataFrame:
    return gold.select("sentiment", "sentiment_confidence").dropna()


def median_confidence(gold: DataFrame) -> DataFrame:
    per_value = value_counts(_scored(gold), ["sentiment"], "sentiment_confidence")
    medians = percentiles(per_value, ["sentiment"], "sentiment_confidence", {"median": 0.5})
    return medians.select("sentiment", F.round("median", 3).alias("median_confidence"))


def confidence_histogram(gold: DataFrame, bins: int = BINS) -> DataFrame:
    """Counts in equal bins over each sentiment's own range, the last bin closed.

    A value is put by the bin edges themselves, which for values on an edge is not always
    what the scaled position says.
    """
    per_value = written(value_counts(_scored(gold), ["sentiment"], "sentiment_confidence"), "counts")
    low, high = F.min("sentiment_confidence"), F.max("sentiment_confidence")
    # Sentiments are a fixed domain of three.
    ranges = (
        per_value.groupBy("sentiment")
        .agg(low.alias("lo"), high.alias("hi"))
        .select(
            "sentiment",
            F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
        .withColumn("step", (F.col("hi") - F.col("lo")) / bins)
    )
    value, lo, step = F.col("sentiment_confidence"), F.col("lo"), F.col("step")
    edge = lambda i: i * step + lo
    guess = F.least(F.floor((value - lo) / (F.col("hi") - lo) * bins).cast("int"), F.lit(bins - 1))
    placed = (
        per_value.join(F.broadcast(ranges), "sentiment")
        .withColumn("_g", guess)
        .withColumn(
            "bin",
            F.when(value < edge(F.col("_g")), F.col("_g") - 1)
            .when((F.col("_g") < bins - 1) & (value >= edge(F.col("_g") + 1)), F.col("_g") + 1)
            .otherwise(F.col("_g")),
        )
        .groupBy("sentiment", "bin")
        .agg(F.sum("n").alias("n"))
    )
    frame = ranges.select(
        "sentiment", "lo", "hi", "step", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return frame.join(placed, ["sentiment", "bin"], "left").select(
        "sentiment",
        "bin",
        edge(F.col("bin")).alias("bin_lo"),
        F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(edge(F.col("bin") + 1)).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 times their distance, and outliers, per key.

    Works on the counts of distinct values in range slices. The quartiles are joined to them by
    slice and key, so that a hot key is met in as many places as it has slices.
    """
    per_value = ranged(value_counts(df, [key], value), [key], [value])
    box = percentiles_of(per_value, [key], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    box = per_value.select(SLICE, key).distinct().join(box, key)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    stats = (
        per_value.join(box, [SLICE, key])
        .groupBy(key)
        .agg(
            F.sum("n").alias("n"),
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.min(F.when(inside, F.col(value))).cast("double").alias("_lo"),
            F.max(F.when(inside, F.col(value))).cast("double").alias("_hi"),
            F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("outliers"),
        )
    )
    # A whisker never ends inside the box.
    return stats.select(
        key,
        "n",
        F.least("_lo", "q1").alias("whisker_lo"),
        "q1",
        "median",
        "q3",
        F.greatest("_hi", "q3").alias("whisker_hi"),
        "outliers",
    )


def mentions(gold: DataFrame) -> DataFrame:
    """Mentions per entity type and name."""
    return named_entities(gold).groupBy("type", "name").agg(F.count("*").alias("n"))


def named_entities(gold: DataFrame) -> DataFrame:
    """A row per mention: entity type and name."""
    kinds = F.explode(
        F.array(
            *[
                F.struct(F.lit(c.removeprefix("entities_")).alias("type"), F.col(c).alias("names"))
                for c in ENTITY_COLUMNS
            ]
        )
    )
    return gold.select(kinds.alias("_k")).select("_k.type", F.explode("_k.names").alias("name"))


def distinct_entities(gold: DataFrame) -> DataFrame:
    """Number of different names per entity type; 0 for a type that never occurs."""
    # Three rows, one per type.
    kinds = gold.sparkSession.createDataFrame(
        [(c.removeprefix("entities_"),) for c in ENTITY_COLUMNS], "type string"
    )
    found = mentions(gold).groupBy("type").agg(F.count("*").alias("n"))
    return kinds.join(found, "type", "left").select("type", F.coalesce("n", F.lit(0)).alias("unique_names"))


def top_entities(gold: DataFrame, k: int = 10) -> DataFrame:
    """The k most mentioned names per type; each task keeps k per type before the shuffle."""
    place = F.row_number().over(Window.partitionBy("type").orderBy(F.desc("n"), "name"))
    return mentions(gold).withColumn("place", place).where(F.col("place") <= k)


def low_confidence(gold: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """Scored records below the threshold."""
    return gold.where(F.col("sentiment_confidence") < threshold)


def worst_confidence(gold: DataFrame, threshold: float = CONFIDENCE_THRESHOLD, k: int = 10) -> DataFrame:
    return (
        low_confidence(gold, threshold)
        .select("review_id", "review_text", "sentiment", "sentiment_confidence")
        .orderBy("sentiment_confidence", "review_id")
        .limit(k)
    )


def low_confidence_share(gold: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    low = F.count_if(F.col("sentiment_confidence") < threshold)
    return gold.agg(low.alias("low"), (low / F.count("*") * 100).alias("low_pct"))


def error_rows(gold: DataFrame) -> DataFrame:
    return gold.where(F.col("enrichment_error")).select("review_id", "review_text")


def error_sample(gold: DataFrame, k: int = 5) -> DataFrame:
    """The first k error rows by id."""
    return error_rows(gold).orderBy("review_id").limit(k)


def head(gold: DataFrame, k: int = 3) -> DataFrame:
    """The first k rows by id."""
    return gold.orderBy("review_id").limit(k)


def mean_confidence(gold: DataFrame) -> DataFrame:
    return gold.agg(F.avg("sentiment_confidence").alias("avg_sentiment_confidence"))


def _as_map(pairs: DataFrame, key: str, value: str) -> Column:
    """A handful of rows (a fixed domain, or a top-k) as one map value."""
    return pairs.select(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))).scalar()


def report(gold: DataFrame, k: int = 5) -> DataFrame:
    """All headline figures in one row."""
    names = mentions(gold).groupBy("type").agg(F.count("*").alias("n"))
    unique = _as_map(names, "type", "n")

    return gold.agg(
        F.count("*").alias("total_records"),
        F.avg(F.col("enrichment_error").cast("int")).alias("enrichment_error_rate"),
        F.avg("sentiment_confidence").alias("avg_sentiment_confidence"),
    ).select(
        "*",
        _as_map(shares(gold, "sentiment"), "sentiment", "share").alias("sentiment_distribution"),
        _as_map(top_categories(gold, k), "category", "n").alias("top_categories"),
        *[
            F.coalesce(F.element_at(unique, kind), F.lit(0)).alias(f"unique_{kind}")
            for kind in ("brands", "locations")
        ],
    )
