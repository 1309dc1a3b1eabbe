"""Sums and sketches that are kept up to date."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldleaf.operators import costs, sketches
from goldleaf.session import scratch
from goldleaf.sources.rollups import read_sums, save_sums


def calls(spark, first, last):
    n = F.col("id")
    return spark.range(first, last).select(
        F.concat(F.lit("a"), n % 3).alias("agent"), F.concat(F.lit("m"), n % 2).alias("model"), (n % 7).cast("int").alias("input_tokens"),
        (n % 5).cast("int").alias("output_tokens"), (n % 7 + n % 5).cast("int").alias("total_tokens"),
        (n * F.lit("0.00000003").cast("decimal(18,8)")).cast("decimal(18,8)").alias("cost_usd"),
    )


def test_sums_follow_the_log(spark):
    path = scratch(spark, "sums")
    assert read_sums(spark, path).count() == 0
    save_sums(calls(spark, 0, 100), path, "run", "0")
    save_sums(calls(spark, 0, 40), path, "run", "1")
    # The second wave again, as after a crash, and another run.
    save_sums(calls(spark, 100, 150), path, "run", "1")
    save_sums(calls(spark, 150, 400), path, "20240602", "0")
    as_rows = lambda df: sorted(map(repr, df.select(*[F.col(c).cast("string") for c in df.columns]).collect()))
    assert as_rows(costs.rollup_sums(read_sums(spark, path))) == as_rows(costs.rollup(calls(spark, 0, 400)))
    assert read_sums(spark, path).select("batch_id").distinct().count() == 2


def test_quantiles_of_merged_sketches(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("k"), (F.pow(F.col("id") % 997, 2)).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(0, None)], "k long, v double"))
    parts = [sketches.quantile_sketches(rows.where(F.col("v") % 4 == i), ["k"], "v") for i in range(4)]
    wanted = {"q1": 0.25, "median": 0.5, "q9": 0.9}
    for r in sketches.quantiles(sketches.merged_quantiles(["k"], *parts), wanted).collect():
        mine = rows.where((F.col("k") == r.k) & F.col("v").isNotNull())
        assert r.n == mine.count()
        for name, q in wanted.items():
            low, high = mine.agg(F.avg((F.col("v") < r[name]).cast("int")), F.avg((F.col("v") <= r[name]).cast("int"))).first()
            assert low - 2 * sketches.RANK_ERROR <= q <= high + 2 * sketches.RANK_ERROR


def test_distinct_counts_of_merged_sketches(spark):
    rows = spark.range(50_000).select((F.col("id") % 2).alias("k"), F.concat(F.lit("n"), F.col("id") % 8000).alias("name"))
    parts = [sketches.distinct_sketches(rows.where(F.col("k") == i), ["k"], "name") for i in (0, 1)]
    once, twice = (sketches.distinct(sketches.merged_distinct(["k"], *parts, *more)).collect() for more in ([], parts))
    assert sorted(once) == sorted(twice)
    assert all(abs(r.n - 4000) <= 4 * sketches.DISTINCT_ERROR * 4000 for r in once)


def test_top_values_by_way_of_sketches(spark):
    """Clear winners are proven by the sketch; ties among many rare values are counted in full."""
    n = F.col("id")
    clear = spark.range(60_000).select(F.lit("clear").alias("k"), F.when(n % 3 > 0, F.concat(F.lit("w"), n % 5)).otherwise(F.concat(F.lit("r"), n)).alias("v"))
    flat = spark.range(20_000).select(F.lit("flat").alias("k"), F.concat(F.lit("f"), n % 9_000).alias("v"))
    rows = clear.union(flat).unionByName(spark.createDataFrame([("clear", None)] * 9 + [("few", "one")], "k string, v string"))
    parts = [sketches.frequent_sketches(rows.where(F.pmod(F.xxhash64("v"), F.lit(3)) == i), ["k"], "v") for i in range(3)]
    path = scratch(spark, "frequent")
    parts[0].write.parquet(path)
    merged = sketches.merged_frequent(["k"], spark.read.parquet(path), *parts[1:])
    got = sorted(map(tuple, sketches.top_values(rows, merged, ["k"], "v", 5).select("k", "v", "n", "place", "proven").collect()))
    wanted = [("clear", f"w{i}", 8_000, i + 1, True) for i in range(5)]
    ties = sorted(f"f{i}" for i in range(2_000))[:5]
    wanted += [("flat", v, 3, i + 1, False) for i, v in enumerate(ties)] + [("few", "one", 1, 1, False)]
    assert got == sorted(wanted)
