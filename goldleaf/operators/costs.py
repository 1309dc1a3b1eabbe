"""Roll-ups of the call log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.functions.cost import priced
from goldleaf.operators.running import running_totals


def totals(calls: DataFrame) -> DataFrame:
    """Calls, tokens and cost of the whole log."""
    return calls.agg(
        F.count("*").alias("calls"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
        F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.sum("cost_usd"), F.lit(0)).alias("cost_usd"),
    )


def by(calls: DataFrame, key: str) -> DataFrame:
    """Calls, tokens and cost per agent or per model."""
    return calls.groupBy(key).agg(
        F.count("*").alias("calls"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum("cost_usd").alias("cost_usd"),
    )


SUMMED = ["calls", "input_tokens", "output_tokens", "total_tokens", "cost_usd"]


def fine_sums(calls: DataFrame) -> DataFrame:
    """One row per agent and model."""
    return calls.groupBy("agent", "model").agg(F.count("*").alias("calls"), *[F.sum(c).alias(c) for c in SUMMED[1:]])


def rollup(calls: DataFrame) -> DataFrame:
    """Totals, per agent and per model in one scan: rows of (scope, name).

    The log is first reduced to one row per (agent, model), before any shuffle; the grouping
    sets multiply only those few rows.
    """
    return rollup_sums(fine_sums(calls))


def rollup_sums(fine: DataFrame) -> DataFrame:
    """The roll-up of sums per agent and model, of any number of parts of a log."""
    sets = fine.groupingSets(
        [[F.col("agent")], [F.col("model")], []], F.col("agent"), F.col("model")
    ).agg(F.grouping_id().alias("_g"), *[F.sum(c).alias(c) for c in SUMMED])
    scope = F.when(F.col("_g") == 1, "agent").when(F.col("_g") == 2, "model").otherwise("total")
    name = F.when(F.col("_g") == 1, F.col("agent")).when(F.col("_g") == 2, F.col("model"))
    return sets.select(scope.alias("scope"), name.alias("name"), *SUMMED)


def summary(calls: DataFrame, batch_id: str | None = None) -> DataFrame:
    """The roll-up of one run, or of the whole log."""
    return rollup(calls if batch_id is None else calls.where(F.col("batch_id") == batch_id))


def unpriced(calls: DataFrame) -> DataFrame:
    """Calls per model that has no price, and so counts as free."""
    return calls.where(~priced(F.col("model"))).groupBy("model").agg(F.count("*").alias("calls"))


def breakdown(calls: DataFrame) -> DataFrame:
    """Per agent: calls, tokens, cost and mean tokens, to 4 places."""
    return calls.groupBy("agent").agg(
        F.count("cost_usd").alias("calls"),
        F.sum("total_tokens").alias("total_tokens"),
        F.round(F.sum("cost_usd"), 4).alias("total_cost"),
        F.round(F.avg("total_tokens"), 4).alias("avg_tokens"),
    )


CALL_ORDER = ["timestamp", "record_id", "agent"]


def cumulative(calls: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Calls with the cost spent up to each, over the whole log or per key."""
    return running_totals(calls, keys or [], CALL_ORDER, {"cumulative_cost": "cost_usd"})


def budget_crossing(calls: DataFrame, budget_usd: float | None) -> DataFrame:
    """Per run, the first call whose running cost exceeds the budget; none without a budget."""
    spent = cumulative(calls, ["batch_id"]) if budget_usd else calls.limit(0).withColumn(
        "cumulative_cost", F.col("cost_usd")
    )
    over = spent.where(F.col("cumulative_cost") > F.lit(budget_usd or 0).cast("decimal(18,8)"))
    first = F.min(F.struct(*CALL_ORDER, "cumulative_cost")).alias("_first")
    return over.groupBy("batch_id").agg(first, F.count("*").alias("calls_over")).select(
        "batch_id", "_first.*", "calls_over"
    )


def run_summary(calls: DataFrame, run_id: str, records: int, batches: int) -> DataFrame:
    """One row about a run; the map has an entry per agent."""
    per_agent = by(calls, "agent")
    return per_agent.agg(
        F.coalesce(F.sum("cost_usd"), F.lit(0)).cast("double").alias("total_cost_usd"),
        F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("total_tokens"),
        F.map_from_entries(
            F.collect_list(
                F.struct(
                    "agent",
                    F.struct("calls", F.col("total_tokens").alias("tokens"), F.col("cost_usd").cast("double").alias("cost_usd")),
                )
            )
        ).alias("cost_by_agent"),
    ).select(
        F.lit(run_id).alias("run_id"),
        F.lit(records).cast("bigint").alias("records_processed"),
        F.lit(batches).cast("bigint").alias("batches_processed"),
        "*",
    )
