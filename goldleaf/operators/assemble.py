"""From responses back to records."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.functions import cost as fc
from goldleaf.functions.text import json_object, let
from goldleaf.operators.respond import NO_TEXT
from goldleaf.plans.agents import AgentSpec, EnrichSpec
from goldleaf.schemas import CALL_LOG, UNKNOWN_MODEL


def parser(agents: list[AgentSpec]) -> Callable[[DataFrame], DataFrame]:
    """Function that adds a struct column per agent (null on other rows and for answers that
    are not accepted) and `ok`. The expressions are made once, for use on every round.
    """

    def accepted(agent: AgentSpec) -> Column:
        def checked(parsed: Column) -> Column:
            return F.when(agent.validate(parsed), parsed)

        answer = json_object(F.col("raw"), lambda obj: let(agent.parse(obj), checked))
        return F.when(F.col("agent") == agent.name, answer)

    # Answers are read alike in every session: of a repeated key the last one counts.
    SparkSession.active().conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    structs = {a.name: accepted(a) for a in agents}
    good = reduce(or_, [F.col(a.name).isNotNull() for a in agents], F.lit(False))
    return lambda responses: responses.withColumns(structs).withColumn("ok", good)


def parse(responses: DataFrame, agents: list[AgentSpec]) -> DataFrame:
    return parser(agents)(responses)


def again(max_retries: dict[str, int]) -> Column:
    """Whether a row is due for another attempt.

    A record without a text, or given up as a whole, is not asked about again.
    """
    limit = F.element_at(F.create_map(*[F.lit(x) for kv in max_retries.items() for x in kv]), F.col("agent"))
    final = F.col("fatal") | F.coalesce(F.col("error") == NO_TEXT, F.lit(False))
    return ~F.col("ok") & ~final & (F.col("attempt") < limit)


def failed_pairs(parsed: DataFrame, max_retries: dict[str, int]) -> DataFrame:
    """(record, agent) pairs due for another attempt, with its number."""
    return parsed.where(again(max_retries)).select(
        "record_id", "agent", (F.col("attempt") + 1).alias("attempt")
    )


def settled(parsed: DataFrame, max_retries: dict[str, int]) -> DataFrame:
    """Of answers asked round by round, the one row per (record, agent) that counts."""
    return parsed.where(~again(max_retries))


def metrics(parsed: DataFrame) -> DataFrame:
    """Calls, accepted answers, errors, tokens and latency per agent, model and attempt."""
    return parsed.groupBy("agent", "model", "attempt").agg(
        F.count("*").alias("calls"),
        F.count_if("ok").alias("accepted"),
        F.count("error").alias("errors"),
        F.sum("tokens").alias("tokens"),
        F.avg("latency_ms").alias("avg_latency_ms"),
    )


def observed(agents: list[AgentSpec]) -> list[Column]:
    """The same as aggregates over all rows, one struct per agent, to be gathered while answers are written."""
    of = lambda a, value: F.when(F.col("agent") == a.name, value)
    return [
        F.struct(
            F.count(of(a, F.lit(1))).alias("calls"),
            F.count(of(a, F.when(F.col("ok"), 1))).alias("accepted"),
            F.count(of(a, F.col("error"))).alias("errors"),
            F.coalesce(F.sum(of(a, F.col("tokens"))), F.lit(0)).cast("long").alias("tokens"),
            F.coalesce(F.sum(of(a, F.col("latency_ms"))), F.lit(0.0)).alias("latency_ms"),
        ).alias(a.name)
        for a in agents
    ]


def observed_metrics(noted: DataFrame) -> DataFrame:
    """`metrics` from what was noted round by round."""
    return noted.groupBy("agent", "model", "attempt").agg(
        *[F.sum(c).alias(c) for c in ("calls", "accepted", "errors", "tokens")],
        (F.sum("latency_ms") / F.sum("calls")).alias("avg_latency_ms"),
    )


def first_valid(parsed: DataFrame) -> DataFrame:
    """One row per (record, agent): the earliest good attempt, else the last bad one.

    For tables of unknown origin. Copies and attempts are reduced before the shuffle.
    """
    order = F.struct(
        (~F.col("ok")).alias("bad"),
        F.when(F.col("ok"), F.col("attempt")).otherwise(-F.col("attempt")).alias("rank"),
        F.xxhash64("raw", "tokens", "model").alias("tie"),
    )
    row = F.struct(*parsed.columns)
    return parsed.groupBy("record_id", "agent").agg(F.min_by(row, order).alias("_row")).select("_row.*")


def call_log(settled: DataFrame, agents: list[AgentSpec], batch_id: str) -> DataFrame:
    """One cost row per (record, agent) that ran; an agent that failed reports 0 tokens."""
    log_name = F.create_map(*[F.lit(x) for a in agents for x in (a.name, a.log_name)])
    tokens = F.when(F.col("ok"), F.col("tokens")).otherwise(0)
    return (
        settled.where(~F.col("fatal"))
        .withColumn("input_tokens", fc.input_tokens(tokens))
        .withColumn("output_tokens", fc.output_tokens(tokens))
        .select(
            F.col("called_at").alias("timestamp"),
            F.element_at(log_name, F.col("agent")).alias("agent"),
            F.coalesce("model", F.lit(UNKNOWN_MODEL)).alias("model"),
            "record_id",
            "input_tokens",
            "output_tokens",
            (F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
            fc.call_cost(F.col("model"), F.col("input_tokens"), F.col("output_tokens")).alias("cost_usd"),
            F.lit(batch_id).alias("batch_id"),
        )
        .select(CALL_LOG.names)
    )


def wide(settled: DataFrame, agents: list[AgentSpec]) -> DataFrame:
    """One row per record from one row per (record, agent): a single aggregate on the key.

    Per agent the parsed struct, its tokens and its model; over all agents the cost, the
    names of failed agents, and whether the record was given up.
    """
    tokens = F.when(F.col("ok"), F.col("tokens")).otherwise(0)
    spent = F.when(
        ~F.col("fatal"), fc.call_cost(F.col("model"), fc.input_tokens(tokens), fc.output_tokens(tokens))
    )
    columns: list[Column] = []
    for a in agents:
        mine = F.col("agent") == a.name
        columns += [
            F.max(F.when(mine, F.col(a.name))).alias(a.name),
            F.max(F.when(mine, tokens)).alias(f"{a.name}_tokens_used"),
            F.max(F.when(mine, F.col("model"))).alias(f"{a.name}_model"),
        ]
    return settled.groupBy("record_id").agg(
        *columns,
        F.coalesce(F.sum(spent), F.lit(0)).cast(fc.MONEY).alias("cost_usd"),
        F.array_sort(F.collect_set(F.when(~F.col("ok"), F.col("agent")))).alias("failed_agents"),
        F.bool_or("fatal").alias("given_up"),
    )


def choose_model(*models: Column) -> Column:
    """The first non-empty model name."""
    return F.coalesce(*[F.nullif(m, F.lit("")) for m in models], F.lit(UNKNOWN_MODEL))


def merge(
    records: DataFrame,
    answers: DataFrame,
    agents: list[AgentSpec],
    spec: EnrichSpec = EnrichSpec(),
    as_of: Column | None = None,
) -> DataFrame:
    """Records with the answers' fields; a record given up gets null fields and the error flag.

    Every record stays, answered or not. `failed_agents` names agents that used up their
    attempts; the error flag does not cover those.
    """
    lost = F.coalesce(F.col("given_up"), F.lit(False))
    keys = answers.withColumnRenamed("record_id", "_record_id")
    joined = records.join(keys, F.col(spec.id_col).cast("string") == F.col("_record_id"), "left")
    fields = {}
    for a in agents:
        for name, expr in a.fields.items():
            fields[name] = expr(F.when(~lost, F.col(a.name)))
    tokens = sum((F.coalesce(F.col(f"{a.name}_tokens_used"), F.lit(0)) for a in agents), F.lit(0))
    model = choose_model(*[F.col(f"{a.name}_model") for a in agents])
    return joined.withColumns(
        {
            **fields,
            "enriched_at": as_of if as_of is not None else F.current_timestamp(),
            "model_used": F.when(lost, F.lit(UNKNOWN_MODEL)).otherwise(model),
            "tokens_used": F.when(lost, F.lit(0)).otherwise(tokens).cast("int"),
            "enrichment_cost_usd": F.coalesce(F.col("cost_usd"), F.lit(0)).cast("double"),
            "enrichment_error": lost,
        }
    ).select(
        *[c for c in records.columns],
        *fields,
        "enriched_at",
        "model_used",
        "tokens_used",
        "enrichment_cost_usd",
        "enrichment_error",
        F.when(F.size("failed_agents") > 0, F.col("failed_agents")).alias("failed_agents"),
    )
