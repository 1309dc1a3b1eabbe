"""Prompts: every record with the template of every enabled agent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.plans.agents import AgentSpec, EnrichSpec
from goldleaf.schemas import PROMPT

TEXT_MARKER = "{{review_text}}"


def fill(agent: AgentSpec, template: str, text: Column) -> Column:
    """Text first, then the agent's own markers, so a marker inside the text is filled too."""
    filled = F.replace(F.lit(template), F.lit(TEXT_MARKER), text)
    for marker, value in agent.fills:
        filled = F.replace(filled, F.lit(marker), F.lit(value))
    return filled


def _settings(extra: dict) -> Column:
    """Further settings as texts."""
    pairs = [F.lit(str(x)) for pair in extra.items() for x in pair]
    return (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>")


def explode_agents(records: DataFrame, agents: list[AgentSpec], attempt: int = 1) -> DataFrame:
    """One row per record and agent: a generator over constants, so nothing is joined."""
    return records.withColumn("agent", F.explode(F.array(*[F.lit(a.name) for a in agents]))).withColumn(
        "attempt", F.lit(attempt)
    )


def render(
    pairs: DataFrame, agents: list[AgentSpec], templates: dict[str, str], spec: EnrichSpec = EnrichSpec()
) -> DataFrame:
    """Prompt rows for (record, agent, attempt) rows.

    A null or empty text gives a null prompt; such a row fails without a model call.
    """

    def by_agent(value) -> Column:
        chain = F
        for a in agents:
            chain = chain.when(F.col("agent") == a.name, value(a))
        return chain

    text = F.col(spec.text_col)
    prompt = by_agent(lambda a: fill(a, templates[a.name], text))
    return pairs.select(
        F.col(spec.id_col).cast("string").alias("record_id"),
        "agent",
        "attempt",
        by_agent(lambda a: F.lit(a.config.model)).alias("model"),
        by_agent(lambda a: F.lit(a.config.temperature)).alias("temperature"),
        by_agent(lambda a: F.lit(a.config.max_tokens)).alias("max_tokens"),
        by_agent(lambda a: F.lit(a.config.timeout_seconds)).alias("timeout_seconds"),
        by_agent(lambda a: _settings(a.config.extra)).alias("extra"),
        by_agent(lambda a: F.lit(a.system)).alias("system"),
        F.when(text != "", prompt).alias("prompt"),
    ).select(PROMPT.names)
