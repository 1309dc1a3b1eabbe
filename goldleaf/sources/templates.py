"""Versioned prompt templates: one text file per agent."""

from __future__ import annotations

from importlib import resources

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from goldleaf.plans.agents import AgentSpec


def read_templates(
    spark: SparkSession, agents: list[AgentSpec], folder: str | None = None
) -> dict[str, str]:
    """Template text per agent name; raises when an agent has no file.

    Without a folder the package's own files of each agent's `prompt_version` are read.
    With one, `<folder>/<agent>.txt` is read through Spark, so it may be any file system.
    The result holds one text per agent.
    """
    if folder is None:
        found = {}
        for agent in agents:
            file = resources.files("goldleaf") / "templates" / agent.config.prompt_version / f"{agent.name}.txt"
            if file.is_file():
                found[agent.name] = file.read_text(encoding="utf-8")
    else:
        names = [a.name for a in agents]
        rows = (
            spark.read.option("pathGlobFilter", "*.txt")
            .text(folder, wholetext=True)
            .select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.txt$", 1).alias("agent"), "value")
            .where(F.col("agent").isin(names))
            .collect()
        )
        found = {row.agent: row.value for row in rows}
    missing = [a.name for a in agents if a.name not in found]
    if missing:
        raise FileNotFoundError(f"no prompt template for: {', '.join(missing)}")
    return found
