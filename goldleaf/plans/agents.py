"""What an agent is: a template, a system message, and Column expressions for its answer."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldleaf.functions import answers
from goldleaf.schemas import CATEGORIES


@dataclass(frozen=True)
class AgentConfig:
    """Settings of one agent; handed to the responder as they are."""

    model: str = "gpt-4o"
    temperature: float = 0.0
    max_tokens: int = 512
    max_retries: int = 3
    retry_backoff_base: float = 2.0
    timeout_seconds: int = 30
    prompt_version: str = "v1"
    extra: dict = field(default_factory=dict)


@dataclass(frozen=True)
class AgentSpec:
    """One agent.

    `parse` turns the answer's VARIANT object into a struct, null for none; `validate` tells
    from the struct whether the answer is accepted. `fields` maps output columns to expressions over that struct
    (null for a record whose attempts all failed). `fills` are further template markers,
    replaced after the text.
    """

    name: str
    log_name: str
    system: str
    parse: Callable[[Column], Column]
    validate: Callable[[Column], Column]
    fields: dict[str, Callable[[Column], Column]]
    fills: tuple[tuple[str, str], ...] = ()
    config: AgentConfig = AgentConfig()


def _member(name: str) -> Callable[[Column], Column]:
    return lambda parsed: parsed[name]


def _list_member(name: str) -> Callable[[Column], Column]:
    return lambda parsed: F.coalesce(parsed[name], F.array().cast("array<string>"))


def sentiment_agent(config: AgentConfig = AgentConfig()) -> AgentSpec:
    return AgentSpec(
        name="sentiment",
        log_name="SentimentAgent",
        system="You judge the sentiment of product reviews. Reply with valid JSON and nothing else.",
        parse=answers.sentiment,
        validate=answers.sentiment_valid,
        fields={"sentiment": _member("sentiment"), "sentiment_confidence": _member("confidence")},
        config=config,
    )


def category_agent(config: AgentConfig = AgentConfig()) -> AgentSpec:
    return AgentSpec(
        name="category",
        log_name="CategoryAgent",
        system="You sort products into a fixed list. Reply with a JSON object holding "
        "'category' and 'subcategory', without comments or markup.",
        parse=answers.category,
        validate=answers.category_valid,
        fields={"category": _member("category"), "subcategory": _member("subcategory")},
        fills=(("{{valid_categories}}", "\n".join(f"- {c}" for c in sorted(CATEGORIES))),),
        config=config,
    )


def entity_agent(config: AgentConfig = AgentConfig()) -> AgentSpec:
    return AgentSpec(
        name="entity",
        log_name="EntityAgent",
        system="You find names in texts. Reply with a JSON object whose keys 'brands', "
        "'locations' and 'persons' each hold a list of strings, empty if there are none.",
        parse=answers.entity,
        validate=answers.entity_valid,
        fields={
            "entities_brands": _list_member("brands"),
            "entities_locations": _list_member("locations"),
            "entities_persons": _list_member("persons"),
        },
        config=config,
    )


def default_agents() -> list[AgentSpec]:
    """The three agents, in the order their results are merged."""
    return [sentiment_agent(), category_agent(), entity_agent()]


def enabled(agents: list[AgentSpec], **flags: bool) -> list[AgentSpec]:
    """Agents left on: `enabled(agents, category=False)`."""
    return [a for a in agents if flags.get(a.name, True)]


@dataclass(frozen=True)
class EnrichSpec:
    """Which columns of the input table hold the key and the text."""

    id_col: str = "review_id"
    text_col: str = "review_text"
    # Set for an input with a declared key: skips the shuffle that keeps one row per id.
    unique_ids: bool = False
