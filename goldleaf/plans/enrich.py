"""The enrichment run: pending records to answers to the output table."""

from __future__ import annotations

import time
import uuid
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from decimal import Decimal
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from goldleaf.functions.text import non_blank
from goldleaf.operators import assemble, costs
from goldleaf.operators.batches import wave
from goldleaf.operators.pending import not_in
from goldleaf.operators.prompts import explode_agents, render
from goldleaf.operators.respond import CALLS_PER_TASK, Responder, respond, spread
from goldleaf.operators.unique import one_per
from goldleaf.plans.agents import AgentSpec, EnrichSpec, default_agents
from goldleaf.schemas import RESPONSE
from goldleaf.session import local_rows, scratch, shared_dir, written
from goldleaf.sources.calllog import append_calls
from goldleaf.sources.gold import GoldTable
from goldleaf.sources.rollups import save_sums
from goldleaf.sources.templates import read_templates


@dataclass(frozen=True)
class RunConfig:
    """Settings of a run.

    `waves` splits the records by a hash of their id; the output is written after each wave,
    so a run that dies loses at most one. Calls are dealt to tasks of about `calls_per_task`, in
    every round; a task that fails repeats its calls.
    """

    agents: list[AgentSpec] = field(default_factory=default_agents)
    spec: EnrichSpec = EnrichSpec()
    waves: int = 1
    calls_per_task: int = CALLS_PER_TASK
    log_path: str | None = None
    # Where the log's sums are kept up to date, wave by wave.
    sums_path: str | None = None
    template_dir: str | None = None
    # Compared with what has been spent after every round; a warning, not a stop.
    budget_usd: float | None = None
    as_of: str | None = None
    # Called with the back-off in seconds before each round of retries; None to go on at once.
    pause: Callable[[float], None] | None = time.sleep
    # Where records and answers are saved; by default in the session's shared folder.
    answers_dir: str | None = None


class Saved:
    """Tables under one folder, each written once and marked done, so that a run that died and is
    repeated takes them up."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self.done = self._marks()

    def _marks(self) -> set[int]:
        try:
            marks = self.spark.read.schema("step int").json(f"{self.folder}/done/*")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return set()
        return {row.step for row in marks.collect()}

    def mark(self, step: int) -> None:
        local_rows(self.spark, [{"step": step}], "step:int").write.mode("overwrite").json(f"{self.folder}/done/{step}")
        self.done.add(step)

    def save(self, df: DataFrame, step: int, path: str, by: list[str] = (), note: Callable[[], None] | None = None) -> None:
        df.write.mode("overwrite").partitionBy(*by).parquet(path)
        if note:
            note()
        self.mark(step)


WAVE = "_wave"
#: Calls of one agent in one round, as observed while the answers were written.
NOTED = "agent string, model string, attempt int, calls long, accepted long, errors long, tokens long, latency_ms double"


class Staged(Saved):
    """The pending records of a run, each once, written with the number of their wave.

    Everything later, prompts, retries and the merge, reads this table, so the text that is stored is
    the one that was asked about. The input is read twice at most, however many waves there are:
    once for its keys, once for the rows that are pending.
    """

    def __init__(self, silver: DataFrame, gold_ids: DataFrame | None, config: RunConfig, folder: str) -> None:
        super().__init__(silver.sparkSession, folder)
        spec, path = config.spec, f"{folder}/records"
        # A null key could not be stored, so it ends the run before any call is made.
        key = F.coalesce(F.col(spec.id_col).cast("string"), F.raise_error(F.lit(f"{spec.id_col} is null")))
        kept = silver.where(non_blank(F.col(spec.text_col))).withColumn(spec.id_col, key)
        if 0 not in self.done:
            rows = kept
            if gold_ids is not None:
                # Keys first: only rows that are pending are joined or reduced with their texts, and adaptive
                # execution broadcasts their keys where those are few.
                stored = gold_ids.select(F.col(gold_ids.columns[0]).cast("string").alias(spec.id_col))
                wanted = not_in(kept.select(spec.id_col), stored, spec.id_col)
                rows = kept.join(wanted if spec.unique_ids else wanted.distinct(), spec.id_col, "left_semi")
            if not spec.unique_ids:
                rows = one_per(rows, [spec.id_col])
            self.save(rows.withColumn(WAVE, wave(spec.id_col, config.waves)), 0, path, [WAVE])
        self.schema = kept.withColumn(WAVE, F.lit(0)).schema
        self.rows = self.spark.read.schema(self.schema).parquet(path)
        # One row per wave.
        self.counts = {r[WAVE]: r["count"] for r in self.rows.groupBy(WAVE).count().collect()}

    def wave(self, number: int) -> DataFrame:
        return self.rows.where(F.col(WAVE) == number).drop(WAVE)


class Rounds(Saved):
    """Saved answers of one wave: attempt k asks only what attempt k-1 left open.

    Each table is written before anything else reads it, answers together with their parse.
    """

    STORED = -1

    def __init__(self, spark: SparkSession, folder: str, agents: list[AgentSpec]) -> None:
        super().__init__(spark, folder)
        self.agents = agents
        self.limits = {a.name: a.config.max_retries for a in agents}
        self.parse = assemble.parser(agents)
        self.schema = self.parse(spark.createDataFrame([], RESPONSE)).schema

    def ask(
        self,
        texts: DataFrame,
        count: int,
        config: RunConfig,
        responder: Responder,
        spent: Callable[[DataFrame], None] | None = None,
    ) -> None:
        """Ask about texts (key and text column, a row per record) round by round.

        `spent` is given the settled rows of every round.
        """
        spec = config.spec
        templates = read_templates(self.spark, self.agents, config.template_dir)
        texts = texts.select(spec.id_col, spec.text_col)
        todo, n = texts, count * len(self.agents)
        last = max(self.limits.values(), default=0)
        for attempt in range(1, last + 1):
            path = f"{self.folder}/round-{attempt}"
            if attempt not in self.done:
                # A record is shuffled once, whatever number of calls it takes: its pairs are made in the task that asks.
                dealt = spread(todo, n, [spec.id_col], config.calls_per_task)
                pairs = explode_agents(dealt, self.agents) if attempt == 1 else dealt.select("*", F.inline("_pairs"))
                prompts = render(pairs, self.agents, templates, spec)
                seen = Observation()
                answers = self.parse(respond(prompts, responder)).observe(seen, *assemble.observed(self.agents))
                self.save(answers, attempt, path, note=lambda: self._note(attempt, seen))
            saved = self.spark.read.schema(self.schema).parquet(path)
            if spent:
                spent(assemble.settled(saved, self.limits))
            if attempt < last:
                failed = assemble.failed_pairs(saved, self.limits)
                n = failed.count()
                if n == 0:
                    break
                if config.pause and attempt + 1 not in self.done:
                    config.pause(max(a.config.retry_backoff_base for a in self.agents) ** (attempt - 1))
                # No hint: adaptive execution broadcasts the pairs where they are few.
                open_ = failed.groupBy("record_id").agg(F.collect_list(F.struct("agent", "attempt")).alias("_pairs"))
                same = F.col(spec.id_col).cast("string") == F.col("record_id")
                todo = texts.join(open_, same).select(spec.id_col, spec.text_col, "_pairs")

    def _note(self, attempt: int, seen: Observation) -> None:
        found = [(a, seen.get[a.name].asDict()) for a in self.agents]
        rows = [{"agent": a.name, "model": a.config.model, "attempt": attempt, **said} for a, said in found if said["calls"]]
        noted = local_rows(self.spark, rows, NOTED.replace(" ", ":").replace(",:", ","))
        noted.write.mode("overwrite").json(f"{self.folder}/noted/{attempt}")

    def answers(self) -> DataFrame:
        """All answers, with every attempt."""
        paths = [f"{self.folder}/round-{k}" for k in sorted(self.done) if k > 0]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def settled(self) -> DataFrame:
        """The row that counts for each (record, agent): a filter, as each pair has just one."""
        return assemble.settled(self.answers(), self.limits)


def _root(spark: SparkSession, config: RunConfig) -> str:
    return (config.answers_dir or f"{shared_dir(spark)}/runs").rstrip("/")


def _passes(spark: SparkSession, base: str) -> int:
    """How often a run has been carried through under its id."""
    try:
        return spark.read.schema("pass int").json(f"{base}/complete/*").count()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def saved_answers(spark: SparkSession, run_id: str, config: RunConfig = RunConfig()) -> DataFrame:
    """All answers of a run, with every attempt, as they were saved."""
    schema = assemble.parse(spark.createDataFrame([], RESPONSE), config.agents).schema
    return spark.read.schema(schema).parquet(f"{_root(spark, config)}/{run_id}/pass-*/wave-*/round-*")


def saved_metrics(spark: SparkSession, run_id: str, config: RunConfig = RunConfig()) -> DataFrame:
    """Calls, accepted answers, errors, tokens and latency of a run, as observed; the answers are not read.

    `run_id` may be a pattern, so `name-*` gives the sums of all batches of a stream.
    """
    noted = spark.read.schema(NOTED).json(f"{_root(spark, config)}/{run_id}/pass-*/wave-*/noted/*")
    return assemble.observed_metrics(noted)


def enriched(rows: DataFrame, rounds: Rounds, config: RunConfig, as_of: Column | None = None) -> DataFrame:
    """The asked records with what was answered about them."""
    if not config.agents:
        return rows.withColumn("enriched_at", F.current_timestamp() if as_of is None else as_of)
    answers = assemble.wide(rounds.settled(), config.agents)
    return assemble.merge(rows, answers, config.agents, config.spec, as_of)


def enrich_frame(
    silver: DataFrame, gold_ids: DataFrame | None, responder: Responder, config: RunConfig, as_of: Column | None = None
) -> DataFrame:
    """The pending records with their answers, not stored anywhere but in the scratch folder."""
    folder = scratch(silver.sparkSession, "enriched")
    staged = Staged(silver, gold_ids, replace(config, waves=1), folder)
    rounds = Rounds(staged.spark, f"{folder}/wave-0", config.agents)
    rounds.ask(staged.wave(0), staged.counts.get(0, 0), config, responder)
    return enriched(staged.wave(0), rounds, config, as_of)


def run(
    spark: SparkSession,
    silver: DataFrame,
    gold: GoldTable,
    responder: Responder,
    config: RunConfig = RunConfig(),
    run_id: str | None = None,
) -> DataFrame:
    """Enrich all pending records into the output table; one row of totals.

    A run that died takes up its saved records and answers when it is repeated under its id; one
    that was carried through looks for pending records anew.
    """
    run_id = run_id or uuid.uuid4().hex[:8]
    spec = config.spec
    as_of = F.lit(config.as_of).cast("timestamp") if config.as_of else None
    home = f"{_root(spark, config)}/{run_id}"
    turn = _passes(spark, home)
    base = f"{home}/pass-{turn}"
    staged = Staged(silver, gold.ids() if gold.exists() else None, config, base)
    stored, batches, logs, total = 0, 0, [], Decimal(0)

    def spent(settled: DataFrame) -> None:
        nonlocal total
        total += assemble.call_log(settled, config.agents, run_id).agg(F.sum("cost_usd")).first()[0] or 0
        if total > Decimal(str(config.budget_usd)):
            warnings.warn(f"run {run_id}: cost ${total:.4f} exceeds budget ${config.budget_usd:.4f}")

    for number in range(config.waves):
        n = staged.counts.get(number, 0)
        rounds = Rounds(spark, f"{base}/wave-{number}", config.agents)
        if n:
            rounds.ask(staged.wave(number), n, config, responder, spent if config.budget_usd else None)
        calls = assemble.call_log(rounds.settled(), config.agents, run_id)
        logs.append(calls)
        if not n:
            continue
        batches += 1
        if Rounds.STORED in rounds.done:
            stored += n
            continue
        rows = enriched(staged.wave(number), rounds, config, as_of)
        rows = rows.withColumnsRenamed({spec.id_col: gold.id_col, spec.text_col: "review_text"})
        stored += gold.upsert(rows, unique=True)
        if config.log_path:
            append_calls(calls, config.log_path, run_id, f"{number}-{turn}")
        if config.sums_path:
            save_sums(calls, config.sums_path, run_id, f"{number}-{turn}")
        rounds.mark(Rounds.STORED)
    local_rows(spark, [{"pass": turn}], "pass:int").write.mode("overwrite").json(f"{home}/complete/{turn}")
    return costs.run_summary(reduce(DataFrame.unionByName, logs), run_id, stored, batches)


def enrich_with(
    records: DataFrame,
    agent: AgentSpec,
    responder: Responder,
    spec: EnrichSpec = EnrichSpec(),
    template_dir: str | None = None,
    config: RunConfig = RunConfig(),
) -> DataFrame:
    """Records with one agent's fields, tokens and model; every record and column stays."""
    config = replace(config, agents=[agent], spec=spec, template_dir=template_dir)
    keyed = records.withColumn("_key", F.col(spec.id_col).cast("string"))
    rounds = Rounds(records.sparkSession, scratch(records.sparkSession, f"enrich-{agent.name}"), [agent])
    pairs = written(one_per(keyed.select(spec.id_col, spec.text_col), [spec.id_col]), "asked")
    rounds.ask(pairs, pairs.count(), config, responder)
    answers = rounds.settled().select(
        F.col("record_id").alias("_key"),
        F.col(agent.name).alias("_parsed"),
        F.when(F.col("ok"), F.col("tokens")).otherwise(0).alias(f"{agent.name}_tokens_used"),
        F.col("model").alias(f"{agent.name}_model"),
    )
    joined = keyed.join(answers, "_key", "left")
    return joined.withColumns({n: f(F.col("_parsed")) for n, f in agent.fields.items()}).drop(
        "_key", "_parsed"
    )
