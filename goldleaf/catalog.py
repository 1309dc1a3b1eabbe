"""The engine's operators bound to the driver's tables, one query each.

`documents` is the input table (`doc_id` key, `source` as product), `labels` tells which of
its records the output holds already, `events` is a call log. A stand-in for the model
answers by hash of (agent, id, attempt), see `stub.py`.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.functions import cost as fc
from goldleaf.functions.answers import total_entities
from goldleaf.functions.text import json_list
from goldleaf.operators import assemble, costs, keyfilter, sketches, usage
from goldleaf.operators.batches import numbered_batches
from goldleaf.operators.keyfilter import KeyFilter
from goldleaf.operators.pending import count_pending, fetch_pending
from goldleaf.operators.prompts import explode_agents, render
from goldleaf.operators.respond import pandas_responder, respond, spread
from goldleaf.plans import analysis
from goldleaf.plans.agents import EnrichSpec, category_agent, default_agents, enabled, entity_agent, sentiment_agent
from goldleaf.plans.enrich import RunConfig, enrich_frame, run, saved_answers, saved_metrics
from goldleaf.schemas import ENTITY_COLUMNS, PRICES, SILVER
from goldleaf.session import STATE_ON_DISK, scratch, settings, written
from goldleaf.sources.calllog import read_calls
from goldleaf.sources.gold import GoldTable, scratch_gold, with_json_lists
from goldleaf.sources.report import write_report
from goldleaf.sources.rollups import read_sums
from goldleaf.sources.silver import fetch_by_ids, read_json_records
from goldleaf.sources.templates import read_templates
from goldleaf.streaming.budget_stream import crossing_calls, running_cost
from goldleaf.streaming.enrich_stream import enrich_stream, read_files
from goldleaf.streaming.limits_stream import limit_verdicts
from goldleaf.streaming.retry_stream import finish, retry_stream
from goldleaf.streaming.usage_stream import usage_windows, write_usage
from goldleaf.stub import stub_client, stub_responder

SPEC = EnrichSpec("doc_id", "text")
AS_OF = "2024-06-02 06:00:00"
MODELS = {"sentiment": "gpt-4o", "category": "gpt-4o-mini", "entity": "house-model"}
LOG_MODELS = [model for model, *_ in PRICES] + ["house-model"]
BATCH_SIZE = 50
BUDGET_USD = 0.5
WINDOW = 6 * 3600
RPM, TPM = 20, 5_000
BUCKETS = 8
#: The stub answers at once, so its calls need few tasks and no waiting.
CALLS_PER_TASK = 4000
RUN = RunConfig(spec=SPEC, pause=None, calls_per_task=CALLS_PER_TASK)


# Inputs -----------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _as_silver(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id",
        F.col("source").alias("product_id"),
        "text",
        F.date_add(F.lit("2024-06-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("date"),
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_silver(table(spark, sf_dir, "documents"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as a second input table, with a text key."""
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("turn_id"), "role", "text"
    )


def stored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id")


def agents() -> list:
    return [replace(a, config=replace(a.config, model=MODELS[a.name])) for a in default_agents()]


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    tokens = (F.col("event_id") % 500).cast("int")
    return _as_calls(events.withColumn("ts", F.col("ts").cast("timestamp")), tokens)


def _as_calls(events: DataFrame, tokens) -> DataFrame:
    names = F.array(*[F.lit(m) for m in LOG_MODELS])
    return (
        events.withColumn("input_tokens", fc.input_tokens(tokens))
        .withColumn("output_tokens", fc.output_tokens(tokens))
        .withColumn("model", F.element_at(names, (F.col("user_id") % len(LOG_MODELS)).cast("int") + 1))
        .select(
            F.col("ts").alias("timestamp"),
            F.col("event_type").alias("agent"),
            "model",
            F.col("event_id").cast("string").alias("record_id"),
            "input_tokens",
            "output_tokens",
            (F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
            fc.call_cost(F.col("model"), F.col("input_tokens"), F.col("output_tokens")).alias("cost_usd"),
            F.date_format("ts", "yyyy-MM-dd").alias("batch_id"),
        )
    )


_gold_tables: dict[tuple[str, str], GoldTable] = {}
_gold_lock = threading.Lock()


def made_gold(spark: SparkSession, sf_dir: str) -> GoldTable:
    """The output table of a run over all documents; made once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _gold_lock:
        if key not in _gold_tables:
            target = scratch_gold(spark, BUCKETS)
            config = replace(RUN, agents=agents(), as_of=AS_OF, log_path=f"{target.location}-log", sums_path=f"{target.location}-sums")
            run(spark, silver(spark, sf_dir), target, stub_responder(), config, run_id=target.name)
            _gold_tables[key] = target
    return _gold_tables[key]


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made_gold(spark, sf_dir).read()


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The call log that the run behind `gold` wrote."""
    return read_calls(spark, made_gold(spark, sf_dir).location + "-log")


def stub_answers(spark: SparkSession, sf_dir: str, asked: list, attempts: int = 1) -> DataFrame:
    """Parsed answers about all documents."""
    records = silver(spark, sf_dir)
    dealt = spread(records, records.count() * len(asked) * attempts, ["doc_id"], CALLS_PER_TASK)
    pairs = explode_agents(dealt, asked).withColumn("attempt", F.explode(F.sequence(F.lit(1), F.lit(attempts))))
    prompts = render(pairs, asked, read_templates(spark, asked), SPEC)
    return assemble.parse(respond(prompts, stub_responder()), asked)


def _stamp(column: str) -> F.Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# Pending records and prompts --------------------------------------------------


def pending_fetch(spark, sf_dir):
    return fetch_pending(table(spark, sf_dir, "documents"), stored_ids(spark, sf_dir), SPEC)


def pending_without_gold(spark, sf_dir):
    return fetch_pending(table(spark, sf_dir, "documents"), None, SPEC).select("doc_id", "n_chars")


def pending_topk(spark, sf_dir):
    return fetch_pending(table(spark, sf_dir, "documents"), stored_ids(spark, sf_dir), SPEC, limit=25)


def pending_count(spark, sf_dir):
    return count_pending(table(spark, sf_dir, "documents"), stored_ids(spark, sf_dir), SPEC)


def pending_turns(spark, sf_dir):
    """Turns not spoken by the user, as those count as stored."""
    spec = EnrichSpec("turn_id", "text")
    every = turns(spark, sf_dir)
    return fetch_pending(every, every.where(F.col("role") == "user").select("turn_id"), spec)


def _dirty(spark, sf_dir):
    """Documents of which two in five have no text, one only blanks, and one only other white space."""
    docs, n = table(spark, sf_dir, "documents"), F.col("doc_id") % 5
    text = F.when(n == 0, None).when(n == 1, "").when(n == 2, "   ").when(n == 3, " \t\n ").otherwise(F.col("text"))
    return docs.withColumn("text", text)


def pending_dirty(spark, sf_dir):
    return fetch_pending(_dirty(spark, sf_dir), None, SPEC).select("doc_id", "n_chars")


def prompt_dirty(spark, sf_dir):
    """Prompts of all documents, blank ones too: none where there is no text at all."""
    asked = agents()
    prompts = render(explode_agents(_dirty(spark, sf_dir), asked), asked, read_templates(spark, asked), SPEC)
    return prompts.select("record_id", "agent", F.col("prompt").isNull().alias("no_prompt"))


def json_records(spark, sf_dir):
    """Documents written as files of one JSON list each, and read back."""
    path = scratch(spark, "json")
    rows = silver(spark, sf_dir).withColumnsRenamed({"doc_id": "review_id", "text": "review_text"})
    listed = rows.withColumn("batch", F.floor(F.col("review_id") / BATCH_SIZE)).groupBy("batch").agg(
        F.to_json(F.collect_list(F.struct(F.col("review_id").cast("string").alias("review_id"), "product_id", "review_text", "date"))).alias("value")
    )
    listed.write.partitionBy("batch").text(path)
    return read_json_records(spark, path).select(SILVER.names).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def fetch_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").where(F.col("toxic") == 1)
    return fetch_by_ids(table(spark, sf_dir, "documents"), ids, "doc_id")


def prompt_render(spark, sf_dir):
    asked = agents()
    prompts = render(explode_agents(silver(spark, sf_dir), asked), asked, read_templates(spark, asked), SPEC)
    return prompts.select("record_id", "agent", "model", "prompt")


def model_call(spark, sf_dir):
    """Every prompt through the Python stage; the answer tells the length it has seen."""
    asked = agents()
    records = silver(spark, sf_dir)
    pairs = explode_agents(spread(records, records.count() * len(asked), ["doc_id"], CALLS_PER_TASK), asked)
    prompts = render(pairs, asked, read_templates(spark, asked), SPEC)
    return respond(prompts, pandas_responder(stub_client)).select("record_id", "agent", "attempt", "model", "raw", "tokens")


# Parsing ----------------------------------------------------------------------


def sentiment_parse(spark, sf_dir):
    return stub_answers(spark, sf_dir, [sentiment_agent()]).select(
        "record_id", "raw", "ok", "sentiment.sentiment", "sentiment.confidence"
    )


def category_parse(spark, sf_dir):
    return stub_answers(spark, sf_dir, [category_agent()]).select(
        "record_id", "raw", "ok", "category.category", "category.subcategory"
    )


def entity_parse(spark, sf_dir):
    parsed = stub_answers(spark, sf_dir, [entity_agent()])
    lists = [F.col(f"entity.{n}") for n in ("brands", "locations", "persons")]
    return parsed.select(
        "record_id",
        "raw",
        "ok",
        *[F.to_json(c).alias(n) for c, n in zip(lists, ("brands", "locations", "persons"))],
        F.when(F.col("ok"), total_entities(*lists)).alias("total_entities"),
        F.when(F.col("ok"), total_entities(*lists) == 0).alias("is_empty"),
    )


def first_valid_attempt(spark, sf_dir):
    best = assemble.first_valid(stub_answers(spark, sf_dir, agents(), attempts=3))
    return best.select("record_id", "agent", "attempt", "ok", "tokens", "raw")


# The run ----------------------------------------------------------------------


def _flat(rows: DataFrame) -> DataFrame:
    """Types every engine prints alike: lists as JSON text, times as text."""
    return with_json_lists(rows).withColumns(
        {"date": F.date_format("date", "yyyy-MM-dd"), "enriched_at": _stamp("enriched_at")}
    )


def enrich_wide(spark, sf_dir):
    """Pending documents through all agents with retries, before they are stored."""
    config = replace(RUN, agents=agents())
    rows = enrich_frame(
        silver(spark, sf_dir), stored_ids(spark, sf_dir), stub_responder(), config, F.lit(AS_OF).cast("timestamp")
    )
    return _flat(rows).withColumns({"failed_agents": F.to_json("failed_agents"), "doc_id": F.col("doc_id").cast("bigint")})


def gold_table(spark, sf_dir):
    return _flat(gold(spark, sf_dir))


def null_enrichment(spark, sf_dir):
    """Records given up as a whole."""
    return _flat(gold(spark, sf_dir).where(F.col("enrichment_error")))


def run_calls(spark, sf_dir):
    return run_log(spark, sf_dir).select(
        "record_id", "agent", "model", "input_tokens", "output_tokens", "total_tokens",
        F.col("cost_usd").cast("double"), _stamp("timestamp").alias("timestamp"),
    )


def call_metrics(spark, sf_dir):
    """Calls per agent and attempt of the run behind `gold`, failed ones included."""
    answers = saved_answers(spark, made_gold(spark, sf_dir).name, RunConfig(agents=agents()))
    return assemble.metrics(answers).withColumn("avg_latency_ms", F.round("avg_latency_ms", 6))


def call_metrics_observed(spark, sf_dir):
    """`call_metrics` as gathered while the answers were written; they are not read again."""
    noted = saved_metrics(spark, made_gold(spark, sf_dir).name, RunConfig(agents=agents()))
    return noted.withColumn("avg_latency_ms", F.round("avg_latency_ms", 6))


def run_summary(spark, sf_dir):
    """Totals of a run over the pending documents, with a row per agent."""
    source = silver(spark, sf_dir).join(stored_ids(spark, sf_dir), "doc_id", "left_anti")
    config = replace(RUN, agents=agents(), spec=replace(SPEC, unique_ids=True), as_of=AS_OF)
    done = run(spark, source, scratch_gold(spark, BUCKETS), stub_responder(), config, run_id=None)
    return done.select(
        "records_processed", "batches_processed", "total_cost_usd", "total_tokens", F.explode("cost_by_agent")
    ).select(
        "records_processed", "batches_processed", "total_cost_usd", "total_tokens",
        F.col("key").alias("agent"), "value.*",
    )


def gold_upsert(spark, sf_dir):
    """Old rows for all labelled documents; then a batch for all but those of quality 0.

    The batch holds every row twice, and the later one counts.
    """
    docs, labels = silver(spark, sf_dir), table(spark, sf_dir, "labels")
    target = scratch_gold(spark, BUCKETS)

    def rows(df: DataFrame, mark: str, at: str) -> DataFrame:
        return df.select(
            F.col("doc_id").cast("string").alias("review_id"),
            "product_id",
            F.col("text").alias("review_text"),
            "date",
            F.lit(at).cast("timestamp").alias("enriched_at"),
            F.lit(mark).alias("model_used"),
        )

    target.upsert(rows(docs.join(labels, "doc_id", "left_semi"), "old", "2024-06-01"), unique=True)
    fresh = docs.join(labels.where(F.col("quality") == 0), "doc_id", "left_anti")
    target.upsert(rows(fresh, "late", "2024-06-03").unionByName(rows(fresh, "early", "2024-06-02")))
    return _flat(target.read()).select(
        "review_id", "product_id", "review_text", "date", "enriched_at", "model_used", "entities_brands"
    )


def upsert_agent_rows(spark, sf_dir):
    """Records as single agents leave them: tokens and model per agent, some of them missing."""
    n = F.col("doc_id")
    rows = silver(spark, sf_dir).select(
        n.cast("string").alias("review_id"),
        F.when(n % 3 != 0, n % 7).cast("int").alias("sentiment_tokens_used"),
        F.when(n % 4 != 0, n % 5).cast("int").alias("category_tokens_used"),
        F.when(n % 2 == 0, "m-sentiment").when(n % 3 == 0, "").alias("sentiment_model"),
        F.when(n % 5 == 0, "m-category").alias("category_model"),
    )
    target = scratch_gold(spark, BUCKETS)
    target.upsert(rows.where(n % 2 == 0), unique=True)
    odd = rows.where(n % 2 != 0).withColumn("model_used", F.when(F.col("review_id").cast("bigint") % 3 == 1, "given"))
    target.upsert(odd, unique=True)
    return target.read().select("review_id", "tokens_used", "model_used")


def upsert_single(spark, sf_dir):
    """One record of a full table replaced."""
    ids = silver(spark, sf_dir).select(F.col("doc_id").cast("string").alias("review_id"))
    target = scratch_gold(spark, BUCKETS)
    target.upsert(ids.withColumn("sentiment", F.lit("neutral")), unique=True)
    first = ids.agg(F.min("review_id")).first()[0]
    target.upsert_one({"review_id": first, "sentiment": "positive", "sentiment_tokens_used": 7, "entity_model": "m"})
    return target.read().select("review_id", "sentiment", "tokens_used", "model_used")


def gold_count(spark, sf_dir):
    """Keys of the output, beside a count of its current rows."""
    target = made_gold(spark, sf_dir)
    return target.read().agg(F.count("*").alias("n_read"), F.lit(target.count()).cast("bigint").alias("n_listed"))


def batch_assign(spark, sf_dir):
    waiting = fetch_pending(table(spark, sf_dir, "documents"), stored_ids(spark, sf_dir), SPEC)
    return numbered_batches(waiting, "doc_id", BATCH_SIZE)


# Call log ---------------------------------------------------------------------


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def call_log(spark, sf_dir):
    return _money(calls(spark, sf_dir), "cost_usd").withColumn("timestamp", _stamp("timestamp"))


def cost_rollup(spark, sf_dir):
    return _money(costs.rollup(calls(spark, sf_dir)), "cost_usd")


def cost_totals(spark, sf_dir):
    return _money(costs.totals(calls(spark, sf_dir)), "cost_usd")


def cost_by_agent(spark, sf_dir):
    return _money(costs.by(calls(spark, sf_dir), "agent"), "cost_usd")


def cost_by_model(spark, sf_dir):
    return _money(costs.by(calls(spark, sf_dir), "model"), "cost_usd")


def log_missing(spark, sf_dir):
    """Totals of a log that nobody has written yet together with one that is there."""
    none = read_calls(spark, scratch(spark, "no-log"))
    return _money(costs.totals(none.unionByName(calls(spark, sf_dir))), "cost_usd")


def run_cost_summary(spark, sf_dir):
    """The roll-up of the latest run in the log."""
    log = calls(spark, sf_dir)
    last = log.agg(F.max("batch_id").alias("batch_id"))  # one row
    return _money(costs.summary(log.join(F.broadcast(last), "batch_id", "left_semi")), "cost_usd")


def unpriced_models(spark, sf_dir):
    return costs.unpriced(calls(spark, sf_dir))


def agent_breakdown(spark, sf_dir):
    return _money(costs.breakdown(calls(spark, sf_dir)), "total_cost")


def cumulative_cost(spark, sf_dir):
    return _money(
        costs.cumulative(calls(spark, sf_dir).select("timestamp", "record_id", "agent", "cost_usd")),
        "cost_usd", "cumulative_cost",
    ).withColumn("timestamp", _stamp("timestamp"))


def budget_crossing(spark, sf_dir):
    return _money(costs.budget_crossing(calls(spark, sf_dir), BUDGET_USD), "cumulative_cost").withColumn(
        "timestamp", _stamp("timestamp")
    )


def usage_window(spark, sf_dir):
    return usage.sliding(
        calls(spark, sf_dir), "agent", "record_id", rpm=RPM, tpm=TPM, window_seconds=WINDOW
    ).withColumn("timestamp", _stamp("timestamp"))


def current_usage(spark, sf_dir):
    return usage.current(calls(spark, sf_dir), "agent", window_seconds=WINDOW)


def token_boxplot(spark, sf_dir):
    return analysis.box_stats(calls(spark, sf_dir), "agent", "total_tokens")


# Analysis ---------------------------------------------------------------------


def gold_overview(spark, sf_dir):
    return analysis.overview(gold(spark, sf_dir)).withColumns(
        {
            "first_date": F.date_format("first_date", "yyyy-MM-dd"),
            "last_date": F.date_format("last_date", "yyyy-MM-dd"),
            "error_rate": F.round("error_rate", 6),
        }
    )


def null_rates(spark, sf_dir):
    return analysis.null_rates(gold(spark, sf_dir)).withColumn("null_rate", F.round("null_rate", 6))


def sentiment_counts(spark, sf_dir):
    return analysis.counts(gold(spark, sf_dir), "sentiment")


def sentiment_share(spark, sf_dir):
    return analysis.shares(gold(spark, sf_dir), "sentiment")


def top_categories(spark, sf_dir):
    return analysis.top_categories(gold(spark, sf_dir))


def category_sentiment_pct(spark, sf_dir):
    table_ = analysis.category_sentiment(gold(spark, sf_dir))
    return table_.withColumns({c: F.round(c, 6) for c in table_.columns if c.endswith("_pct")})


def top_subcategories(spark, sf_dir):
    return analysis.top_subcategories(gold(spark, sf_dir))


def median_confidence(spark, sf_dir):
    return analysis.median_confidence(gold(spark, sf_dir))


def confidence_histogram(spark, sf_dir):
    return analysis.confidence_histogram(gold(spark, sf_dir)).withColumns(
        {c: F.round(c, 6) for c in ("bin_lo", "bin_hi")}
    )


def mean_confidence(spark, sf_dir):
    return analysis.mean_confidence(gold(spark, sf_dir)).select(
        F.round("avg_sentiment_confidence", 6).alias("avg_sentiment_confidence")
    )


def entity_distinct(spark, sf_dir):
    return analysis.distinct_entities(gold(spark, sf_dir))


def top_entities(spark, sf_dir):
    return analysis.top_entities(gold(spark, sf_dir))


def entity_mentions_json(spark, sf_dir):
    """Brand mentions read back from JSON text, as an exported table holds them."""
    text = with_json_lists(gold(spark, sf_dir).select("review_id", *ENTITY_COLUMNS))
    return text.select("review_id", F.explode(json_list(F.col("entities_brands"))).alias("brand"))


def low_confidence(spark, sf_dir):
    return analysis.low_confidence(gold(spark, sf_dir)).select("review_id", "sentiment", "sentiment_confidence")


def low_confidence_share(spark, sf_dir):
    return analysis.low_confidence_share(gold(spark, sf_dir)).withColumn("low_pct", F.round("low_pct", 6))


def worst_confidence(spark, sf_dir):
    return analysis.worst_confidence(gold(spark, sf_dir))


def error_rows(spark, sf_dir):
    return analysis.error_rows(gold(spark, sf_dir))


def error_sample(spark, sf_dir):
    return analysis.error_sample(gold(spark, sf_dir))


def gold_head(spark, sf_dir):
    return _flat(analysis.head(gold(spark, sf_dir)))


def summary_report(spark, sf_dir):
    return _report(analysis.report(gold(spark, sf_dir)))


def report_sink(spark, sf_dir):
    """The report as its file has it."""
    report, path = analysis.report(gold(spark, sf_dir)), scratch(spark, "report")
    write_report(report, path)
    return _report(spark.read.schema(report.schema).json(path))


def _report(report: DataFrame) -> DataFrame:
    return report.withColumns(
        {
            "enrichment_error_rate": F.round("enrichment_error_rate", 6),
            "avg_sentiment_confidence": F.round("avg_sentiment_confidence", 6),
            "sentiment_distribution": F.to_json("sentiment_distribution"),
            "top_categories": F.to_json("top_categories"),
        }
    )


# Streams ----------------------------------------------------------------------


def stream_enrich(spark, sf_dir):
    """The documents file as a stream, enriched into an output table of its own."""
    schema = table(spark, sf_dir, "documents").schema
    source = _as_silver(read_files(spark, sf_dir, schema, "documents.parquet"))
    target = scratch_gold(spark, BUCKETS)
    place = scratch(spark, "stream")
    config = replace(RUN, agents=agents(), as_of=AS_OF)
    enrich_stream(source, target, stub_responder(), place, config, name=place.rsplit("/", 1)[-1]).awaitTermination()
    return _flat(target.read())


def stream_usage(spark, sf_dir):
    """Closed usage windows of the events file read as a stream."""
    schema = table(spark, sf_dir, "events").schema
    events = read_files(spark, sf_dir, schema, "events.parquet")
    log = _as_calls(events.withColumn("ts", F.col("ts").cast("timestamp")), (F.col("event_id") % 500).cast("int"))
    windows = usage_windows(log, "agent")
    path = scratch(spark, "usage")
    write_usage(windows, path, f"{path}-state").awaitTermination()
    return spark.read.schema(windows.schema).parquet(path).withColumn("window_start", _stamp("window_start"))


def _streamed_calls(spark, sf_dir) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    events = read_files(spark, sf_dir, schema, "events.parquet")
    return _as_calls(events.withColumn("ts", F.col("ts").cast("timestamp")), (F.col("event_id") % 500).cast("int"))


def _drained(frame: DataFrame, name: str) -> DataFrame:
    """What a stream with keyed state gives for the input there is."""
    spark, path = frame.sparkSession, scratch(frame.sparkSession, name)
    with settings(spark, STATE_ON_DISK):
        write_usage(frame, path, f"{path}-state").awaitTermination()
    return spark.read.schema(frame.schema).parquet(path)


def stream_limits(spark, sf_dir):
    """The verdicts of `usage_window` as a stream gives them: of all calls that the watermark has passed."""
    told = limit_verdicts(_streamed_calls(spark, sf_dir), "agent", "record_id", rpm=RPM, tpm=TPM, window_seconds=WINDOW)
    return _drained(told, "limits").withColumn("timestamp", _stamp("timestamp"))


def stream_running_cost(spark, sf_dir):
    """Running cost of every run by closed minutes, with the minute that passes the budget."""
    minutes = _drained(running_cost(_streamed_calls(spark, sf_dir), BUDGET_USD), "minutes")
    return _money(minutes, "spent", "total").withColumn("minute", _stamp("minute"))


def stream_budget(spark, sf_dir):
    """The first call of each run beyond the budget, found by the stream."""
    minutes = _drained(running_cost(_streamed_calls(spark, sf_dir), BUDGET_USD), "minutes")
    found = crossing_calls(minutes, calls(spark, sf_dir), BUDGET_USD)
    return _money(found, "cumulative_cost").withColumn("timestamp", _stamp("timestamp"))


def stream_retry(spark, sf_dir):
    """The documents file as a stream whose failed answers wait in state."""
    schema = table(spark, sf_dir, "documents").schema
    source = _as_silver(read_files(spark, sf_dir, schema, "documents.parquet"))
    target, folder = scratch_gold(spark, BUCKETS), scratch(spark, "retry")
    config = replace(RUN, agents=agents(), as_of=AS_OF)
    query = retry_stream(source, target, stub_responder(), folder, config, name=target.name, processingTime="1 second")
    finish(query, target, folder)
    return _flat(target.read())


def _key_filter(spark, sf_dir) -> tuple[KeyFilter, DataFrame]:
    """A filter of the stored keys, united from two halves."""
    stored = stored_ids(spark, sf_dir)
    keys = KeyFilter(stored.count())
    halves = [keys.build(stored.where(F.col("doc_id") % 2 == half)) for half in (0, 1)]
    return keys, written(keys.united(*halves), "key-filter")


def pending_filtered(spark, sf_dir):
    """`pending_fetch` by way of a Bloom filter."""
    keys, bitmaps = _key_filter(spark, sf_dir)
    return keyfilter.pending_filtered(table(spark, sf_dir, "documents"), stored_ids(spark, sf_dir), keys, bitmaps, SPEC)


def pending_filter_share(spark, sf_dir):
    """How many keys the filter leaves to the join: the stored ones, and of the others a few in a hundred."""
    keys, bitmaps = _key_filter(spark, sf_dir)
    share = keyfilter.joined_share(table(spark, sf_dir, "documents"), keys, bitmaps, SPEC)
    held = stored_ids(spark, sf_dir).distinct().count()
    absent = F.col("keys") - held
    return share.select(
        "keys", (F.col("joined") >= held).alias("none_lost"), (F.col("joined") <= held + 3 * keys.error * absent + 5).alias("few_joined")
    )


def pending_bucketed(spark, sf_dir):
    """`pending_fetch` against an output table in buckets, which the join does not shuffle."""
    target = scratch_gold(spark, BUCKETS)
    target.upsert(stored_ids(spark, sf_dir).select(F.col("doc_id").cast("string").alias("review_id")))
    docs = table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("string"))
    waiting = fetch_pending(docs, target.ids().withColumnRenamed("review_id", "doc_id"), SPEC)
    return waiting.withColumn("doc_id", F.col("doc_id").cast("bigint"))


# Kept up to date, settings -----------------------------------------------------


def cost_rollup_kept(spark, sf_dir):
    """The roll-up of the run's log from the sums saved with it; the log is not read."""
    return _money(costs.rollup_sums(read_sums(spark, made_gold(spark, sf_dir).location + "-sums")), "cost_usd")


def _halves(rows: DataFrame) -> list[DataFrame]:
    return [rows.where(F.pmod(F.xxhash64("review_id"), F.lit(2)) == part) for part in (0, 1)]


def confidence_sketch(spark, sf_dir):
    """Median confidence from merged sketches, checked by the exact rank of what they say."""
    rows = gold(spark, sf_dir).where("sentiment IS NOT NULL AND sentiment_confidence IS NOT NULL")
    parts = [sketches.quantile_sketches(half, ["sentiment"], "sentiment_confidence") for half in _halves(rows)]
    said = written(sketches.quantiles(sketches.merged_quantiles(["sentiment"], *parts), {"median": 0.5}), "medians")
    value, off = F.col("sentiment_confidence"), 2 * sketches.RANK_ERROR
    ranks = rows.join(F.broadcast(said), "sentiment").groupBy("sentiment", "n").agg(  # a row per sentiment
        F.avg((value < F.col("median")).cast("int")).alias("below"), F.avg((value <= F.col("median")).cast("int")).alias("upto")
    )
    return ranks.select("sentiment", "n", ((F.col("below") <= 0.5 + off) & (F.col("upto") >= 0.5 - off)).alias("within"))


def entity_distinct_sketch(spark, sf_dir):
    """Distinct names from merged sketches, one of them merged twice, checked by the exact count."""
    parts = [sketches.distinct_sketches(analysis.named_entities(half), ["type"], "name") for half in _halves(gold(spark, sf_dir))]
    said = sketches.distinct(sketches.merged_distinct(["type"], *parts, parts[0]))
    exact = analysis.distinct_entities(gold(spark, sf_dir))
    off = F.abs(F.col("n") - F.col("unique_names")) <= 4 * sketches.DISTINCT_ERROR * F.col("unique_names") + 1
    return exact.join(said, "type").select("type", "unique_names", off.alias("within"))


def top_entities_sketch(spark, sf_dir):
    """`top_entities` with candidates from merged sketches."""
    parts = [sketches.frequent_sketches(analysis.named_entities(half), ["type"], "name") for half in _halves(gold(spark, sf_dir))]
    merged = written(sketches.merged_frequent(["type"], *parts), "frequent")
    return sketches.top_values(analysis.named_entities(gold(spark, sf_dir)), merged, ["type"], "name", 10).drop("proven")


def agents_switched_off(spark, sf_dir):
    """A run without the category agent: its fields stay null, its calls are not made."""
    target = scratch_gold(spark, BUCKETS)
    config = replace(RUN, agents=enabled(agents(), category=False), as_of=AS_OF)
    run(spark, silver(spark, sf_dir), target, stub_responder(), config, run_id=target.name)
    return with_json_lists(target.read()).select(
        "review_id", "sentiment", "category", "subcategory", "entities_brands", "tokens_used", "model_used"
    )


def agent_settings(spark, sf_dir):
    """What the responder is told about every call: each agent's own model, temperature, limits and further settings."""
    asked = [
        replace(a, config=replace(a.config, temperature=n / 10, max_tokens=100 * (n + 1), timeout_seconds=5 + n, extra={"seed": n}))
        for n, a in enumerate(agents())
    ]
    prompts = render(explode_agents(silver(spark, sf_dir), asked), asked, read_templates(spark, asked), SPEC)
    return prompts.select("record_id", "agent", "model", "temperature", "max_tokens", "timeout_seconds", F.col("extra")["seed"].alias("seed"))


def run_ids(spark, sf_dir):
    """Two runs without an id get one of their own, of eight hexadecimal digits each."""
    config = replace(RUN, agents=[], as_of=AS_OF)
    done = [run(spark, silver(spark, sf_dir), scratch_gold(spark, BUCKETS), stub_responder(), config) for _ in range(2)]
    return done[0].unionByName(done[1]).agg(
        F.count_distinct("run_id").alias("ids"), F.bool_and(F.col("run_id").rlike("^[0-9a-f]{8}$")).alias("well_formed"),
        F.max("records_processed").alias("records"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        pending_fetch, pending_without_gold, pending_topk, pending_count, pending_turns, prompt_render, model_call,
        sentiment_parse, category_parse, entity_parse, first_valid_attempt, enrich_wide, gold_table,
        null_enrichment, run_calls, call_metrics, call_metrics_observed, run_summary, gold_upsert, batch_assign, call_log, cost_rollup, cost_totals,
        cost_by_agent, cost_by_model, run_cost_summary, unpriced_models, agent_breakdown, cumulative_cost,
        budget_crossing, usage_window, current_usage, token_boxplot, gold_overview, null_rates, sentiment_counts,
        sentiment_share, top_categories, category_sentiment_pct, top_subcategories, median_confidence,
        confidence_histogram, mean_confidence, entity_distinct, top_entities, entity_mentions_json,
        low_confidence, low_confidence_share, worst_confidence, error_rows, error_sample, gold_head,
        summary_report, stream_enrich, stream_usage, pending_dirty, prompt_dirty, json_records, upsert_agent_rows,
        upsert_single, gold_count, log_missing, report_sink, stream_limits, stream_running_cost, stream_budget, stream_retry,
        pending_filtered, pending_filter_share, pending_bucketed, cost_rollup_kept, confidence_sketch, entity_distinct_sketch,
        top_entities_sketch, agents_switched_off, agent_settings, run_ids,
    )
}
QUERIES["fetch_by_ids"] = fetch_ids
