"""Runs from input to output table."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from goldleaf import catalog
from goldleaf.operators import respond
from goldleaf.operators.assemble import choose_model, first_valid, metrics, parse
from goldleaf.operators.batches import wave
from goldleaf.operators.pending import count_pending, fetch_pending
from goldleaf.operators.prompts import explode_agents, render
from goldleaf.operators.respond import RecordError, pandas_responder
from goldleaf.plans import enrich
from goldleaf.plans.agents import (
    AgentConfig, AgentSpec, EnrichSpec, category_agent, default_agents, enabled, entity_agent, sentiment_agent,
)
from goldleaf.plans.enrich import RunConfig, enrich_with, run, saved_answers, saved_metrics
from goldleaf.schemas import GOLD, RESPONSE, SILVER
from goldleaf.session import scratch, shared_dir
from goldleaf.sources.calllog import read_calls
from goldleaf.sources.gold import GoldTable, scratch_gold
from goldleaf.sources.silver import fetch_by_ids, read_json_records, read_or_empty
from goldleaf.sources.templates import read_templates
from goldleaf.stub import stub_responder

DAY = dt.date(2024, 6, 1)
GOOD = {
    "sentiment": '{"sentiment": "positive", "confidence": 0.95}',
    "category": '{"category": "Electronics", "subcategory": "Phones"}',
    "entity": '{"brands": ["Apple"], "locations": [], "persons": []}',
}


@pytest.fixture()
def silver(spark):
    rows = [
        ("r1", "p1", "Great phone", DAY),
        ("r2", "p1", "Bad phone", DAY),
        ("r3", "p2", "A phone", DAY),
        ("r4", "p2", "   ", DAY),
        ("r5", "p2", None, DAY),
        ("r6", "p3", "\t", DAY),
    ]
    return spark.createDataFrame(rows, SILVER)


def gold_table(spark, **kw):
    return scratch_gold(spark, 4, **kw)


def by_id(table):
    return {r.review_id: r for r in table.read().collect()}


def test_pending(spark, silver):
    stored = spark.createDataFrame([("r2",)], "review_id string")
    assert [r.review_id for r in fetch_pending(silver, stored).collect()] == ["r1", "r3", "r6"]
    assert [r.review_id for r in fetch_pending(silver, stored, limit=2).collect()] == ["r1", "r3"]
    assert fetch_pending(silver, stored, limit=0).count() == 3
    assert count_pending(silver, stored).first().n == 5
    assert fetch_pending(silver, None).count() == 4
    assert count_pending(silver, None).first().n == 6
    columns = "review_id string, product_id string, review_text string, date date"
    nulls = silver.unionByName(spark.createDataFrame([(None, "p", "text", DAY)], columns))
    assert fetch_pending(nulls, stored).where("review_id is null").count() == 1


def test_fetch_by_ids(spark, silver):
    assert [r.review_id for r in fetch_by_ids(silver, ["r3", "r1", "zz", "x' OR '1'='1"]).collect()] == ["r1", "r3"]
    assert fetch_by_ids(silver, []).count() == 0
    frame = spark.createDataFrame([("r2",)], "review_id string")
    assert fetch_by_ids(silver, frame).first().review_text == "Bad phone"


def test_missing_table_is_empty(spark):
    assert read_or_empty(spark, "no_such_table", GOLD).count() == 0


def test_json_records(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '[{"review_id": "rev_1", "product_id": "p", "review_text": "ótimo", "date": "2024-06-01"},'
        ' {"review_id": "rev_2", "product_id": "p", "review_text": "ruim", "date": "2024-06-02"}]',
        encoding="utf-8",
    )
    rows = read_json_records(spark, str(tmp_path)).orderBy("review_id").collect()
    assert [(r.review_id, r.review_text, r.date) for r in rows] == [
        ("rev_1", "ótimo", dt.date(2024, 6, 1)), ("rev_2", "ruim", dt.date(2024, 6, 2)),
    ]


def test_templates(spark, tmp_path):
    for name, text in {"sentiment": "S {{review_text}}", "category": "C {{review_text}}\n{{valid_categories}}"}.items():
        (tmp_path / f"{name}.txt").write_text(text, encoding="utf-8")
    agents = default_agents()
    with pytest.raises(FileNotFoundError, match="entity"):
        read_templates(spark, agents, str(tmp_path))
    found = read_templates(spark, agents[:2], str(tmp_path))
    assert found["sentiment"] == "S {{review_text}}"
    with pytest.raises(FileNotFoundError):
        read_templates(spark, [sentiment_agent(AgentConfig(prompt_version="v0"))])
    texts = [("a", r"costs $1 \1 {{valid_categories}}"), ("b", ""), ("c", None)]
    rows = spark.createDataFrame(texts, "review_id string, review_text string")
    got = {
        (r.record_id, r.agent): r.prompt for r in render(explode_agents(rows, agents[:2]), agents[:2], found).collect()
    }
    assert got["a", "sentiment"] == r"S costs $1 \1 {{valid_categories}}"
    listed = got["a", "category"].split("\n")
    assert listed[0].startswith(r"C costs $1 \1 - Automotive") and listed[-1] == "- Toys & Games"
    assert "{{valid_categories}}" not in got["a", "category"]
    assert got["b", "sentiment"] is None and got["c", "category"] is None


def test_one_agent_keeps_the_record(spark, script):
    rows = spark.createDataFrame(
        [("r1", "p1", "text"), ("r2", "p2", None)], "review_id string, product_id string, review_text string"
    )
    out = enrich_with(rows, sentiment_agent(), pandas_responder(script(GOOD, tokens=80)))
    got = {r.review_id: r for r in out.collect()}
    assert got["r1"].product_id == "p1" and got["r1"].sentiment == "positive"
    assert got["r1"].sentiment_tokens_used == 80 and got["r1"].sentiment_model == "gpt-4o"
    assert got["r2"].sentiment is None and got["r2"].sentiment_tokens_used == 0
    lists = enrich_with(rows, entity_agent(), pandas_responder(script(GOOD))).orderBy("review_id").collect()
    assert lists[0].entities_brands == ["Apple"] and lists[1].entities_brands == []


def test_run_and_rerun(spark, silver, script):
    table, log = gold_table(spark), scratch(spark, "log")
    answers = {
        **GOOD,
        ("r2", "sentiment"): ["nonsense", ValueError("timeout"), '{"sentiment": "negative", "confidence": 0.6}'],
        ("r3", "category"): "never JSON",
        ("r6", "entity"): RecordError("boom"),
    }
    config = RunConfig(log_path=log, as_of="2024-06-02 06:00:00")
    done = run(spark, silver, table, pandas_responder(script(answers, 142)), config, "run1").first()
    assert (done.records_processed, done.batches_processed, done.run_id) == (4, 1, "run1")
    got = by_id(table)
    assert sorted(got) == ["r1", "r2", "r3", "r6"]
    one = got["r1"]
    assert (one.sentiment, one.category, one.subcategory) == ("positive", "Electronics", "Phones")
    assert one.entities_brands == ["Apple"] and one.entities_persons == []
    assert one.product_id == "p1" and one.date == DAY and one.model_used == "gpt-4o"
    # 142 tokens are logged as 85 + 56; the record keeps the reported number.
    assert one.tokens_used == 426 and one.enrichment_error is False
    assert one.enrichment_cost_usd == pytest.approx(3 * 0.001265, abs=1e-12)
    assert got["r2"].sentiment == "negative" and got["r2"].tokens_used == 426
    assert got["r3"].category is None and got["r3"].sentiment == "positive" and got["r3"].tokens_used == 284
    assert got["r3"].enrichment_error is False
    lost = got["r6"]
    assert lost.enrichment_error is True and lost.sentiment is None and lost.category is None
    assert lost.entities_brands == [] and lost.tokens_used == 0 and lost.model_used == "unknown"
    calls = read_calls(spark, log)
    assert calls.count() == 11 and {r.batch_id for r in calls.collect()} == {"run1"}
    failed = calls.where("record_id = 'r3' and agent = 'CategoryAgent'").first()
    assert failed.total_tokens == 0 and float(failed.cost_usd) == 0.0
    # Nothing is pending now; another run does nothing.
    again = run(spark, silver, table, pandas_responder(script({})), config, "run2").first()
    assert again.records_processed == 0 and again.cost_by_agent == {}
    # Repeating the first run asks nobody and changes nothing.
    before = {k: r.asDict() for k, r in got.items()}
    run(spark, silver, table, pandas_responder(script({})), config, "run1")
    assert {k: r.asDict() for k, r in by_id(table).items()} == before
    assert read_calls(spark, log).count() == 11 and table.count() == 4


def test_a_run_that_died_is_taken_up(spark, silver, script):
    """Answers paid for before the crash are used, nobody is asked again, then new rows are."""

    class Breaking(GoldTable):
        def upsert(self, *args, **kw):
            raise OSError("disk full")

    log = scratch(spark, "log")
    config = RunConfig(log_path=log)
    table = gold_table(spark)
    with pytest.raises(OSError):
        broken = Breaking(spark, table.name, location=table.location)
        run(spark, silver, broken, pandas_responder(script(GOOD)), config, "died")
    assert table.count() == 0 and read_calls(spark, log).count() == 0
    late = silver.unionByName(spark.createDataFrame([("r9", "p", "new", DAY)], SILVER))
    silent = pandas_responder(script({}))
    assert run(spark, late, table, silent, config, "died").first().records_processed == 4
    assert {r.sentiment for r in table.read().collect()} == {"positive"} and "r9" not in by_id(table)
    # Carried through by now: the same id looks anew.
    assert run(spark, late, table, pandas_responder(script(GOOD)), config, "died").first().records_processed == 1
    assert by_id(table)["r9"].sentiment == "positive" and read_calls(spark, log).count() == 15


def test_back_off_between_rounds(spark, silver, script):
    waits = []
    config = RunConfig(agents=[sentiment_agent()], pause=waits.append)
    run(spark, silver, gold_table(spark), pandas_responder(script({"sentiment": "x"})), config, "waits")
    assert waits == [1.0, 2.0]
    seen = {r.attempt: (r.calls, r.accepted, r.tokens) for r in metrics(saved_answers(spark, "waits", config)).collect()}
    assert seen == {k: (4, 0, 400) for k in (1, 2, 3)}


def test_metrics_are_observed_while_answers_are_written(spark, silver, script):
    """Of a run, of one taken up again, and of all batches of a stream; equal to those of the saved answers."""
    config = RunConfig(waves=2, pause=None)
    answers = script(GOOD | {"sentiment": ["x", GOOD["sentiment"]], "entity": RuntimeError("down")})
    table = gold_table(spark)
    for _ in range(2):
        run(spark, silver, table, pandas_responder(answers), config, "noted-1")
    run(spark, silver, gold_table(spark), pandas_responder(script(GOOD)), config, "noted-2")
    for name in ("noted-1", "noted-2", "noted-*"):
        exact = metrics(saved_answers(spark, name, config)).withColumn("avg_latency_ms", F.round("avg_latency_ms", 6))
        noted = saved_metrics(spark, name, config).withColumn("avg_latency_ms", F.round("avg_latency_ms", 6))
        assert noted.columns == exact.columns
        assert sorted(map(tuple, noted.collect())) == sorted(map(tuple, exact.collect()))
    assert {r.errors for r in saved_metrics(spark, "noted-1", config).where("agent = 'entity'").collect()} == {4}


def test_settings_reach_the_client(spark, silver):
    def client():
        def call(row):
            ok = (row.temperature, row.max_tokens, row.timeout_seconds, row.model) == (0.5, 9, 7, "m")
            return '{"sentiment": "%s", "confidence": 1}' % ("positive" if ok and row.system else "?"), 1

        return call

    agent = sentiment_agent(AgentConfig("m", temperature=0.5, max_tokens=9, timeout_seconds=7))
    out = enrich_with(silver.where("review_id = 'r1'"), agent, pandas_responder(client))
    assert out.first().sentiment == "positive"


def test_retries_stop_at_the_limit(spark, silver, script):
    agent = sentiment_agent(AgentConfig(max_retries=2))
    late = {"sentiment": ["x", "y", GOOD["sentiment"]]}
    table = gold_table(spark)
    run(spark, silver, table, pandas_responder(script(late)), RunConfig(agents=[agent]), "short")
    assert all(r.sentiment is None for r in table.read().collect())
    # The saved answers hold both tries of every record.
    saved = spark.read.parquet(f"{shared_dir(spark)}/runs/short/pass-0/wave-0/round-*")
    assert sorted(r.attempt for r in saved.collect()) == [1] * 4 + [2] * 4


def test_agents_switched_off(spark, silver, script):
    table = gold_table(spark)
    config = RunConfig(agents=enabled(default_agents(), sentiment=False, entity=False))
    run(spark, silver, table, pandas_responder(script(GOOD)), config)
    row = by_id(table)["r1"]
    assert row.sentiment is None and row.category == "Electronics" and row.entities_brands == []
    none = gold_table(spark)
    run(spark, silver, none, pandas_responder(script(GOOD)), RunConfig(agents=[]))
    assert none.count() == 4 and by_id(none)["r2"].review_text == "Bad phone"


def test_rows_left_behind_are_picked_up(spark, silver, script):
    """An output that holds part of the input, as after a crash, leaves the rest pending."""
    table = gold_table(spark)
    run(spark, silver.where("review_id = 'r2'"), table, pandas_responder(script(GOOD)))
    run(spark, silver, table, pandas_responder(script(GOOD)))
    assert sorted(by_id(table)) == ["r1", "r2", "r3", "r6"] and table.ids().count() == 4


def test_waves_cover_all_records_once(spark, silver, script):
    table = gold_table(spark)
    done = run(spark, silver, table, pandas_responder(script(GOOD)), RunConfig(waves=3)).first()
    assert done.records_processed == 4 and table.count() == 4
    assert done.cost_by_agent["SentimentAgent"].calls == 4
    ids = spark.range(1000).withColumn("w", wave("id", 7))
    assert {r.w for r in ids.select("w").distinct().collect()} == set(range(7))


def test_copies_of_an_id(spark, script):
    """A hot id with many texts gives one row."""
    many = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), "id")).alias("review_id"),
        F.lit("p").alias("product_id"),
        F.concat(F.lit("text "), "id").alias("review_text"),
        F.lit(DAY).alias("date"),
    )
    table = gold_table(spark)
    run(spark, many, table, stub_responder(), RunConfig(as_of="2024-06-02 06:00:00", pause=None))
    assert table.count() == 2001


def test_null_id_ends_the_run(spark, script):
    rows = spark.createDataFrame([(None, "text")], "review_id string, review_text string")
    with pytest.raises(Exception, match="review_id is null"):
        run(spark, rows, gold_table(spark), pandas_responder(script(GOOD)))


def test_budget_warning(spark, silver, script):
    with pytest.warns(UserWarning, match="exceeds budget"):
        run(spark, silver, gold_table(spark), pandas_responder(script(GOOD)), RunConfig(budget_usd=0.001))


def test_other_column_names(spark, script):
    rows = spark.createDataFrame([(7, "hello")], "doc bigint, body string")
    table = gold_table(spark)
    config = RunConfig(spec=EnrichSpec("doc", "body", unique_ids=True), calls_per_task=2)
    run(spark, rows, table, pandas_responder(script(GOOD)), config)
    assert by_id(table)["7"].review_text == "hello"


def test_own_agent(spark, silver, script, tmp_path):
    from goldleaf.functions import text as tx

    (tmp_path / "urgency.txt").write_text("How urgent is: {{review_text}}", encoding="utf-8")
    agent = AgentSpec(
        name="urgency",
        log_name="UrgencyAgent",
        system="Reply with JSON.",
        parse=lambda obj: F.when(obj.isNotNull(), F.struct(tx.field_number(obj, "level").alias("level"))),
        validate=lambda parsed: parsed["level"].between(0, 10),
        fields={"urgency": lambda parsed: parsed["level"]},
    )
    client = pandas_responder(script({"urgency": '{"level": 3}', ("r2", "urgency"): '{"level": 30}'}))
    out = enrich_with(silver, agent, client, template_dir=str(tmp_path))
    assert {r.review_id: r.urgency for r in out.collect()}["r1"] == 3.0
    assert out.where("review_id = 'r2'").first().urgency is None


def test_first_valid_attempt(spark):
    bad, good = "no", GOOD["sentiment"]

    def row(record, attempt, raw):
        return (record, "sentiment", attempt, "m", raw, attempt, 0.0, None, False, None)

    rows = [row("a", 1, bad), row("a", 2, good), row("a", 3, good), row("b", 1, bad), row("b", 3, bad), row("b", 2, bad)]
    rows += [row("c", 1, good)] * 3
    best = first_valid(parse(spark.createDataFrame(rows, RESPONSE), [sentiment_agent()])).collect()
    assert {(r.record_id, r.attempt, r.ok) for r in best} == {("a", 2, True), ("b", 3, False), ("c", 1, True)}


def test_model_choice(spark):
    rows = [(None, "", "m3"), ("m1", "m2", None), (None, None, "")]
    got = spark.createDataFrame(rows, "a string, b string, c string").select(
        choose_model(F.col("a"), F.col("b"), F.col("c")).alias("m")
    )
    assert [r.m for r in got.collect()] == ["m3", "m1", "unknown"]


def test_models_per_agent(spark, silver, script):
    agents = [replace(a, config=replace(a.config, model=f"m-{a.name}")) for a in default_agents()]
    table = gold_table(spark)
    run(spark, silver, table, pandas_responder(script(GOOD)), RunConfig(agents=agents))
    row = by_id(table)["r1"]
    assert row.model_used == "m-sentiment" and row.enrichment_cost_usd == 0.0


def test_run_id_default_is_short(spark, silver):
    done = run(spark, silver, gold_table(spark), stub_responder()).first()
    assert len(done.run_id) == 8 and int(done.run_id, 16) >= 0
    assert uuid.UUID(hex=done.run_id * 4)


def test_input_is_read_twice_at_most(spark, silver, script, tmp_path):
    """However many waves and retries there are: once for keys, once for rows."""
    path = str(tmp_path / "silver")
    silver.coalesce(1).write.parquet(path)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watched = spark.read.parquet(path).mapInArrow(counted, silver.schema)
    table = gold_table(spark)
    run(spark, watched.where("review_id = 'r1'"), table, pandas_responder(script(GOOD)), RunConfig(pause=None))
    seen.value = 0
    config = RunConfig(pause=None, waves=4)
    run(spark, watched, table, pandas_responder(script({"sentiment": "x"} | {k: v for k, v in GOOD.items() if k != "sentiment"})), config)
    assert table.count() == 4 and seen.value <= 2 * silver.count()


def test_calls_are_dealt_by_number(spark):
    from pyspark import TaskContext

    def client():
        return lambda row: (str(TaskContext.get().partitionId()), 1)

    many = spark.range(600).select(F.col("id").cast("string").alias("review_id"), F.lit("text").alias("review_text"))
    config = RunConfig(agents=[sentiment_agent(AgentConfig(max_retries=2))], pause=None, calls_per_task=50)
    run(spark, many, gold_table(spark), pandas_responder(client), config, "dealt")
    tasks = saved_answers(spark, "dealt", config).groupBy("attempt").agg(F.countDistinct("raw").alias("n"))
    assert {r.attempt: r.n for r in tasks.collect()} == {1: 12, 2: 12}


def test_a_record_is_dealt_once_for_all_its_calls(spark, silver, script, monkeypatch):
    """Pairs are made after the shuffle, which takes each text once, in every round."""
    dealt = []

    def noted(rows, n, *more):
        dealt.append((rows.count(), n))
        return respond.spread(rows, n, *more)

    monkeypatch.setattr(enrich, "spread", noted)
    bad = {"sentiment": ["no"] * 2 + [GOOD["sentiment"]], "category": ["no", GOOD["category"], ""], "entity": GOOD["entity"]}
    run(spark, silver, gold_table(spark), pandas_responder(script(bad)), RunConfig(pause=None))
    n = dealt[0][0]
    assert dealt == [(n, 3 * n), (n, 2 * n), (n, n)]


def test_attempts_are_made_after_texts_are_dealt(spark, tmp_path, plan_of):
    """Of `first_valid_attempt`, all of whose attempts are asked at once."""
    rows = [(i, f"text {i}", "en", "shop", 6) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    best = catalog.first_valid_attempt(spark, str(tmp_path))
    assert best.count() == 15
    plan = plan_of(best).split("== Physical Plan ==")[1]
    dealing = next(i for i, x in enumerate(plan.splitlines()) if "REPARTITION_BY_NUM" in x)
    assert "Generate" not in "\n".join(plan.splitlines()[dealing:])


@pytest.mark.parametrize("threads", [1, 4])
def test_every_call_has_its_own_time(spark, silver, threads):
    import time

    def client():
        def call(row):
            time.sleep(0.02)
            return GOOD[row.agent], 1

        return call

    config = RunConfig(pause=None)
    name = f"times-{threads}"
    run(spark, silver, gold_table(spark), pandas_responder(client, threads), config, name)
    rows = saved_answers(spark, name, config).collect()
    assert len({r.called_at for r in rows}) == len(rows) == 12 and all(r.latency_ms >= 15 for r in rows)


def test_budget_is_compared_after_every_round(spark, silver, script):
    """One wave of three rounds: the first round's cost warns before the others are asked."""
    late = {"sentiment": GOOD["sentiment"], "category": "x", "entity": "x"}
    asked = []
    config = RunConfig(budget_usd=0.0001, pause=asked.append)
    with pytest.warns(UserWarning, match="exceeds budget") as found:
        run(spark, silver, gold_table(spark), pandas_responder(script(late)), config)
    assert len(asked) == 2 and len([w for w in found if "exceeds budget" in str(w.message)]) == 3


def test_further_settings_reach_the_client(spark, silver):
    def client():
        return lambda row: ('{"sentiment": "%s", "confidence": 1}' % dict(row.extra)["tone"], 1)

    agent = sentiment_agent(AgentConfig(extra={"tone": "negative"}))
    assert enrich_with(silver.where("review_id = 'r1'"), agent, pandas_responder(client)).first().sentiment == "negative"


def test_tokens_and_model_of_single_agents_are_stored(spark, silver, script):
    table = gold_table(spark)
    client = pandas_responder(script(GOOD, 90))
    rows = enrich_with(enrich_with(silver, sentiment_agent(AgentConfig("m1")), client), category_agent(), client)
    table.upsert(rows)
    stored = by_id(table)["r1"]
    assert stored.tokens_used == 180 and stored.model_used == "m1" and stored.sentiment == "positive"
    table.upsert_one({"review_id": "a"})
    table.upsert_one({"review_id": "b", "tokens_used": 3, "model_used": "own", "entity_tokens_used": 9, "entity_model": "x"})
    got = by_id(table)
    assert (got["a"].tokens_used, got["a"].model_used) == (0, "unknown")
    assert (got["b"].tokens_used, got["b"].model_used) == (3, "own")
