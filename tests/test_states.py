"""Streams with keyed state: limits, budgets, retries; and the filter over the output's keys."""

from __future__ import annotations

import datetime as dt
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldleaf.operators import costs, usage
from goldleaf.operators.keyfilter import KeyFilter, joined_share, pending_filtered
from goldleaf.operators.pending import pending
from goldleaf.operators.respond import pandas_responder
from goldleaf.plans.agents import AgentConfig, category_agent, sentiment_agent
from goldleaf.plans.enrich import RunConfig, run
from goldleaf.schemas import CALL_LOG, SILVER
from goldleaf.session import STATE_ON_DISK, scratch, settings
from goldleaf.sources.calllog import read_calls
from goldleaf.sources.gold import scratch_gold
from goldleaf.streaming.budget_stream import crossing_calls, running_cost
from goldleaf.streaming.enrich_stream import read_files
from goldleaf.streaming.limits_stream import limit_verdicts, window_sums
from goldleaf.streaming.retry_stream import finish, retry_stream

START = dt.datetime(2024, 6, 2, 6, tzinfo=dt.timezone.utc)


def calls_at(spark, rows):
    """(second, agent, id, tokens) as calls of a log; the day is the run."""
    listed = [(START + dt.timedelta(seconds=s), a, "m", i, t, 0, t, None, f"run {a}") for s, a, i, t in rows]
    return spark.createDataFrame(listed, CALL_LOG).withColumn("cost_usd", (F.col("total_tokens") * F.lit("0.00000125").cast("decimal(18,8)")).cast("decimal(18,8)"))


class Feed:
    """A folder that calls arrive in, and a query over it that is stopped and started again."""

    def __init__(self, spark, build):
        self.spark, self.build = spark, build
        self.source, self.out = scratch(spark, "calls"), scratch(spark, "told")

    def add(self, rows):
        calls_at(self.spark, rows).coalesce(1).write.mode("append").parquet(self.source)

    def drain(self):
        frame = self.build(read_files(self.spark, self.source, CALL_LOG, per_batch=1))
        with settings(self.spark, STATE_ON_DISK):
            frame.writeStream.format("parquet").option("path", self.out).option("checkpointLocation", f"{self.out}-c").trigger(
                availableNow=True
            ).start().awaitTermination()
        return self.spark.read.schema(frame.schema).parquet(self.out)


def test_window_sums():
    at = np.array([0, 10, 10, 70, 71])
    requests, tokens = window_sums(at, np.array([1, 2, 3, 4, 5]), 60)
    # Both ends of the window count.
    assert requests.tolist() == [1, 2, 3, 3, 2] and tokens.tolist() == [1, 3, 6, 9, 9]


def test_verdicts_of_a_stream_are_those_of_the_log(spark):
    """Late, early and simultaneous calls, a key with most of them, a null key, and a restart."""
    rng = random.Random(1)

    def some(first, last, n, tag):
        return [(rng.randint(first, last) / 2, rng.choice(["hot", "hot", "hot", "b", None]), f"{tag}{i:03d}", rng.randint(0, 90)) for i in range(n)]

    feed = Feed(spark, lambda calls: limit_verdicts(calls, "agent", "record_id", rpm=12, tpm=500, lateness="90 seconds"))
    rows = some(0, 700, 120, "a")
    feed.add(rows)
    first = feed.drain()
    early = first.count()
    assert 0 < early < 120
    # Out of order, but not later than the watermark at 350 - 90 seconds; one call is, and is dropped.
    more = some(530, 1400, 150, "b") + some(540, 690, 20, "c")
    feed.add(more + [(100, "hot", "late", 7)])
    told = feed.drain()
    log = calls_at(spark, rows + more)
    want = usage.sliding(log, "agent", "record_id", rpm=12, tpm=500)
    closed = START + dt.timedelta(seconds=max(r[0] for r in more) - 90)
    want = want.where(F.col("timestamp") < F.lit(closed)).select(told.columns)
    assert sorted(map(repr, told.collect())) == sorted(map(repr, want.collect())) and told.count() > early + 50
    assert {r.rpm_ok for r in told.collect()} == {True, False} == {r.tpm_ok for r in told.collect()}
    # The state of slices that are over is gone.
    with settings(spark, STATE_ON_DISK):
        held = spark.read.format("statestore").option("stateVarName", "calls").load(f"{feed.out}-c")
        assert 0 < held.count() < 200


def test_running_cost_and_the_first_crossing(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 3000) / 2, rng.choice(["hot", "hot", "b"]), f"r{i:04d}", rng.randint(1, 400)) for i in range(300)]
    feed = Feed(spark, lambda calls: running_cost(calls, 0.02))
    cut = sorted(rows)
    feed.add(cut[:140])
    feed.drain()
    # A third run moves the watermark on; its own last minutes stay open.
    feed.add(cut[140:] + [(4000 + i, "last", f"z{i}", 1) for i in range(3)])
    minutes = feed.drain()
    log = calls_at(spark, rows)
    want = {
        (r.batch_id, r.timestamp, r.record_id, r.cumulative_cost) for r in costs.budget_crossing(log, 0.02).collect()
    }
    got = crossing_calls(minutes, calls_at(spark, rows + [(4000 + i, "last", f"z{i}", 1) for i in range(3)]), 0.02)
    assert {(r.batch_id, r.timestamp, r.record_id, r.cumulative_cost) for r in got.collect()} == want and len(want) == 2
    by_run = log.groupBy("batch_id").agg(F.sum("cost_usd").alias("c"))
    assert {(r.batch_id, r.c) for r in by_run.collect()} == {
        (r.batch_id, r.c) for r in minutes.where("batch_id <> 'run last'").groupBy("batch_id").agg(F.max("total").alias("c")).collect()
    }
    assert minutes.where("crossed").count() == 2


def test_no_budget_marks_nothing(spark):
    feed = Feed(spark, lambda calls: running_cost(calls))
    feed.add([(s, "a", f"r{s}", 100) for s in range(0, 900, 30)])
    minutes = feed.drain()
    assert minutes.count() > 5 and minutes.where("crossed").count() == 0


OK = '{"sentiment": "positive", "confidence": 0.9}'
KIND = '{"category": "Books & Media", "subcategory": "x"}'


def quick(agent):
    return agent(AgentConfig(retry_backoff_base=1.0))


def test_failed_answers_wait_in_state(spark, script, monkeypatch):
    """The same output as a run over all records, without a sleep on the driver, over a restart in the middle."""
    monkeypatch.setattr(time, "sleep", lambda s: pytest.fail("the driver sleeps"))
    answers = {
        "sentiment": OK, "category": KIND, ("b", "sentiment"): ["x", OK], ("c", "sentiment"): ["x", "y", OK],
        ("d", "category"): ["x", "y", "z"], ("e", "sentiment"): [ValueError("no"), OK], ("f", "category"): ["x", KIND],
    }
    agents = [quick(sentiment_agent), quick(category_agent)]
    source, folder, log = (scratch(spark, n) for n in ("in", "retry", "log"))
    table, plain = scratch_gold(spark, 2), scratch_gold(spark, 2)
    config = RunConfig(agents=agents, as_of="2024-06-02 06:00:00", log_path=log, pause=None)

    def add(ids):
        rows = [(i, "p", f"text {i}", dt.date(2024, 6, 1)) for i in ids] + [("blank", "p", "  ", None)]
        spark.createDataFrame(rows, SILVER).coalesce(1).write.mode("append").parquet(source)

    def start():
        stream = read_files(spark, source, SILVER, per_batch=1)
        return retry_stream(stream, table, pandas_responder(script(answers)), folder, config, name="t", processingTime="1 second")

    table.upsert(spark.createDataFrame([("g", "kept")], "review_id string, sentiment string"))
    add(["a", "b", "c", "g"])
    query = start()
    while table.count() < 2 and not query.awaitTermination(1):
        pass
    query.stop()
    add(["d", "e", "f", "a"])
    finish(start(), table, folder)
    rows = {r.review_id: r for r in table.read().collect()}
    assert rows.pop("g").sentiment == "kept" and sorted(rows) == ["a", "b", "c", "d", "e", "f"]
    run(spark, spark.read.schema(SILVER).parquet(source), plain, pandas_responder(script(answers)), config, "plain")
    want = {r.review_id: r for r in plain.read().where("review_id <> 'g'").collect()}
    assert rows == want and rows["d"].category is None and rows["c"].sentiment == "positive"
    tries = spark.read.parquet(*[f"{folder}/answers/*"]).groupBy("record_id", "agent").agg(F.max("attempt").alias("n"), F.count("*").alias("m"))
    asked = {(r.record_id, r.agent): (r.n, r.m) for r in tries.collect()}
    assert asked["c", "sentiment"] == (3, 3) and asked["d", "category"] == (3, 3) and asked["a", "sentiment"] == (1, 1)
    assert not any(i == "g" for i, _ in asked)
    stream_log = read_calls(spark, log).where("batch_id = 't'")
    assert stream_log.count() == 12 == read_calls(spark, log).where("batch_id = 'plain' and record_id <> 'g'").count()


def test_filter_of_keys(spark):
    stored = spark.range(0, 30_000, 3).select(F.concat(F.lit("k"), "id").alias("review_id"))
    silver = spark.range(20_000).select(
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("k"), "id")).alias("review_id"),
        F.when(F.col("id") % 7 != 0, "text").alias("review_text"),
    )
    for error in (0.1, 0.01, 0.0001):
        keys = KeyFilter(10_000, error)
        filled = keys.build(stored)
        got = pending_filtered(silver, stored, keys, filled)
        want = pending(silver, stored)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        share = joined_share(silver, keys, filled).first()
        held = silver.where("review_text is not null").join(stored, "review_id", "left_semi").count()
        absent = share.keys - held
        assert held <= share.joined <= held + 2 * error * absent + 5
    assert KeyFilter(10_000, 0.1).blocks < KeyFilter(10_000, 0.0001).blocks


def test_filters_are_united(spark):
    keys = KeyFilter(5_000)
    ids = spark.range(5_000).select(F.col("id").cast("string").alias("review_id"))
    parts = [keys.build(ids.where(F.col("review_id").cast("long") % 3 == i)) for i in range(3)]
    whole = keys.build(ids)
    as_rows = lambda f: sorted((r.block, bytes(r.bitmap)) for r in f.collect())
    assert as_rows(keys.united(*parts)) == as_rows(whole) == as_rows(keys.united(whole, parts[0], whole))
    # Twice as many keys as it was made for: still right.
    more = spark.range(5_000, 15_000).select(F.col("id").cast("string").alias("review_id"))
    grown = keys.united(whole, keys.build(more))
    assert keys.marked(more, grown, "review_id").where("NOT maybe").count() == 0
    assert keys.marked(more.limit(0), grown, "review_id").count() == 0 == keys.build(ids.limit(0)).count()
