"""Streams over folders of files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from goldleaf.operators.respond import pandas_responder
from goldleaf.plans.agents import enabled, default_agents
from goldleaf.plans.enrich import RunConfig
from goldleaf.schemas import SILVER
from goldleaf.session import scratch
from goldleaf.sources.calllog import read_calls
from goldleaf.sources.gold import GoldTable, scratch_gold
from goldleaf.streaming.enrich_stream import enrich_stream, read_files
from goldleaf.streaming.usage_stream import usage_windows, write_usage

ANSWER = '{"sentiment": "positive", "confidence": 0.9}'


def test_enrich_stream(spark, script):
    source, state, log = (scratch(spark, n) for n in ("in", "state", "log"))
    table = scratch_gold(spark, 2)
    config = RunConfig(agents=enabled(default_agents(), category=False, entity=False), log_path=log)

    def add(ids):
        rows = [(i, "p", f"text {i}", dt.date(2024, 6, 1)) for i in ids]
        spark.createDataFrame(rows, SILVER).coalesce(1).write.mode("append").parquet(source)

    def drain(client):
        stream = read_files(spark, source, SILVER, per_batch=1)
        enrich_stream(stream, table, pandas_responder(client), state, config, name="t").awaitTermination()

    add(["a", "b"])
    add(["c"])
    drain(script({"sentiment": ANSWER}))
    assert sorted(r.review_id for r in table.ids().collect()) == ["a", "b", "c"]
    assert read_calls(spark, log).count() == 3
    # Restarted: only the new file is read, and ids that are stored are not asked about again.
    add(["d", "a"])
    drain(script({("d", "sentiment"): ANSWER}))
    got = {r.review_id: r.sentiment for r in table.read().collect()}
    assert got == dict.fromkeys("abcd", "positive") and read_calls(spark, log).count() == 4


def test_usage_stream(spark):
    source, out = scratch(spark, "calls"), scratch(spark, "windows")
    at = [5, 15, 15, 70, 400]
    spark.createDataFrame([(s, "A", 10) for s in at], "s bigint, agent string, total_tokens int").select(
        F.timestamp_seconds("s").alias("timestamp"), "agent", "total_tokens"
    ).coalesce(1).write.parquet(source)
    calls = read_files(spark, source, spark.read.parquet(source).schema)
    write_usage(usage_windows(calls, "agent"), out, f"{out}-state").awaitTermination()
    got = {int(r.window_start.timestamp()): (r.requests, r.tokens) for r in spark.read.parquet(out).collect()}
    want = {}
    for start in range(-60, 400, 10):
        held = [s for s in at if start <= s < start + 60]
        if held and start + 60 <= 400 - 120:
            want[start] = (len(held), 10 * len(held))
    assert got == want
