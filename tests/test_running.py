"""Operators over a global order against brute force, with hot keys, ties and nulls."""

from __future__ import annotations

import random
from collections import deque
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldleaf.functions import cost as fc
from goldleaf.operators import costs, usage
from goldleaf.operators.batches import numbered_batches
from goldleaf.operators.percentiles import percentiles, value_counts
from goldleaf.operators.running import row_numbers, running_totals
from goldleaf.schemas import PRICES


def hot_rows(seed: int, n: int = 600):
    """A third of all rows under one key, a third at one instant."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", None, "c"])
        at = 500 if rnd.random() < 0.34 else rnd.randrange(1000)
        out.append((key, at, i, Decimal(rnd.randrange(10**6)) / 10**8, rnd.randrange(300)))
    return out


COLUMNS = "k string, at bigint, id bigint, cost decimal(18,8), tokens int"


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_totals(spark, keys):
    rows = hot_rows(1)
    df = spark.createDataFrame(rows, COLUMNS)
    got = running_totals(df, keys, ["at", "id"], {"spent": "cost", "upto": "tokens"}, slices=7).collect()
    want, sums = {}, {}
    for k, at, i, c, t in sorted(rows, key=lambda r: (r[1], r[2])):
        group = k if keys else 0
        s, n = sums.get(group, (Decimal(0), 0))
        sums[group] = want[i] = (s + c, n + t)
    assert len(got) == len(rows)
    assert {r.id: (r.spent, r.upto) for r in got} == want


def test_no_task_gets_the_whole_order(spark, plan_of):
    df = spark.createDataFrame(hot_rows(2), COLUMNS)
    out = running_totals(df, [], ["at", "id"], {"spent": "cost"})
    physical = plan_of(out).split("== Physical Plan ==")[1]
    # The only single-partition step works on the slice totals, after their aggregate.
    for part in physical.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in part.split("\n")[1]
    assert "BroadcastHashJoin" in physical


def test_row_numbers_and_batches(spark):
    names = [f"r{i:04d}" for i in range(500)]
    random.Random(3).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "id string")
    got = {r.id: r.n for r in row_numbers(df, ["id"], "n", slices=7).collect()}
    assert got == {n: i for i, n in enumerate(sorted(names))}
    batches = numbered_batches(df, "id", 50).groupBy("batch").count().collect()
    assert sorted((r.batch, r["count"]) for r in batches) == [(i, 50) for i in range(10)]


def test_percentiles(spark):
    rows = [(k, t) for k, _, _, _, t in hot_rows(4)] + [("one", 5), ("two", 1), ("two", 4), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v int")
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75, "top": 1.0, "low": 0.0}
    got = percentiles(value_counts(df, ["k"], "v"), ["k"], "v", probs).collect()
    assert len(got) == len({k for k, _ in rows})
    for r in got:
        values = [v for k, v in rows if k == r.k and v is not None]
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(values, p)), (r.k, name)


def limiter(calls, rpm, tpm, window):
    """What a sliding-window counter would say before and at each call."""
    out, seen = {}, {}
    for k, at, i, _, t in sorted(calls, key=lambda r: (r[1], r[2])):
        held = seen.setdefault(k, deque())
        while held and held[0][0] < at - window:
            held.popleft()
        before = sum(x for _, x in held)
        out[i] = (len(held) + 1, before + t, len(held) < rpm, before + t <= tpm)
        held.append((at, t))
    return out


@pytest.mark.parametrize("seed", [5, 6])
def test_sliding_window(spark, seed):
    rows = [r for r in hot_rows(seed) if r[0] is not None]
    calls = spark.createDataFrame(rows, COLUMNS).select(
        "k", F.timestamp_seconds("at").alias("timestamp"), "id", "tokens"
    )
    got = usage.sliding(calls, "k", "id", "tokens", rpm=12, tpm=1500, window_seconds=60).collect()
    have = {r.id: (r.requests_in_window, r.tokens_in_window, r.rpm_ok, r.tpm_ok) for r in got}
    assert have == limiter(rows, 12, 1500, 60)


def test_current_usage(spark):
    rows = [("a", 0, 1, Decimal(0), 5), ("a", 40, 2, Decimal(0), 7), ("b", 39, 3, Decimal(0), 9), ("a", 100, 4, Decimal(0), 1)]
    calls = spark.createDataFrame(rows, COLUMNS).withColumn("timestamp", F.timestamp_seconds("at"))
    got = {r.k: (r.current_rpm, r.current_tpm) for r in usage.current(calls, "k", "tokens").collect()}
    assert got == {"a": (2, 8), "b": (0, 0)}
    then = usage.current(calls, "k", "tokens", as_of="1970-01-01 00:00:45").collect()
    assert {r.k: (r.current_rpm, r.current_tpm) for r in then} == {"a": (2, 12), "b": (1, 9)}


def test_cost_equals_the_float_formula(spark):
    tokens = [0, 1, 7, 85, 142, 399, 123_457]
    models = [p[0] for p in PRICES] + ["other"]
    df = spark.createDataFrame([(m, i, o) for m in models for i in tokens for o in tokens], "m string, i int, o int")
    got = df.select("*", fc.call_cost(F.col("m"), F.col("i"), F.col("o")).alias("c")).collect()
    prices = {p[0]: (float(p[1]), float(p[2])) for p in PRICES}
    for r in got:
        a, b = prices.get(r.m, (0.0, 0.0))
        assert float(r.c) == round(r.i / 1000 * a + r.o / 1000 * b, 8)


def test_token_split(spark):
    got = spark.range(3000).select("id", fc.input_tokens(F.col("id")).alias("i"), fc.output_tokens(F.col("id")).alias("o"))
    for r in got.collect():
        assert (r.i, r.o) == (int(r.id * 0.6), int(r.id * 0.4))


def _calls(spark, rows):
    columns = "timestamp timestamp, agent string, model string, record_id string, input_tokens int, output_tokens int, total_tokens int, cost_usd decimal(18,8), batch_id string"
    return spark.createDataFrame(rows, "s bigint, agent string, model string, cost string, batch_id string").select(
        F.timestamp_seconds("s").alias("timestamp"), "agent", "model", F.concat(F.lit("r"), "s").alias("record_id"),
        F.lit(3).alias("input_tokens"), F.lit(2).alias("output_tokens"), F.lit(5).alias("total_tokens"),
        F.col("cost").cast("decimal(18,8)").alias("cost_usd"), "batch_id",
    ) if rows else spark.createDataFrame([], columns)


def test_budget_is_crossed_only_above_it(spark):
    rows = [(1, "A", "m", "0.4", "x"), (2, "B", "m", "0.1", "x"), (3, "A", "m", "0.00000001", "x"), (4, "A", "m", "1", "x"), (1, "A", "m", "0.5", "y")]
    calls = _calls(spark, rows)
    got = costs.budget_crossing(calls, 0.5).collect()
    assert [(r.batch_id, r.record_id, r.calls_over) for r in got] == [("x", "r3", 2)]
    assert costs.budget_crossing(calls, None).count() == 0 and costs.budget_crossing(calls, 0).count() == 0


def test_rollups(spark):
    calls = _calls(spark, [(1, "A", "gpt-4o", "0.1", "x"), (2, "A", "zz", "0", "x"), (3, "B", "gpt-4o", "0.3", "y")])
    got = {(r.scope, r["name"]): (r.calls, r.total_tokens, float(r.cost_usd)) for r in costs.rollup(calls).collect()}
    assert got == {
        ("total", None): (3, 15, 0.4), ("agent", "A"): (2, 10, 0.1), ("agent", "B"): (1, 5, 0.3),
        ("model", "gpt-4o"): (2, 10, 0.4), ("model", "zz"): (1, 5, 0.0),
    }
    assert {r.scope: r.calls for r in costs.summary(calls, "y").collect()}["total"] == 1
    assert [(r.model, r.calls) for r in costs.unpriced(calls).collect()] == [("zz", 1)]
    empty = costs.totals(_calls(spark, [])).first()
    assert empty.calls == 0 and float(empty.cost_usd) == 0


def test_percentiles_leave_rows_in_their_slices(spark, plan_of):
    """No row of a value is shuffled by its group alone: a hot group stays spread."""
    from goldleaf.operators.percentiles import percentiles_of, value_counts
    from goldleaf.operators.running import ranged
    from goldleaf.plans.analysis import box_stats

    rows = spark.range(2000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("k"), (F.col("id") * 7 % 997).alias("v"))
    saved = ranged(value_counts(rows, ["k"], "v"), ["k"], ["v"])
    found = percentiles_of(saved, ["k"], "v", {"median": 0.5})
    plan = plan_of(found)
    physical = plan[plan.index("== Physical Plan ==") :]
    joins = [line for line in physical.splitlines() if "SortMergeJoin" in line or "ShuffledHashJoin" in line]
    assert not joins, joins
    want = {r.k: r.m for r in rows.groupBy("k").agg(F.percentile("v", 0.5).alias("m")).collect()}
    assert {r.k: r.median for r in found.collect()} == want
    assert {r.k: r.median for r in box_stats(rows, "k", "v").collect()} == want
