"""Analysis figures against numpy, and the plans behind them."""

from __future__ import annotations

import datetime as dt
import json
import random

import numpy as np
import pytest

from goldleaf.plans import analysis
from goldleaf.schemas import GOLD
from goldleaf.session import written
from goldleaf.sources.report import write_report


def gold_rows(n=400, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        label = rnd.choice(["positive"] * 4 + ["negative", None])
        score = None if label is None else rnd.randrange(101) / 100
        topic = rnd.choice(["Electronics"] * 5 + ["Other", "Automotive", "E-commerce", None])
        sub = None if topic is None else rnd.choice(["x", "y", "z"])
        brands = ["hot"] * rnd.randrange(3) + [f"b{rnd.randrange(30)}"]
        out.append(
            (f"r{i:04d}", "p", f"text {i}", dt.date(2024, 6, 1 + i % 20), label, score, topic, sub, brands, [], ["P"],
             dt.datetime(2024, 6, 2), "m", 5, 0.1, i % 50 == 0)
        )
    return out


@pytest.fixture(scope="module")
def gold(spark):
    return written(spark.createDataFrame(gold_rows(), GOLD), "analysis")


def test_overview_and_nulls(gold):
    rows = gold_rows()
    got = analysis.overview(gold).first()
    assert (got.records, got.errors, got.error_rate) == (400, 8, 0.02)
    assert (got.first_date, got.last_date) == (dt.date(2024, 6, 1), dt.date(2024, 6, 20))
    rates = {r.column_name: r.null_rate for r in analysis.null_rates(gold).collect()}
    assert rates["sentiment"] == sum(r[4] is None for r in rows) / 400 and rates["entities_brands"] == 0.0


def test_histogram_matches_numpy(gold):
    rows = gold_rows()
    got = analysis.confidence_histogram(gold).collect()
    for label in ("positive", "negative"):
        values = [r[5] for r in rows if r[4] == label]
        n, edges = np.histogram(values, bins=20)
        mine = sorted((r for r in got if r.sentiment == label), key=lambda r: r.bin)
        assert [r.n for r in mine] == list(n)
        assert np.allclose([r.bin_lo for r in mine] + [mine[-1].bin_hi], edges)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([("positive", 0.9)] * 3, "sentiment string, sentiment_confidence double")
    got = sorted(analysis.confidence_histogram(df).collect(), key=lambda r: r.bin)
    n, edges = np.histogram([0.9] * 3, bins=20)
    assert [r.n for r in got] == list(n) and np.allclose([r.bin_lo for r in got], edges[:-1])


def test_median(gold):
    rows = gold_rows()
    for r in analysis.median_confidence(gold).collect():
        assert r.median_confidence == pytest.approx(round(float(np.median([x[5] for x in rows if x[4] == r.sentiment])), 3))


def test_box(spark):
    values = [1, 2, 2, 3, 3, 3, 4, 4, 5, 40, -30]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 7)], "agent string, t int")
    got = {r.agent: r for r in analysis.box_stats(df, "agent", "t").collect()}
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert (got["a"].q1, got["a"].q3, got["a"].outliers) == (q1, q3, 2)
    assert (got["a"].whisker_lo, got["a"].whisker_hi) == (1.0, 5.0)
    assert (got["b"].whisker_lo, got["b"].median, got["b"].whisker_hi) == (7.0, 7.0, 7.0)


def test_missing_sentiment_keeps_its_column(gold):
    row = analysis.category_sentiment(gold).where("category = 'Electronics'").first()
    assert row.neutral == 0 and row.neutral_pct == 0.0 and row.positive_pct + row.negative_pct == pytest.approx(100)


def test_top_lists(gold):
    rows = gold_rows()
    top = analysis.top_entities(gold).where("type = 'brands'").orderBy("place").collect()
    counts = {}
    for r in rows:
        for b in r[8]:
            counts[b] = counts.get(b, 0) + 1
    assert [(r.name, r.n) for r in top] == sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    unique = {r.type: r.unique_names for r in analysis.distinct_entities(gold).collect()}
    assert unique == {"brands": len(counts), "locations": 0, "persons": 1}
    low = analysis.worst_confidence(gold).collect()
    want = sorted((r[5], r[0]) for r in rows if r[5] is not None and r[5] < 0.7)[:10]
    assert [(r.sentiment_confidence, r.review_id) for r in low] == want
    assert [r.review_id for r in analysis.error_sample(gold).collect()] == [f"r{i:04d}" for i in range(0, 250, 50)]
    share = analysis.low_confidence_share(gold).first()
    assert share.low == sum(r[5] is not None and r[5] < 0.7 for r in rows)


def test_report_file(spark, gold, tmp_path):
    path = str(tmp_path / "report")
    write_report(analysis.report(gold), path)
    (line,) = [r.value for r in spark.read.text(path).collect()]
    got = json.loads(line)
    assert got["total_records"] == 400 and sum(got["sentiment_distribution"].values()) == pytest.approx(1, abs=1e-3)
    assert got["unique_locations"] == 0 and got["enrichment_error_rate"] == 0.02
    assert list(got["top_categories"].values()) and "unique_persons" not in got


def physical(plan_of, df):
    return plan_of(df).split("== Physical Plan ==")[1]


def test_plans_read_only_what_they_need(gold, plan_of):
    plan = physical(plan_of, analysis.counts(gold, "sentiment"))
    assert "ReadSchema: struct<sentiment:string>" in plan and "PushedFilters: [IsNotNull(sentiment)]" in plan
    low = physical(plan_of, analysis.low_confidence(gold).select("review_id"))
    assert "LessThan(sentiment_confidence,0.7)" in low and "review_text" not in low.split("ReadSchema")[1]


def test_top_per_type_is_cut_before_the_shuffle(gold, plan_of):
    assert physical(plan_of, analysis.top_entities(gold)).count("WindowGroupLimit") == 2


def test_top_k_never_sorts_everything(gold, plan_of):
    for df in (analysis.top_categories(gold), analysis.worst_confidence(gold), analysis.head(gold)):
        assert "TakeOrderedAndProject" in physical(plan_of, df)
