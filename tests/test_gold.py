"""The upsert table and the call log."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from goldleaf.operators.pending import not_in
from goldleaf.schemas import CALL_LOG, GOLD
from goldleaf.session import scratch, written
from goldleaf.sources.calllog import append_calls, read_calls
from goldleaf.sources.gold import GoldTable, align, scratch_gold, with_json_lists
from goldleaf.sources.silver import read_or_empty


def rows(spark, ids, mark, day=1):
    return spark.createDataFrame([(i,) for i in ids], "review_id string").select(
        "review_id",
        F.lit(mark).alias("sentiment"),
        F.lit(f"2024-06-{day:02d}").cast("timestamp").alias("enriched_at"),
        F.lit("dropped").alias("sentiment_model"),
    )


def marks(table):
    return {r.review_id: r.sentiment for r in table.read().collect()}


@pytest.fixture()
def table(spark):
    return scratch_gold(spark, 4)


def test_empty(spark, table):
    assert not table.exists() and table.count() == 0
    assert table.read().schema == GOLD and table.read().count() == 0 and table.ids().count() == 0
    assert table.upsert(rows(spark, [], "x")) == 0 and table.exists()
    assert table.read().columns == GOLD.names and table.count() == 0


def test_insert_then_replace(spark, table):
    names = [f"r{i}" for i in range(20)]
    assert table.upsert(rows(spark, names, "a")) == 20
    assert table.upsert(rows(spark, ["r20", "r3"], "b", 2)) == 2
    assert table.count() == 21 == table.read().count() and table.ids().count() == 22
    assert marks(table) == {**{n: "a" for n in names}, "r3": "b", "r20": "b"}
    # The later upsert counts, whatever the rows say of their time.
    table.upsert(rows(spark, ["r3"], "c", 1))
    assert marks(table)["r3"] == "c"


def exchanges(plan_of, df):
    return plan_of(df).split("== Physical Plan ==")[1].count("Exchange hashpartitioning")


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_table_is_never_shuffled(spark, table, plan_of, no_broadcast):
    """Its current rows, its count and both joins with its keys go bucket by bucket."""
    table.upsert(rows(spark, [f"r{i}" for i in range(30)], "a"))
    table.upsert(rows(spark, ["r1", "r2"], "b"))
    assert exchanges(plan_of, table.read()) == 0 and exchanges(plan_of, table.ids().distinct()) == 0
    source = written(rows(spark, [f"r{i}" for i in range(20, 50)], "x"), "source")
    waiting = not_in(source, table.ids(), "review_id")
    # One exchange: that of the input.
    assert exchanges(plan_of, waiting) == 1 and waiting.count() == 20
    plan = plan_of(table.read().groupBy("sentiment").count())
    assert "review_text" not in plan.split("ReadSchema")[-1]


def test_another_session_takes_the_table_up(spark, table):
    table.upsert(rows(spark, ["a", "b"], "x"))
    other = spark.newSession()
    GoldTable(other, table.name, buckets=4, location=table.location).upsert(rows(other, ["b", "c"], "y"))
    assert marks(table) == {"a": "x", "b": "y", "c": "y"}
    spark.sql(f"DROP TABLE {table.name}")  # as for a catalog that was lost
    again = GoldTable(spark, f"{table.name}_again", buckets=4, location=table.location)
    again.create()
    assert marks(again) == {"a": "x", "b": "y", "c": "y"} and again.upsert(rows(spark, ["a"], "z")) == 1
    assert marks(again)["a"] == "z"


def test_named_in_a_schema(spark):
    table = GoldTable(spark, f"s{uuid.uuid4().hex[:8]}.reviews", buckets=2)
    assert not table.exists() and table.upsert(rows(spark, ["a"], "x")) == 1
    assert read_or_empty(spark, table.name, GOLD).count() == 1 == table.count()


def test_repeat_changes_nothing(spark, table):
    batch = rows(spark, ["a", "b"], "x")
    table.upsert(batch)
    first = sorted(map(str, table.read().collect()))
    table.upsert(batch)
    assert sorted(map(str, table.read().collect())) == first and table.count() == 2


def test_newest_copy_counts(spark, table):
    hot = rows(spark, ["hot"] * 500, "old").unionByName(rows(spark, ["hot"], "new", 5))
    assert table.upsert(hot.unionByName(rows(spark, ["x"] * 3, "same"))) == 2
    assert marks(table) == {"hot": "new", "x": "same"}


def test_null_key_is_refused(spark, table):
    table.upsert(rows(spark, ["a"], "x"))
    with pytest.raises(Exception, match="review_id is null"):
        table.upsert(rows(spark, ["b", None], "y"))
    # Nothing of the failed batch shows.
    assert marks(table) == {"a": "x"} and table.ids().count() == 1


def test_failed_batch_leaves_the_table(spark, table):
    table.upsert(rows(spark, ["a"], "x"))
    bad = rows(spark, ["a", "b"], "y").withColumn("sentiment", F.when(F.col("review_id") == "b", F.raise_error(F.lit("no"))).otherwise("y"))
    with pytest.raises(Exception, match="no"):
        table.upsert(bad)
    assert marks(table) == {"a": "x"}


def test_upsert_one(spark, table):
    assert table.upsert_one({"review_id": "a", "sentiment": "positive", "entities_brands": ["B"]}) == 1
    table.upsert_one({"review_id": "a", "sentiment": "negative", "date": dt.date(2024, 6, 1)})
    row = table.read().first()
    assert row.sentiment == "negative" and row.entities_brands == [] and row.date == dt.date(2024, 6, 1)


def test_align(spark):
    out = align(rows(spark, ["a"], "x"))
    assert [f.name for f in out.schema] == GOLD.names and out.first().tokens_used == 0
    text = with_json_lists(out).first()
    assert text.entities_brands == "[]"


def test_call_log(spark):
    path = scratch(spark, "log")
    assert read_calls(spark, path).count() == 0 and read_calls(spark, path).schema == CALL_LOG
    at = dt.datetime(2024, 6, 2, 6, 0, 1)
    calls = spark.createDataFrame(
        [(at, "SentimentAgent", "gpt-4o", "r1", 85, 56, 141, None, None)], CALL_LOG
    ).withColumn("cost_usd", F.lit("0.001265").cast("decimal(18,8)"))
    append_calls(calls, path, "20240602")
    append_calls(calls, path, "20240602")
    append_calls(calls, path, "b", 1)
    back = read_calls(spark, path).orderBy("batch_id").collect()
    assert [(r.timestamp, r.batch_id, str(r.cost_usd)) for r in back] == [
        (at, "20240602", "0.00126500"), (at, "b", "0.00126500"),
    ]


def test_files_are_bounded_by_buckets(spark, tmp_path):
    """Many shuffle partitions do not make many files."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        table = GoldTable(spark, f"g{uuid.uuid4().hex[:8]}", buckets=16, location=str(tmp_path / "gold"))
        table.upsert(spark.range(5000).select(F.col("id").cast("string").alias("review_id")), unique=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(list(tmp_path.rglob("*.parquet"))) <= 32 and table.count() == 5000


def test_scratch_tables_go_with_their_block(spark):
    from pathlib import Path

    from goldleaf.session import scratch, scratch_tables

    with scratch_tables(spark):
        path = scratch(spark, "gone")
        spark.range(3).write.parquet(path)
        assert Path(path).exists()
    assert not Path(path).exists()
