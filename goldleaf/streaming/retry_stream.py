"""Continuous enrichment in which failed answers wait in state, not in the driver.

A record is one key. Its state holds the record and how far each agent has come, and lives until all agents are
settled. The processor never calls a model: it says whom to ask about what, and when. Every micro-batch

* asks about the pairs that are due, saves the answers with their parse, and
* writes their verdicts to a folder that is the stream's second source, so the processor hears of them in a later batch.

A pair that failed gets a processing-time timer after its back-off, and is asked about again in whichever batch runs then;
others go on meanwhile. When the last agent of a record is settled the record leaves the state, and its batch
merges the saved answers into the output table.

A batch that is repeated after a crash finds its answers saved and pays for none of them again. Records that the
output holds are not asked about. A record that comes while one of the same id is open is the same record; of several in one
batch the one that a batch run would take counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from goldleaf.functions.text import non_blank
from goldleaf.operators import assemble
from goldleaf.operators.pending import not_in
from goldleaf.operators.prompts import render
from goldleaf.operators.respond import Responder, respond, spread
from goldleaf.plans.enrich import RunConfig
from goldleaf.schemas import RESPONSE
from goldleaf.session import STATE_ON_DISK, path_exists, settings
from goldleaf.sources.calllog import append_calls
from goldleaf.sources.gold import GoldTable
from goldleaf.sources.templates import read_templates

#: What the processor hears: a record (with its text form), or the verdict on an answer.
NEWS = "key string, record string, tie long, agent string, attempt int, verdict string, batch long"
#: What it says: whom to ask, or that a record is settled, and in which batches its answers are.
ORDERS = "key string, order string, record string, agent string, attempt int, batches string"
STAMPS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


class Retries(StatefulProcessor):
    """One record: attempts, waits and settled agents."""

    def __init__(self, backoffs: dict[str, float]) -> None:
        self.backoffs = backoffs

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.record = handle.getValueState("record", "record string, batches string")
        self.agents = handle.getMapState("agents", "agent string", "attempt int, state string, due long")

    def _orders(self, key: str, rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["order", "record", "agent", "attempt", "batches"])
        frame.insert(0, "key", key)
        frame["attempt"] = frame["attempt"].astype("Int32")
        return frame

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        news = pd.concat(list(rows))
        orders = []
        opened = news[news["verdict"] == "new"]
        if len(opened) and not self.record.exists():
            record = opened.sort_values("tie").iloc[-1]["record"]
            self.record.update((record, ""))
            for agent in self.backoffs:
                self.agents.updateValue((agent,), (1, "asked", 0))
                orders.append(("ask", record, agent, 1, None))
        heard = news[news["verdict"] != "new"]
        if len(heard) and self.record.exists():
            record, batches = self.record.get()
            if (heard["verdict"] == "stored").any():
                self._forget()
            else:
                batches = sorted({*filter(None, batches.split(",")), *(str(int(b)) for b in heard["batch"])}, key=int)
                for row in heard.itertuples(index=False):
                    self._heard(row, timerValues)
                if all(state[1] == "settled" for state in self.agents.values()):
                    orders.append(("settled", record, None, None, ",".join(batches)))
                    self._forget()
                else:
                    self.record.update((record, ",".join(batches)))
        if orders:
            yield self._orders(key[0], orders)

    def _heard(self, row, timers) -> None:
        attempt, state, _ = self.agents.getValue((row.agent,))
        if state != "asked" or attempt != int(row.attempt):
            return  # heard of before
        if row.verdict == "again":
            due = timers.getCurrentProcessingTimeInMs() + round(1000 * self.backoffs[row.agent] ** (attempt - 1))
            self.handle.registerTimer(due)
            self.agents.updateValue((row.agent,), (attempt, "waiting", due))
        else:
            self.agents.updateValue((row.agent,), (attempt, "settled", 0))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        orders = []
        if self.record.exists():
            record, _ = self.record.get()
            for (agent,), (attempt, state, due) in list(self.agents.iterator()):
                if state == "waiting" and due <= expiredTimerInfo.getExpiryTimeInMs():
                    self.agents.updateValue((agent,), (attempt + 1, "asked", 0))
                    orders.append(("ask", record, agent, attempt + 1, None))
        if orders:
            yield self._orders(key[0], orders)

    def _forget(self) -> None:
        self.record.clear()
        self.agents.clear()

    def close(self) -> None:
        pass


class Batches:
    """What a micro-batch does with the processor's orders."""

    def __init__(self, silver: DataFrame, gold: GoldTable, responder: Responder, folder: str, config: RunConfig, name: str) -> None:
        self.schema, self.gold, self.responder = silver.schema, gold, responder
        self.folder, self.config, self.name = folder, config, name
        self.limits = {a.name: a.config.max_retries for a in config.agents}

    def __call__(self, orders: DataFrame, number: int) -> None:
        spark = orders.sparkSession
        place = f"{self.folder}/orders"
        # Written first: the state is worked out once, whatever reads its orders. A repeated batch makes them anew.
        orders.write.mode("overwrite").parquet(place)
        orders = spark.read.schema(ORDERS).parquet(place)
        kinds = {r.order for r in orders.select("order").distinct().collect()}  # two at most
        if "ask" in kinds:
            self._ask(orders.where(F.col("order") == "ask"), number)
        if "settled" in kinds:
            self._settle(orders.where(F.col("order") == "settled"), number)

    def _ask(self, orders: DataFrame, number: int) -> None:
        """Ask about the pairs that are due, and tell the processor how it went."""
        spark, spec, agents = orders.sparkSession, self.config.spec, self.config.agents
        due, stored = orders, None
        if self.gold.exists():
            held = self.gold.ids().select(F.col(self.gold.id_col).alias("key"))
            first = orders.where(F.col("attempt") == 1)
            stored = first.select("key").distinct().join(held, "key", "left_semi").distinct()
            due = not_in(first, held, "key").unionByName(orders.where(F.col("attempt") > 1))
        answers = f"{self.folder}/answers/{number}"
        if not path_exists(spark, f"{answers}/_SUCCESS"):
            pairs = due.select(self._record().alias("r"), "agent", "attempt").select("r.*", "agent", "attempt")
            dealt = spread(pairs, due.count(), [spec.id_col, "agent"], self.config.calls_per_task)
            prompts = render(dealt, agents, read_templates(spark, agents, self.config.template_dir), spec)
            parsed = assemble.parse(respond(prompts, self.responder), agents)
            parsed.write.mode("overwrite").parquet(answers)
        said = self._answers(spark, [number])
        heard = said.select(
            F.col("record_id").alias("key"), F.lit(None).cast("string").alias("record"), F.lit(None).cast("long").alias("tie"),
            "agent", "attempt", F.when(assemble.again(self.limits), "again").otherwise("settled").alias("verdict"),
            F.lit(number).cast("long").alias("batch"),
        )
        if stored is not None:
            heard = heard.unionByName(stored.withColumn("verdict", F.lit("stored")), allowMissingColumns=True)
        heard.write.mode("overwrite").parquet(f"{self.folder}/news/{number}")

    def _record(self) -> Column:
        return F.from_json("record", self.schema, STAMPS)

    def _answers(self, spark: SparkSession, numbers: list[int]) -> DataFrame:
        schema = assemble.parse(spark.createDataFrame([], RESPONSE), self.config.agents).schema
        return spark.read.schema(schema).parquet(*[f"{self.folder}/answers/{n}" for n in numbers])

    def _settle(self, done: DataFrame, number: int) -> None:
        """Records whose agents are all settled go to the output, with the answers of the batches they name."""
        spark, spec, agents = done.sparkSession, self.config.spec, self.config.agents
        # As many as there are batches that a record still open was asked in.
        named = done.select(F.explode(F.split("batches", ",")).alias("n")).distinct().collect()
        as_of = F.lit(self.config.as_of).cast("timestamp") if self.config.as_of else None
        rows = done.select(self._record().alias("r")).select("r.*").withColumn(spec.id_col, F.col(spec.id_col).cast("string"))
        mine = self._answers(spark, sorted(int(r.n) for r in named)).join(done.select(F.col("key").alias("record_id")), "record_id", "left_semi")
        settled = assemble.settled(mine, self.limits)
        merged = assemble.merge(rows, assemble.wide(settled, agents), agents, spec, as_of)
        # The log first: a record that is in the output has its calls there, whenever the query is stopped.
        if self.config.log_path:
            append_calls(assemble.call_log(settled, agents, self.name), self.config.log_path, self.name, str(number))
        self.gold.upsert(merged.withColumnsRenamed({spec.id_col: self.gold.id_col, spec.text_col: "review_text"}), unique=True)


def retry_stream(
    silver: DataFrame,
    gold: GoldTable,
    responder: Responder,
    folder: str,
    config: RunConfig = RunConfig(),
    name: str = "enrich",
    **trigger,
) -> StreamingQuery:
    """Enrich a stream of records; failed pairs are asked about again when their back-off is over.

    `folder` holds the query's checkpoint, answers and verdicts. It runs until it is stopped: timers need batches.
    """
    spark, spec = silver.sparkSession, config.spec
    kept = silver.where(non_blank(F.col(spec.text_col)))
    key = F.coalesce(F.col(spec.id_col).cast("string"), F.raise_error(F.lit(f"{spec.id_col} is null")))
    fresh = kept.select(
        key.alias("key"), F.to_json(F.struct(*kept.columns), STAMPS).alias("record"), F.xxhash64(*kept.columns).alias("tie"),
        F.lit(None).cast("string").alias("agent"), F.lit(None).cast("int").alias("attempt"), F.lit("new").alias("verdict"),
        F.lit(None).cast("long").alias("batch"),
    )
    # The folder has to exist before it can be a source.
    spark.createDataFrame([], NEWS).write.mode("append").parquet(f"{folder}/news/start")
    heard = spark.readStream.schema(NEWS).option("recursiveFileLookup", "true").parquet(f"{folder}/news")
    backoffs = {a.name: a.config.retry_backoff_base for a in config.agents}
    orders = fresh.unionByName(heard).groupBy("key").transformWithStateInPandas(
        Retries(backoffs), ORDERS, outputMode="append", timeMode="ProcessingTime"
    )
    with settings(spark, STATE_ON_DISK):
        return (
            orders.writeStream.foreachBatch(Batches(silver, gold, responder, folder, config, name))
            .option("checkpointLocation", f"{folder}/checkpoint").queryName(name)
            .trigger(**(trigger or {"processingTime": "0 seconds"})).start()
        )


def finish(query: StreamingQuery, gold: GoldTable, folder: str) -> None:
    """Run a query until every record it has asked about is in the output, then stop it; for input that has come to an end."""
    spark = gold.spark
    while not query.awaitTermination(1):
        last = query.lastProgress
        # Timers make a batch of every trigger, so one without input says that all input has been taken.
        if last and last["numInputRows"] == 0:
            heard = spark.read.schema(NEWS).option("recursiveFileLookup", "true").parquet(f"{folder}/news").select("key").distinct()
            if not_in(heard, gold.ids().withColumnRenamed(gold.id_col, "key"), "key").isEmpty():
                query.stop()
                return
