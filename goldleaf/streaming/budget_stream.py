"""Running cost of every run, and the moment it passes the budget, as calls arrive.

Costs are first summed per run and minute, combined before the shuffle, so a run with a third of all calls is one row per
minute. Sums that the watermark has closed go on to a processor that keeps the total of each run, and so far whether
it is beyond the budget: the first minute that passes it is marked, once. `crossing_calls` then finds the very call, from the
calls of that one minute in the log.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from goldleaf.functions.cost import MONEY
from goldleaf.operators.costs import CALL_ORDER, cumulative

#: Units of a dollar that costs are whole numbers of.
UNITS = 10**8
MINUTE = "1 minute"


class Totals(StatefulProcessor):
    """The running total of one run."""

    def __init__(self, budget: int | None) -> None:
        self.budget = budget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "spent long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = self.total.get()[0] if self.total.exists() else 0
        # Minutes closed later begin later, so their order over batches is that of time.
        minutes = pd.concat(list(rows)).sort_values("minute", kind="stable")
        total = before + minutes["spent"].cumsum()
        self.total.update((int(total.iloc[-1]),))
        crossed = pd.Series(False, index=total.index)
        if self.budget is not None:
            crossed = (total > self.budget) & (total - minutes["spent"] <= self.budget)
        yield pd.DataFrame(
            {"batch_id": key[0], "minute": minutes["minute"], "spent": minutes["spent"], "total": total, "crossed": crossed}
        )

    def close(self) -> None:
        pass


def running_cost(calls: DataFrame, budget_usd: float | None = None, lateness: str = "2 minutes") -> DataFrame:
    """Per run and closed minute: its cost, the run's total up to its end, and whether that is the first above the budget.

    No budget, or 0, never marks a minute. The state has to be on disk, as for `limit_verdicts`.
    """
    closed = (
        calls.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", MINUTE), "batch_id")
        .agg(F.sum((F.coalesce("cost_usd", F.lit(0)) * UNITS).cast("long")).alias("spent"))
        .select("batch_id", F.unix_micros("window.start").alias("minute"), "spent")
    )
    out = T.StructType().add("batch_id", "string").add("minute", "long").add("spent", "long").add("total", "long").add("crossed", "boolean")
    totals = closed.groupBy("batch_id").transformWithStateInPandas(
        Totals(round(budget_usd * UNITS) if budget_usd else None), out, outputMode="append", timeMode="None"
    )
    dollars = {c: (F.col(c).cast("decimal(20,0)") / UNITS).cast(MONEY) for c in ("spent", "total")}
    return totals.withColumns({"minute": F.timestamp_micros("minute"), **dollars})


def crossing_calls(minutes: DataFrame, log: DataFrame, budget_usd: float) -> DataFrame:
    """Per run beyond its budget, the first call that took it there, from the marked minutes and the log."""
    # A row per run; only the calls of those minutes are put in order.
    marked = minutes.where("crossed").select(
        "batch_id", F.col("minute").alias("_minute"), (F.col("total") - F.col("spent")).alias("_before")
    )
    of_minute = log.withColumn("_minute", F.window("timestamp", MINUTE)["start"]).join(marked, ["batch_id", "_minute"])
    spent = cumulative(of_minute, ["batch_id"]).withColumn("cumulative_cost", (F.col("cumulative_cost") + F.col("_before")).cast(MONEY))
    over = spent.where(F.col("cumulative_cost") > F.lit(budget_usd).cast("decimal(18,8)"))
    first = F.min(F.struct(*CALL_ORDER, "cumulative_cost")).alias("_first")
    return over.groupBy("batch_id").agg(first).select("batch_id", "_first.*")
