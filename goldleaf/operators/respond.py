"""The model call: the one stage that leaves the JVM.

A responder takes a frame of prompts and gives a frame of responses. `pandas_responder`
makes one from a function over pandas batches, which is opened once per partition.
"""

from __future__ import annotations

import time
import warnings
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame

from goldleaf.schemas import RESPONSE

Responder = Callable[[DataFrame], DataFrame]

NO_TEXT = "the record has no text"


class RecordError(Exception):
    """Raised by a model function when the whole record is to be given up."""


#: Calls a task makes at most or so; what a lost task has to pay again.
CALLS_PER_TASK = 200
#: Tasks of one round at most; beyond it they get longer. Waves keep rounds below it.
MOST_TASKS = 20_000


def _answer(call: Callable[..., tuple[str, int]], row) -> tuple:
    """One call: answer, tokens, milliseconds, error, fatal, and the time it was made.

    A failed call reports no tokens; a row without a prompt fails without a call.
    """
    at, start = pd.Timestamp.now(tz="UTC"), time.monotonic()
    if row.prompt is None:
        return None, 0, 0.0, NO_TEXT, False, at
    try:
        raw, tokens, error, fatal = *call(row), None, False
    except RecordError as exc:
        raw, tokens, error, fatal = None, 0, str(exc), True
    except Exception as exc:
        raw, tokens, error, fatal = None, 0, str(exc) or type(exc).__name__, False
    return raw, tokens, (time.monotonic() - start) * 1000, error, fatal, at


def pandas_responder(open_client: Callable[[], Callable[..., tuple[str, int]]], threads: int = 1) -> Responder:
    """Responder from a client factory.

    `open_client()` runs once per partition and gives a function from a prompt row (with the
    fields of `PROMPT`, so the agent's settings too) to answer text and token count. With
    `threads` above 1 a task makes so many calls at a time, for clients that allow it. An
    exception it raises becomes the row's `error`; no row ever fails the task.
    """

    def respond(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = open_client()
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                ask = pool.map if threads > 1 else map
                rows = list(ask(lambda row: _answer(call, row), batch.itertuples(index=False)))
                out = pd.DataFrame(rows, columns=["raw", "tokens", "latency_ms", "error", "fatal", "called_at"])
                keys = batch[["record_id", "agent", "attempt", "model"]].reset_index(drop=True)
                yield pd.concat([keys, out], axis=1)[RESPONSE.names]

    return lambda prompts: prompts.mapInPandas(respond, RESPONSE)


def spread(rows: DataFrame, n: int, keys: list[str], calls_per_task: int = CALLS_PER_TASK) -> DataFrame:
    """Rows dealt to tasks by the number `n` of calls they lead to.

    Prompts are small and calls are slow, so the sizes in bytes that adaptive execution goes by
    would leave a round to a few tasks. A number that is asked for is kept. Records are dealt before
    they are exploded into pairs, since every pair would take a copy of the text through the shuffle.
    """
    return rows.repartition(max(1, min(MOST_TASKS, -(-n // calls_per_task))), *keys)


def respond(prompts: DataFrame, responder: Responder) -> DataFrame:
    """Responses to all prompts, one per row.

    Whoever uses the result more than once has to write it first: evaluating it again would
    repeat the calls.
    """
    if prompts.sparkSession.conf.get("spark.speculation", "false") == "true":
        warnings.warn("spark.speculation is on: slow tasks would repeat their model calls")
    return responder(prompts).select(RESPONSE.names)
