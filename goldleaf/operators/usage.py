"""Requests and tokens in a sliding window over the call log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.operators.running import running_totals
from goldleaf.schemas import DEFAULT_RPM, DEFAULT_TPM, WINDOW_SECONDS

MICROS = 1_000_000


def sliding(
    calls: DataFrame,
    key: str,
    call_id: str,
    tokens: str = "total_tokens",
    rpm: int = DEFAULT_RPM,
    tpm: int = DEFAULT_TPM,
    window_seconds: int = WINDOW_SECONDS,
) -> DataFrame:
    """Each call with what the window ending at it holds, and whether it keeps the limits.

    The window reaches back to `window_seconds` before the call, that instant included;
    calls at one instant count in id order. It is a running total: every call adds itself at
    its time and takes itself off just after it has left the window. So a busy minute or key
    needs no frame in one task.
    """
    at = F.unix_micros("timestamp")
    kept = [key, "timestamp", call_id, tokens]
    add = calls.select(*kept, at.alias("_at"), F.lit(1).alias("_n"), F.col(tokens).cast("bigint").alias("_t"))
    drop = calls.select(
        *kept,
        (at + window_seconds * MICROS + 1).alias("_at"),
        F.lit(-1).alias("_n"),
        (-F.col(tokens).cast("bigint")).alias("_t"),
    )
    moves = add.unionByName(drop)
    # At one instant, departures (-1) come before arrivals.
    both = running_totals(
        moves, [key], ["_at", "_n", call_id], {"requests_in_window": "_n", "tokens_in_window": "_t"}
    )
    return both.where(F.col("_n") == 1).select(
        *kept,
        "requests_in_window",
        "tokens_in_window",
        (F.col("requests_in_window") - 1 < rpm).alias("rpm_ok"),
        (F.col("tokens_in_window") <= tpm).alias("tpm_ok"),
    )


def current(
    calls: DataFrame,
    key: str,
    tokens: str = "total_tokens",
    window_seconds: int = WINDOW_SECONDS,
    as_of: str | None = None,
) -> DataFrame:
    """Requests and tokens per key in the window that ends now: at `as_of`, or the latest call.

    Only calls in the window are counted; of the others no more than the key is read.
    """
    now = F.lit(as_of).cast("timestamp") if as_of else calls.select(F.max("timestamp")).scalar()
    inside = F.col("timestamp").between(now - F.make_dt_interval(secs=F.lit(window_seconds)), now)
    counted = calls.where(inside).groupBy(F.col(key).alias("_key")).agg(
        F.count("*").alias("current_rpm"), F.coalesce(F.sum(tokens), F.lit(0)).alias("current_tpm")
    )
    keys = calls.select(key).distinct()
    return keys.join(counted, F.col(key).eqNullSafe(F.col("_key")), "left").select(
        key, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("current_rpm", "current_tpm")]
    )
