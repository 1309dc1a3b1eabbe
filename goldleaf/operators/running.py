"""Running totals and row numbers in a global order, without a window over it all.

Rows are range-partitioned on keys and order, and written with the number of their slice.
Each slice is then totalled by itself, and starts from what the slices before it add up to.
A hot key, or a whole table under one key, is spread over slices like any other rows.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.session import written

SLICE = "_slice"
ROW_BITS = 33  # of monotonically_increasing_id; the partition number is above them


def _slices(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranged(df: DataFrame, keys: list[str], order: list[str], slices: int | None = None) -> DataFrame:
    """The rows range-partitioned on keys and order, with their slice number, as a written table.

    Written, because another evaluation could draw other range bounds.
    """
    parts = df.repartitionByRange(slices or _slices(df), *keys, *order)
    return written(parts.withColumn(SLICE, F.spark_partition_id()), "ranged")


def running_totals(
    df: DataFrame, keys: list[str], order: list[str], totals: dict[str, str], slices: int | None = None
) -> DataFrame:
    """Add columns that sum others up to and with the current row, per key in the given order.

    `totals` maps new columns to summed ones. The order has to settle every tie that matters.
    """
    return totals_over(ranged(df, keys, order, slices), keys, order, totals, slices)


def totals_over(
    saved: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, str],
    slices: int | None = None,
    wholes: dict[str, str] | None = None,
) -> DataFrame:
    """`running_totals` of a table from `ranged`.

    `wholes` maps further new columns to ones that are summed over all rows of the key.
    """
    n = slices or _slices(saved)
    wholes = wholes or {}
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    others = Window.partitionBy(*keys)
    sums = {**totals, **wholes}
    per_slice = saved.groupBy(SLICE, *keys).agg(*[F.sum(source).alias(name) for name, source in sums.items()])
    # Sums of sums keep the type of the sums, so that decimals lose no places.
    kinds = {name: per_slice.schema[name].dataType for name in sums}
    carry = (
        per_slice.select(
            F.col(SLICE).alias("_c_slice"),
            *[F.col(k).alias(f"_c_{k}") for k in keys],
            *[F.sum(name).over(before).cast(kinds[name]).alias(f"_c_{name}") for name in totals],
            # What the key has in other slices.
            *[(F.sum(name).over(others) - F.col(name)).cast(kinds[name]).alias(f"_c_{name}") for name in wholes],
            F.row_number().over(Window.partitionBy(*keys).orderBy(SLICE)).alias("_c_nth"),
            F.count("*").over(others).alias("_c_of"),
        )
        # Only the first key of a slice can have rows in an earlier one, and only the last in a
        # later one: at most two rows per slice are left, which makes the broadcast safe.
        .where((F.col("_c_of") > 1) if wholes else (F.col("_c_nth") > 1))
        .drop("_c_nth", "_c_of")
    )
    inside = Window.partitionBy(SLICE, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    of_key = Window.partitionBy(SLICE, *keys)
    local = saved.repartitionById(n, F.col(SLICE)).withColumns(
        {name: F.sum(source).over(inside) for name, source in totals.items()}
        | {name: F.sum(source).over(of_key) for name, source in wholes.items()}
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys], F.col(SLICE) == F.col("_c_slice"))
    joined = local.join(F.broadcast(carry), same, "left")
    return joined.withColumns(
        {
            name: F.coalesce(F.col(name) + F.col(f"_c_{name}"), F.col(name)).cast(kinds[name])
            for name in sums
        }
    ).select(*[c for c in saved.columns if c != SLICE], *sums)


def row_numbers(df: DataFrame, order: list[str], name: str, slices: int | None = None) -> DataFrame:
    """Add the position of each row, from 0, in the given order. No window at all."""
    n = slices or _slices(df)
    saved = written(
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn(SLICE, F.shiftright("_at", ROW_BITS))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice.
    starts = (
        saved.groupBy(SLICE)
        .count()
        .select(SLICE, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    local = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return saved.join(F.broadcast(starts), SLICE).select(
        *df.columns, (F.col("_start") + local).alias(name)
    )
