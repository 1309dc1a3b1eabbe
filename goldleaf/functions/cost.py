"""Token split and call cost, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldleaf.schemas import INPUT_SHARE, OUTPUT_SHARE, PRICES

MONEY = "decimal(18,8)"


def input_tokens(total: Column) -> Column:
    return (total.cast("double") * F.lit(INPUT_SHARE)).cast("int")


def output_tokens(total: Column) -> Column:
    return (total.cast("double") * F.lit(OUTPUT_SHARE)).cast("int")


def _price(model: Column, position: int) -> Column:
    """Price of one token; the list is a handful of constants, so no join is needed."""
    table = F.create_map(
        *[
            item
            for row in PRICES
            for item in (F.lit(row[0]), (F.lit(row[position]).cast("decimal(12,6)") / 1000).cast("decimal(12,9)"))
        ]
    )
    return F.coalesce(F.element_at(table, model), F.lit(0).cast("decimal(12,9)"))


def priced(model: Column) -> Column:
    """Whether the model is in the price list."""
    return F.coalesce(model.isin([row[0] for row in PRICES]), F.lit(False))


def call_cost(model: Column, tokens_in: Column, tokens_out: Column) -> Column:
    """Exact cost to 8 places: a sum of these does not depend on its order."""
    cost = tokens_in.cast("decimal(10,0)") * _price(model, 1) + tokens_out.cast("decimal(10,0)") * _price(model, 2)
    return F.round(cost, 8).cast(MONEY)
