"""Per-agent parsing of an answer's JSON object to a struct, and its validation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldleaf.functions import text as tx
from goldleaf.schemas import CATEGORIES, FALLBACK_CATEGORY, SENTIMENTS


def sentiment(obj: Column) -> Column:
    """struct<sentiment, confidence>; the label is not trimmed."""
    return F.when(
        obj.isNotNull(),
        F.struct(
            F.lower(tx.field_text(obj, "sentiment")).alias("sentiment"),
            tx.field_number(obj, "confidence").alias("confidence"),
        ),
    )


def sentiment_valid(parsed: Column) -> Column:
    """A known label, and a confidence from 0 to 1; NaN is none."""
    return parsed["sentiment"].isin(SENTIMENTS) & parsed["confidence"].between(0.0, 1.0)


def known_category(label: Column) -> Column:
    """The label in its listed spelling, or the fallback for one not listed."""
    spelling = F.create_map(*[F.lit(x) for c in CATEGORIES for x in (c.lower(), c)])
    return F.coalesce(F.element_at(spelling, F.lower(label)), F.lit(FALLBACK_CATEGORY))


def category(obj: Column) -> Column:
    """struct<category, subcategory>; any JSON object gives one."""
    return F.when(
        obj.isNotNull(),
        F.struct(
            known_category(tx.strip(tx.field_text(obj, "category"))).alias("category"),
            tx.strip(tx.field_text(obj, "subcategory")).alias("subcategory"),
        ),
    )


def category_valid(parsed: Column) -> Column:
    return parsed["category"].isin(CATEGORIES)


def entity(obj: Column) -> Column:
    """struct<brands, locations, persons> of string lists; any JSON object gives one."""
    names = ["brands", "locations", "persons"]
    return F.when(obj.isNotNull(), F.struct(*[tx.field_strings(obj, n).alias(n) for n in names]))


def entity_valid(parsed: Column) -> Column:
    """The three lists are there, empty or not."""
    return parsed["brands"].isNotNull() & parsed["locations"].isNotNull() & parsed["persons"].isNotNull()


def total_entities(brands: Column, locations: Column, persons: Column) -> Column:
    return sum(F.coalesce(F.array_size(c), F.lit(0)) for c in (brands, locations, persons))
