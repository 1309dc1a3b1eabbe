"""Table schemas and the fixed domains the parsers validate against."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values -----------------------------------------------------------------

SENTIMENTS = ["positive", "negative", "neutral"]

CATEGORIES = [
    "Electronics",
    "Clothing & Apparel",
    "Home & Garden",
    "Books & Media",
    "Sports & Outdoors",
    "Food & Beverages",
    "Health & Beauty",
    "Toys & Games",
    "Automotive",
    "E-commerce",
    "Other",
]
FALLBACK_CATEGORY = "Other"

# USD per 1,000 tokens: model, input price, output price. Other models cost nothing.
PRICES = [
    ("gpt-4o", "0.005", "0.015"),
    ("gpt-4o-mini", "0.000150", "0.000600"),
    ("gpt-4-turbo", "0.010", "0.030"),
    ("gpt-3.5-turbo", "0.000500", "0.001500"),
    ("gemini-1.5-pro", "0.007", "0.021"),
    ("gemini-1.5-flash", "0.000350", "0.001050"),
]

UNKNOWN_MODEL = "unknown"
INPUT_SHARE = 0.6
OUTPUT_SHARE = 0.4
DEFAULT_RPM = 500
DEFAULT_TPM = 30_000
WINDOW_SECONDS = 60
CONFIDENCE_THRESHOLD = 0.70

# Schemas ----------------------------------------------------------------------

# One record of the input table; more columns are carried through.
SILVER = T.StructType(
    [
        T.StructField("review_id", T.StringType(), False),
        T.StructField("product_id", T.StringType()),
        T.StructField("review_text", T.StringType()),
        T.StructField("date", T.DateType()),
    ]
)

ENTITY_COLUMNS = ["entities_brands", "entities_locations", "entities_persons"]

GOLD = T.StructType(
    [
        T.StructField("review_id", T.StringType(), False),
        T.StructField("product_id", T.StringType()),
        T.StructField("review_text", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("sentiment_confidence", T.DoubleType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("entities_brands", T.ArrayType(T.StringType())),
        T.StructField("entities_locations", T.ArrayType(T.StringType())),
        T.StructField("entities_persons", T.ArrayType(T.StringType())),
        T.StructField("enriched_at", T.TimestampType()),
        T.StructField("model_used", T.StringType()),
        T.StructField("tokens_used", T.IntegerType()),
        T.StructField("enrichment_cost_usd", T.DoubleType()),
        T.StructField("enrichment_error", T.BooleanType()),
    ]
)

CALL_LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("agent", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("input_tokens", T.IntegerType()),
        T.StructField("output_tokens", T.IntegerType()),
        T.StructField("total_tokens", T.IntegerType()),
        T.StructField("cost_usd", T.DecimalType(18, 8)),
        T.StructField("batch_id", T.StringType()),
    ]
)

# What goes to a responder, and what comes back: one row per (record, agent, attempt).
PROMPT = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("agent", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("model", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("max_tokens", T.IntegerType()),
        T.StructField("timeout_seconds", T.IntegerType()),
        T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
        T.StructField("system", T.StringType()),
        T.StructField("prompt", T.StringType()),
    ]
)

RESPONSE = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("agent", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("model", T.StringType()),
        T.StructField("raw", T.StringType()),
        T.StructField("tokens", T.IntegerType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("error", T.StringType()),
        T.StructField("fatal", T.BooleanType()),
        T.StructField("called_at", T.TimestampType()),
    ]
)
