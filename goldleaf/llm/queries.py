"""The operators over the driver's tables, one query each, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm import (
    arrowfiles, centroids, divergence, exactdups, licenses, mixing, packing, pii, quality, simhash, substrings, toxicity,
    vptree,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(documents(spark, sf_dir), ["doc_id"]).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spotted(documents(spark, sf_dir), ["doc_id"])
    return found.select(
        "doc_id", *[pii.counted(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.written_out(F.col("base")), 256).alias("base_sha256"), pii.written_out(F.col("spans")).alias("spans"),
    )


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), ["doc_id"], vocabulary("word_bpe_49k.json"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir), ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classified(documents(spark, sf_dir), ["doc_id"])
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.labelled(documents(spark, sf_dir), ["doc_id"])
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(documents(spark, sf_dir), table(spark, sf_dir, "labels"), ["doc_id"])


def op10_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrowfiles.round_trip(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir), ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_exactdups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdups.judged(documents(spark, sf_dir), ["doc_id"])


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.clustered(table(spark, sf_dir, "embeddings"), ["vec_id"])
    written_out = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return found.withColumn("centroid_sha256", F.sha2(written_out, 256)).drop("centroid")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_substrings": op2_substrings,
    "op3_pii": op3_pii,
    "op4_packing": op4_packing,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_licenses": op7_licenses,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_arrow": op10_arrow,
    "op11_exactdups": op11_exactdups,
    "op12_centroids": op12_centroids,
    "op13_divergence": op13_divergence,
}
