"""Exact duplicates by a stream with keyed state that never expires.

Texts are equal if they are identical once every run of white space is one space. A `Deduplicator`
owns a folder. `add` appends the normalised contents of some documents to a table there, and a stream
over that table's new files keeps, per digest of the content, how many rows have it, the smallest doc_id, and the
locator of its content: the file and the row in it. The state lives on disk in RocksDB, is backed up in the folder
and has no watermark, so nothing is ever forgotten; documents added later, or by another session, meet all earlier ones.

A digest that came twice is only a hit. The contents of all hits are fetched by their locators and compared as a
whole: a group's smallest and largest content are the same bytes if and only if all of them are, and
both are found by an aggregate that is combined before its shuffle, however many copies there are. Digests under which
contents differ are told apart by the contents themselves, so results never rest on a digest.

Digests of more than one row in a thousand (fewer than a thousand, therefore) are joined by broadcast, so no task
gets the rows of a very large group.

Defined results: a null text is an empty one, and empty texts are equal to each other. Of equal texts the row with the
smallest doc_id stays; null ids come last, and of repeated ids, or none but null ones, one row stays. Repeated rows are
rows. An empty table gives an empty result. Extra columns, whatever their names, are not touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.skew import join_counted
from goldleaf.session import STATE_ON_DISK, scratch, settings, written

#: Contents read by one micro-batch.
TRIGGER_BYTES = 64 << 30


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def _place() -> list[Column]:
    """Locator of a row's content: its file and its number there."""
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]


def _least() -> Column:
    """What tells which of some rows stays."""
    return F.struct(F.col("_id").isNull().alias("unnamed"), F.col("_id").alias("id"), "file", "at")


class Deduplicator:
    """Documents added so far, and which of them stay."""

    def __init__(self, spark: SparkSession, folder: str, digest: Callable[[Column], Column] = sha256) -> None:
        self.spark = spark
        self.contents, self.memory = f"{folder}/contents", f"{folder}/state"
        self.digest = digest
        self.schema = None

    def add(self, docs: DataFrame, carry: list[str] = (), doc_id: str = "doc_id", text: str = "text") -> None:
        """Append documents and bring the state up to date. The carried columns come back with the results."""
        rows = docs.select(
            *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
            F.col(doc_id).alias("_id"), normalised(F.col(text)).alias("content"),
        ).withColumn("digest", self.digest(F.col("content")))
        self.carry, self.schema = list(carry), rows.schema
        rows.write.mode("append").parquet(self.contents)
        with settings(self.spark, STATE_ON_DISK):
            self._stream().awaitTermination()

    def _stream(self):
        """Everything not seen yet goes through the state; a run that died is taken up where it was."""
        fresh = self.spark.readStream.schema(self.schema).option("maxBytesPerTrigger", TRIGGER_BYTES).parquet(self.contents)
        seen = fresh.select("digest", "_id", *_place()).groupBy("digest").agg(
            F.count("*").alias("n"), F.min(_least()).alias("least")
        )
        return (
            seen.writeStream.outputMode("update").format("noop")
            .option("checkpointLocation", self.memory).trigger(availableNow=True).start()
        )

    def state(self) -> DataFrame:
        """Digest, number of rows, and the row that stays: identifier and locator."""
        held = self.spark.read.format("statestore").load(self.memory)
        return held.select("key.digest", F.col("value.count").alias("n"), F.col("value.min").alias("least"))

    def _contents(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.contents)

    def _unlike(self, state: DataFrame, rows: DataFrame) -> DataFrame:
        """Digests of several rows whose contents are not the same bytes."""
        hits = join_counted(rows, state.where(F.col("n") > 1), "digest", "n").select(F.col("file").alias("_f"), F.col("at").alias("_a"))
        # Locators are unique, so fetching contents by them has no large keys.
        found = self._contents().select("digest", "content", *_place())
        found = found.join(hits, (F.col("file") == F.col("_f")) & (F.col("at") == F.col("_a")), "left_semi")
        ends = found.groupBy("digest").agg(F.min("content").alias("lo"), F.max("content").alias("hi"))
        return ends.where(F.col("lo") != F.col("hi")).select("digest")

    def results(self) -> DataFrame:
        """Every row added: carried columns, `keep_id`, `group_size`, `kept`, `text_sha256`."""
        with settings(self.spark, STATE_ON_DISK):
            state = written(self.state(), "exact-state")
        rows = self._contents().select(*[f"_c{i}" for i in range(len(self.carry))], "_id", "digest", *_place())
        unlike = written(self._unlike(state, rows), "exact-unlike")
        alike = state if unlike.isEmpty() else state.join(unlike, "digest", "left_anti")
        out = self._told(join_counted(rows, alike, "digest", "n"), sha256(F.col("content")) if self.digest is not sha256 else None)
        if not unlike.isEmpty():
            # The contents themselves as keys, for the few digests that lie.
            apart = self._contents().select("*", *_place()).join(unlike, "digest", "left_semi")
            groups = apart.groupBy("content").agg(F.count("*").alias("n"), F.min(_least()).alias("least"))
            out = out.unionByName(self._told(apart.join(groups, "content"), sha256(F.col("content"))))
        return out

    def _told(self, rows: DataFrame, sha: Column | None) -> DataFrame:
        if sha is not None and "content" not in rows.columns:
            texts = self._contents().select("content", *[c.alias(f"_{n}") for c, n in zip(_place(), ("f", "a"))])
            rows = rows.join(texts, (F.col("file") == F.col("_f")) & (F.col("at") == F.col("_a")))
        kept = (F.col("file") == F.col("least.file")) & (F.col("at") == F.col("least.at"))
        return rows.select(
            *[F.col(f"_c{i}").alias(c) for i, c in enumerate(self.carry)], F.col("least.id").alias("keep_id"),
            F.col("n").alias("group_size"), kept.alias("kept"),
            (F.col("digest") if sha is None else sha).alias("text_sha256"),
        )


def judged(docs: DataFrame, carry: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`results` of one table, deduplicated in a folder of its own."""
    found = Deduplicator(docs.sparkSession, scratch(docs.sparkSession, "exact"))
    found.add(docs, carry, doc_id, text)
    return found.results()
