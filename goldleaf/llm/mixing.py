"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue that is served in proportion to its weight. Its documents are shuffled by
a hash; a document's virtual finish time is the tokens of its source up to and with it, divided by
the source's weight. All documents are range-sorted by finish time and taken until the budget is spent.
A queue that is read to its end starts anew in another order, `EPOCHS` times at most; once it is
empty the others share what it leaves, which is what the fair queue does by itself. In the round in
which a source meets its target, documents of more than 1 / `COARSE` of what it still lacks go to the
end of its queue, shorter ones first, where they cannot make it miss the target by much.

The budget is the size of all documents, a document's size is its number of words. Running sums,
both within the sources and over all, come from range-partitioned slices with a carry per slice, so that
a source with a third of all documents is spread like any other.

Defined results: a null or empty text has size 0 and takes part with taken 0. Sources are ordered by
code point, null last, and weigh 1, 2, 3, repeating. Repeated rows are documents of their own,
next to each other in the queue. An empty table gives an empty
result, and of a table without any word nothing is taken. Extra columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.operators.running import row_numbers, running_totals
from goldleaf.session import written

EPOCHS = 3
WEIGHTS = 3
COARSE = 50
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(rows: DataFrame) -> DataFrame:
    """source, source_size, weight and target of every source, from rows with source and size.

    A target is the source's share of the budget by weight, EPOCHS times its size at most; what it
    cannot use is shared by the others. Sources reach their limit in the order of limit per
    weight, so running totals over that order tell the level at which everything is shared out.
    """
    # Summed per source before the shuffle.
    each = rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_last", F.col("source").isNull())
    placed = row_numbers(each, ["_last", "source"], "_nth").withColumn("weight", (F.col("_nth") % WEIGHTS + 1).cast("long"))
    limit = (F.col("source_size") * EPOCHS).alias("_limit")
    ordered = placed.withColumns({"_limit": limit, "_level": limit / F.col("weight"), "_all": F.lit(0)})
    summed = written(
        running_totals(ordered, ["_all"], ["_level", "_nth"], {"_used": "_limit", "_weights": "weight"}), "sources"
    )
    budget = summed.select(F.sum("source_size")).scalar()
    heavy = summed.select(F.sum("weight")).scalar()
    # The level if all before this source are at their limit and the others share what is left.
    level = (budget - F.col("_used") + F.col("_limit")) / (heavy - F.col("_weights") + F.col("weight"))
    levels = summed.select(level.alias("level"), "_level")
    top = levels.where(F.col("level") <= F.col("_level")).select(F.max("level")).scalar()
    target = F.least(F.col("_limit").cast("double"), F.col("weight") * F.coalesce(top, F.lit(0.0)))
    return summed.select("source", "source_size", "weight", target.alias("target"))


def queued(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """A row per document and epoch with its virtual finish time `_finish`."""
    by_source = sources.select(F.col("source").alias("_s"), "source_size", "weight", "target")
    same = F.col("source").eqNullSafe(F.col("_s"))
    rounds = F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))).alias("_epoch")
    epochs = rows.where("size > 0").select("_row", "_id", "_x", "source", "size", rounds).join(by_source, same)
    lacking = F.col("target") - F.col("_epoch") * F.col("source_size")
    late = (lacking > 0) & (lacking < F.col("source_size")) & (F.col("size") * COARSE > lacking)
    shuffled = F.md5(F.concat(F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit(":"), F.col("_epoch").cast("string")))
    keyed = epochs.select(
        "_row", "_id", "_x", "size", "weight", "_epoch", F.when(late, F.col("size")).otherwise(0).alias("_late"), shuffled.alias("_key"),
        F.coalesce("source", F.lit("")).alias("_slot"), F.col("source").isNull().alias("_null"),
    )
    order = ["_epoch", "_late", "_key", "_x", "_row"]
    return running_totals(keyed, ["_slot", "_null"], order, {"_upto": "size"}).withColumn(
        "_finish", F.col("_upto") / F.col("weight")
    )


def mixed(docs: DataFrame, carry: list[str], doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Carried columns of every document, size, source_size, target, copies (times it is taken) and taken."""
    n = len(carry)
    rows = written(
        docs.select(
            *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
            F.col(doc_id).alias("_id"), F.col(source).alias("source"), words(text).alias("size"),
            F.xxhash64(text).alias("_x"), F.monotonically_increasing_id().alias("_row"),
        ),
        "sizes",
    )
    sources = written(targets(rows), "targets")
    line = queued(rows, sources).withColumn("_all", F.lit(0))
    order = ["_finish", "_null", "_slot", "_epoch", "_late", "_key", "_x", "_row"]
    spent = running_totals(line, ["_all"], order, {"_spent": "size"})
    budget = rows.select(F.sum("size")).scalar()
    # Taken until the budget is spent; the last one if half of it fits.
    within = spent.where(2 * F.col("_spent") - F.col("size") <= 2 * budget)
    counts = within.groupBy("_row").agg(F.count("*").alias("_n")).withColumnRenamed("_row", "_r")
    by_source = sources.select(F.col("source").alias("_s"), "source_size", "target")
    copies = F.coalesce("_n", F.lit(0))
    return (
        rows.join(counts, F.col("_row") == F.col("_r"), "left")
        .join(by_source, F.col("source").eqNullSafe(F.col("_s")))
        .select(
            *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
            "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"),
        )
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: every document with all its columns, as often as it is taken.

    The mix is made of narrow rows that know a document by its id and a hash of all its columns. The
    documents are then shuffled once; rows that are equal throughout are one row with the sum of
    their copies, which is the same.
    """
    keys = [F.col(doc_id).alias("_i"), F.xxhash64(*docs.columns).alias("_h"), F.xxhash64(F.lit(1), *docs.columns).alias("_g")]
    narrow = docs.select(*keys, F.col(source).alias("_o"), F.col(text).alias("_t"))
    found = mixed(narrow, ["_i", "_h", "_g"], "_i", "_o", "_t")
    counts = found.groupBy("_h", "_g").agg(F.sum("copies").alias("_copies")).where("_copies > 0")
    whole = docs.select(*keys[1:], F.struct(*docs.columns).alias("_whole"))
    single = whole.groupBy("_h", "_g").agg(F.any_value("_whole").alias("_whole"))
    taken = single.join(counts, ["_h", "_g"])
    return taken.select("_whole", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_whole.*")
