"""A Bloom filter over the output's keys, which spares most pending keys the join.

The filter is a table of blocks, bitmaps of 32,768 bits. A key belongs to one block and sets a few bits of it, so a key is
tested by an equi-join on its block, however large the filter is: a filter for a billion keys at one per cent is a few
gigabytes in some hundred thousand rows that no task holds together, and a small one is broadcast by adaptive execution. Filters of
several batches are united block by block, so it grows with the output without reading old keys again.

A key whose bits are not all set is surely not in the output, so it is pending without any join. The others, the
stored ones and a share of about `error`, are joined as ever.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.functions.text import non_blank
from goldleaf.operators.pending import not_in
from goldleaf.plans.agents import EnrichSpec

BLOCK_BITS = 1 << 15
#: Blocks fill unevenly; so much more room keeps the error near the one asked for.
ROOM = 1.15


@dataclass(frozen=True)
class KeyFilter:
    """Size of a filter for about `keys` keys, of which absent ones pass with a chance of about `error`.

    With more keys than it was made for it stays right, and excludes less.
    """

    keys: int
    error: float = 0.01

    @property
    def blocks(self) -> int:
        bits = ROOM * max(self.keys, 1) * -math.log(self.error) / math.log(2) ** 2
        return max(1, math.ceil(bits / BLOCK_BITS))

    @property
    def hashes(self) -> int:
        return max(1, round(-math.log2(self.error)))

    def _block(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.blocks)).alias("block")

    def _bits(self, key: Column) -> list[Column]:
        """Two hashes make all of them."""
        one, step = F.xxhash64(F.lit(1), key), F.xxhash64(F.lit(2), key)
        spread = [F.pmod(F.pmod(one, F.lit(BLOCK_BITS)) + i * (2 * F.pmod(step, F.lit(BLOCK_BITS // 2)) + 1), F.lit(BLOCK_BITS)) for i in range(self.hashes)]
        return [b.cast("long") for b in spread]

    def build(self, ids: DataFrame) -> DataFrame:
        """`block` and `bitmap` of some keys: combined per task before the shuffle."""
        key = F.col(ids.columns[0]).cast("string")
        each = ids.where(key.isNotNull()).select(self._block(key), F.explode(F.array(*self._bits(key))).alias("bit"))
        return each.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))

    def united(self, *filters: DataFrame) -> DataFrame:
        """One filter of several of this size; a repeated one changes nothing."""
        return reduce(DataFrame.unionByName, filters).groupBy("block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))

    def marked(self, rows: DataFrame, bitmaps: DataFrame, id_col: str) -> DataFrame:
        """The rows with `maybe`: false where the key is surely not among those of the filter."""
        key = F.col(id_col).cast("string")

        def is_set(bit: Column) -> Column:
            byte = F.substring("_bitmap", (bit / 8).cast("int") + 1, F.lit(1))
            return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")) == 1

        blocks = bitmaps.select(F.col("block").alias("_block"), F.col("bitmap").alias("_bitmap"))
        every = reduce(and_, [is_set(b) for b in self._bits(key)])
        joined = rows.join(blocks, self._block(key) == F.col("_block"), "left")
        return joined.withColumn("maybe", F.coalesce(F.col("_bitmap").isNotNull() & every, F.lit(False))).drop("_block", "_bitmap")


def pending_filtered(
    silver: DataFrame, gold_ids: DataFrame, keys: KeyFilter, bitmaps: DataFrame, spec: EnrichSpec = EnrichSpec()
) -> DataFrame:
    """`pending`, with the join left to the keys that the filter cannot exclude.

    Only keys are tested and joined; the stored ones among them are then taken out of the input.
    """
    waiting = silver.where(non_blank(F.col(spec.text_col)))
    maybe = keys.marked(waiting.select(spec.id_col), bitmaps, spec.id_col).where("maybe").select(spec.id_col)
    stored = maybe.join(gold_ids.select(F.col(gold_ids.columns[0]).alias(spec.id_col)), spec.id_col, "left_semi")
    return not_in(waiting, stored, spec.id_col)


def joined_share(silver: DataFrame, keys: KeyFilter, bitmaps: DataFrame, spec: EnrichSpec = EnrichSpec()) -> DataFrame:
    """How many keys of the input there are, and how many the filter leaves to the join."""
    waiting = silver.where(non_blank(F.col(spec.text_col))).select(spec.id_col)
    return keys.marked(waiting, bitmaps, spec.id_col).agg(F.count("*").alias("keys"), F.count_if("maybe").alias("joined"))
