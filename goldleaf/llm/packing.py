"""Sum-of-squares packing of tokenized documents into sequences of one length.

Every document becomes its ids and an end id. Longer ones are cut into full pieces, each a sequence of
its own, and a last piece. Last pieces are placed one by one, longest first: of all residual gaps that an
open sequence has, and of a new sequence, the place is taken after which the sum over gaps of
the squared count of open sequences with that gap is smallest; ties go to the smallest gap that fits. In the end
open sequences that fit together become one, the fullest first, each put where it leaves the least gap.

Documents are dealt by row number to groups of about `GROUP` rows, so that repeated rows are spread like others, and each
group is packed by one task from lengths alone. What a group wastes is about one sequence, of several thousand.

Defined results: a null or empty text is one piece holding the end id. Repeated rows are packed as
often as they stand there; a null doc_id is carried like any other. An empty table gives an empty
result. Extra columns are ignored unless they are asked for.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.llm.tokens import encoder, with_end
from goldleaf.llm.words import sliced

CAPACITY = 4096
END = 1
#: Rows packed together.
GROUP = 20_000
#: Bytes of text tokenized at a time.
SLICE = 4 << 20


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and place in it for every size between 1 and the capacity."""
    count = np.zeros(capacity + 1, dtype=np.int64)  # open sequences by gap; full ones are not open
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, places, made = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        have = count[s:capacity]
        # Change of the sum when a gap g is turned into g - s.
        change = np.where(have > 0, 2 * (count[: capacity - s] - have) + 2, 1 << 40)
        if len(change) and have[0]:
            change[0] -= 1
        fresh = 2 * count[capacity - s] + 1 if s < capacity else 0
        k = int(change.argmin()) if len(change) else 0
        if len(change) and change[k] <= fresh:
            gap = s + k
            at = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, at, made = capacity, made, made + 1
        bins[i], places[i] = at, capacity - gap
        if gap > s:
            open_at[gap - s].append(at)
            count[gap - s] += 1
    return bins, places


def joined(bins: np.ndarray, places: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with sequences that fit together made one; sequences are numbered anew, without gaps."""
    loads = np.bincount(bins, weights=sizes).astype(np.int64)
    gaps: list[tuple[int, int]] = []  # of the joined sequences, in order
    whole, base, made = np.zeros_like(loads), np.zeros_like(loads), 0
    for b in np.argsort(-loads, kind="stable").tolist():
        load = int(loads[b])
        k = bisect_left(gaps, (load, -1))
        gap, at = gaps.pop(k) if k < len(gaps) else (capacity, made)
        made = max(made, at + 1)
        whole[b], base[b] = at, capacity - gap
        if gap > load:
            insort(gaps, (gap - load, at))
    return whole[bins], places + base[bins]


def tokenized(
    docs: DataFrame, carry: list[str], path: str, capacity: int = CAPACITY, end: int = END,
    word_ends: bool = True, with_ids: bool = False, text: str = "text",
) -> DataFrame:
    """Carried columns, `sizes` and `crcs` (one per piece), and with_ids: `ids` (a binary per piece)."""
    n = len(carry)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, word_ends)
        for batch in batches:
            for part, texts in sliced(batch, "_t", SLICE):
                ids, counts = with_end(*coder.encode(texts), end)
                sizes, crcs, kept = [], [], []
                raw, at = memoryview(ids.astype("<u4").tobytes()), 0
                for total in counts.tolist():
                    cuts = list(range(0, total, capacity))
                    own = [raw[4 * (at + c) : 4 * (at + min(c + capacity, total))] for c in cuts]
                    sizes.append([len(x) // 4 for x in own])
                    crcs.append([zlib.crc32(x) for x in own])
                    if with_ids:
                        kept.append([x.tobytes() for x in own])
                    at += total
                columns = [pa.array(sizes, pa.list_(pa.int32())), pa.array(crcs, pa.list_(pa.int64()))]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.binary())))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(n)] + columns,
                    names=[f"_c{i}" for i in range(n)] + ["sizes", "crcs", "ids"][: 2 + with_ids],
                )

    kept = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], F.col(text).alias("_t"))
    schema = kept.drop("_t").schema.add("sizes", T.ArrayType(T.IntegerType())).add("crcs", T.ArrayType(T.LongType()))
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.BinaryType()))
    return kept.mapInArrow(work, schema).withColumnsRenamed({f"_c{i}": c for i, c in enumerate(carry)})


def placed(tokens: DataFrame, rows: int, capacity: int = CAPACITY) -> DataFrame:
    """`tokenized` rows with `sequences` and `offsets`, one of each per piece."""
    groups = max(1, -(-rows // GROUP))
    dealt = tokens.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def work(table: pa.Table) -> pa.Table:
        group = table.column("_group")[0].as_py()
        sizes = table.column("sizes").combine_chunks()
        flat = sizes.flatten().to_numpy().astype(np.int64)
        ends = np.cumsum(sizes.value_lengths().to_numpy())
        last = np.zeros(len(flat), dtype=bool)
        last[ends - 1] = True
        bins, places = joined(*sum_of_squares(flat[last], capacity), flat[last], capacity)
        at, offset = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
        at[last], offset[last] = bins, places
        # Full pieces stand alone, numbered after the packed ones.
        start = int(bins.max()) + 1 if len(bins) else 0
        at[~last] = start + np.arange(np.count_nonzero(~last))
        bounds = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        return table.append_column(
            "sequences", pa.ListArray.from_arrays(bounds, pa.array(at + (group << 36)))
        ).append_column("offsets", pa.ListArray.from_arrays(bounds, pa.array(offset)))

    longs = T.ArrayType(T.LongType())
    schema = T.StructType([*dealt.schema.fields, T.StructField("sequences", longs), T.StructField("offsets", longs)])
    return dealt.groupBy("_group").applyInArrow(work, schema).drop("_group")


def packed(
    docs: DataFrame, carry: list[str], path: str, capacity: int = CAPACITY, end: int = END,
    word_ends: bool = True, with_ids: bool = False, text: str = "text",
) -> DataFrame:
    """A row per piece: carried columns, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    tokens = tokenized(docs, carry, path, capacity, end, word_ends, with_ids, text)
    rows = placed(tokens, docs.count(), capacity)
    parts = ["sizes", "crcs", "sequences", "offsets"] + ["ids"] * with_ids
    each = rows.select(*carry, F.posexplode(F.arrays_zip(*parts)).alias("piece", "_p"))
    return each.select(
        *carry,
        "piece",
        (F.col("piece").cast("long") * capacity).alias("start"),
        F.col("_p.sizes").cast("long").alias("length"),
        F.col("_p.crcs").alias("ids_crc32"),
        F.col("_p.sequences").alias("sequence_id"),
        F.col("_p.offsets").alias("offset"),
        *([F.col("_p.ids").alias("ids")] if with_ids else []),
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """The ids of every sequence in one binary (little-endian, 32 bits each), from pieces with ids."""
    held = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    whole = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x.ids))
    return held.select("sequence_id", whole.alias("ids"))
