"""Passages that also stand in an earlier document, found level by level.

A passage is a window of `width` consecutive words of one document. The lengths double, and only
windows that were repeated at one length are extended to the next:

1. At about half the width (7 of 13 words) each document sends the hashes of a few of its windows:
   of any `width` words the one whose hash is smallest (winnowing). Equal passages send equal
   hashes, so a window of full width can only be repeated if the one chosen inside it is.
2. At the full width only windows around a repeated half are looked at. One is removed where
   a document with a smaller id has it too.
3. At 2, 4, 8, ... times the width, windows whose parts were all repeated are chained and asked
   whether they are repeated in one piece, all lengths in one range sort. This yields the longest
   repeated length of each document, and changes nothing in what is removed. Every repeated window
   also names one other place of it: where windows in a row name places in a row of one document, that
   run is repeated in one piece. Only what a document's repeated windows leave open beyond that is
   asked, with every start that is alive, so a repeated run is seen at each of these lengths that it has.

Equal hashes are brought together by a range sort over hash *and* document, in which neighbours tell
what is repeated. A passage that a third of all documents share is spread over as many tasks
as its rows need, and no task holds a group. Whole copies of a text are put aside first: all of their
windows begin in the copy with the smallest id. Texts are shuffled only if a bitmap of fixed size
says that their document may have a part in a step; without it the result would be the same.

Windows are compared by 64-bit hashes, at two lengths of which both have to agree.

Defined results: a null or empty text has no words, nothing is removed. Texts of fewer than
`width` words are kept as they are. Rows with a null doc_id have no place in the order: they keep
all words and remove nobody's. Rows that repeat a doc_id are one document each, and do not remove each
other's passages, as neither id is smaller. An empty table gives an empty result. Columns that are
not named are not touched, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.words import Texts, mixed, signed, sliced
from goldleaf.session import written

WIDTH = 13
#: Bits of the bitmap of ids that is broadcast: 4 MB.
MAP_BITS = 1 << 25
#: Columns of the windows that `_repeated` finds.
FOUND = ["h", "_d", "_x", "place", "later", "edge_low"]


def half(width: int) -> int:
    return (width + 1) // 2


def local_minima(keys: np.ndarray, doc: np.ndarray, span: int) -> np.ndarray:
    """For each run of `span` neighbours of one document, the place of the smallest key."""
    n = len(keys) - span + 1
    if n < 1:
        return np.zeros(0, dtype=np.int64)
    best = np.arange(n)
    for step in range(1, span):
        other = np.arange(step, step + n)
        best = np.where(keys[other] < keys[best], other, best)
    return np.where(doc[span - 1 :] == doc[:n], best, -1)


def _anchors(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts of full width, and for each the hash of the half-length window chosen in it."""
    k = half(width)
    begin = texts.windows(width)
    if not len(begin):
        return begin, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    hashes = texts.word_hashes()
    # Every start that a half window can have; those over a document's end are never chosen.
    every = np.arange(len(hashes) - k + 1)
    keys = texts.window_hashes(hashes, every, k)
    chosen = local_minima(keys, texts.doc[every], width - k + 1)
    # A full window at w holds the halves that begin at w .. w + width - k, all of one document.
    return begin, keys[chosen[begin]], hashes


def _heads(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Where another key or document begins: neighbouring windows mostly choose the same half."""
    return np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])]))


def _send_anchors(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in sliced(batch, "_t"):
                begin, keys, _ = _anchors(texts, width)
                if not len(begin):
                    continue
                doc = texts.doc[begin]
                heads = _heads(keys, doc)
                keys, doc = keys[heads], doc[heads]
                # Once per document is enough.
                _, first = np.unique(mixed(keys) ^ mixed(doc.astype(np.uint64)), return_index=True)
                ids = part.column(0).take(pa.array(doc[first]))
                yield pa.RecordBatch.from_arrays([pa.array(signed(keys[first])), ids], names=["anchor", "_d"])

    return work


def _alone(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column in a row, and the number of the row that each belongs to."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)


def _send_windows(width: int):
    """Windows of full width around a repeated half, a row each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(batch.schema.get_field_index("_a"))
            row = 0
            for part, texts in sliced(batch, "_t"):
                begin, keys, hashes = _anchors(texts, width)
                asked, owner = _alone(wanted.slice(row, part.num_rows))
                row += part.num_rows
                salt = mixed(np.arange(1, part.num_rows + 1, dtype=np.uint64))
                if not len(begin):
                    continue
                heads = _heads(keys, texts.doc[begin])
                hit = np.isin(keys[heads] ^ salt[texts.doc[begin[heads]]], asked.view(np.uint64) ^ salt[owner])
                begin = begin[np.repeat(hit, np.diff(np.append(heads, len(keys))))]
                if not len(begin):
                    continue
                doc = pa.array(texts.doc[begin])
                place = (begin - texts.word_at[texts.doc[begin]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(doc),
                        part.column(1).take(doc),
                        pa.array(place),
                        pa.array(signed(texts.window_hashes(hashes, begin, width))),
                    ],
                    names=["_d", "_x", "place", "h"],
                )

    return work


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by their first column, those that share it with a neighbour.

    The first and last row of the partition are let through, as their neighbours are elsewhere.
    """
    held: pa.RecordBatch | None = None
    first = True
    for batch in batches:
        if not batch.num_rows:
            continue
        now = batch if held is None else pa.concat_batches([held, batch])
        key = now.column(0).to_numpy(zero_copy_only=False)
        same = key[1:] == key[:-1]
        keep = np.concatenate([[first], same]) | np.concatenate([same, [False]])
        # The last row waits for its next neighbour, and is judged with the one before it.
        if held is not None:
            keep[0] |= seen
        seen, held, first = bool(keep[-1]), now.slice(len(key) - 1), False
        if keep[:-1].any():
            yield now.slice(0, len(key) - 1).filter(pa.array(keep[:-1]))
    if held is not None:
        yield held


def _repeated(linked: bool):
    """Of windows sorted by hash and document, those in more than one document.

    `later`: a document with a smaller id has it too. Rows of the hashes at either end of the
    partition come with `edge` instead, since they may go on in the next one. `linked` adds `beside`:
    another document that has the window and how far off it stands there, as one hash (0: none was seen).
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        least, first_hash = None, None

        def judged(rows: pa.RecordBatch, goes_on: bool, last: bool) -> pa.RecordBatch:
            nonlocal least, first_hash
            h, d, x, place = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if first_hash is None:
                first_hash = h[0]
            start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            sizes = np.diff(np.append(start, len(h)))
            # The first row of each hash: its id, text and place.
            low = [column[start].astype(np.int64) for column in (d, x, place)]
            if least is not None and least[0] == h[0]:
                for column, value in zip(low, least[1:]):
                    column[0] = value
            least = (h[-1], *(column[-1] for column in low))
            many = low[0] < np.maximum.reduceat(d, start)
            # Where a hash goes on, the documents to come are others than those judged now.
            many[-1] |= goes_on
            edge = h[start] == first_hash
            edge[-1] |= last
            lowest, edge = np.repeat(low[0], sizes), np.repeat(edge, sizes)
            columns = [*rows.columns, pa.array(lowest < d), pa.array(lowest, mask=~edge)]
            if linked:
                # The smallest document is beside the others; beside it is the next one.
                after = lowest < d
                next_row = np.minimum.reduceat(np.where(after, np.arange(len(h)), len(h)), start)
                none = np.repeat(next_row == len(h), sizes) & ~after
                other = np.repeat(np.minimum(next_row, len(h) - 1), sizes)
                beside = [np.where(after, np.repeat(one, sizes), all_[other]) for one, all_ in zip(low, (d, x, place))]
                columns.append(pa.array(signed(np.where(none, np.uint64(0), _beside(*beside[:2], beside[2] - place)))))
            return pa.RecordBatch.from_arrays(columns, names=[*FOUND, *["beside"] * linked]).filter(
                pa.array(np.repeat(many, sizes) | edge)
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            now = batch if held is None else pa.concat_batches([held, batch])
            h, d = (now.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            # Hold back the last document of the last hash, until it is known whether others follow.
            other = np.flatnonzero((h != h[-1]) | (d != d[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            held = now.slice(cut)
            if cut:
                yield judged(now.slice(0, cut), h[cut] == h[cut - 1], False)
        if held is not None:
            yield judged(held, False, True)

    return work


def _beside(d: np.ndarray, x: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A document and the distance of a window's place there from its own, as one hash other than 0."""
    value = np.zeros(len(d), dtype=np.uint64)
    for column in (d, x, off):
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.int64).view(np.uint64) + np.uint64(1))
    return value | np.uint64(1)


def _ahead(joint: np.ndarray) -> np.ndarray:
    """How many rows a run has from each row on, where `joint` says of all but the last if the next one belongs to it."""
    ends = np.flatnonzero(np.append(~joint, True))
    at = np.arange(len(joint) + 1)
    return ends[np.searchsorted(ends, at)] - at + 1


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def _documents(width: int):
    """Of windows sorted by document, a row per document: places to remove, the level up to which one other
    document is known to go along (`sure`), and the hashes of 2, 4, 8, ... windows in a row at every start, as far
    as all windows inside are repeated.

    The hashes lie in cells of neighbouring starts: the smallest window in the first 2 * width words and the level
    tell a cell, so equal passages lie in equal cells. `open`: the cells of the levels that are not sure.
    """

    def judged(rows: pa.RecordBatch) -> pa.RecordBatch:
        d, x, place, h, later, beside = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(6))
        order = np.lexsort((place, x, d))
        d, x, place = d[order], x[order], place[order]
        new = np.concatenate([[True], (d[1:] != d[:-1]) | (x[1:] != x[:-1])])
        # Rows that repeat an id and a text have the same windows.
        once = new | np.concatenate([[True], place[1:] != place[:-1]])
        order, d, x, place, new = order[once], d[once], x[once], place[once], new[once]
        value, later, beside = h[order].view(np.uint64), later[order], beside[order]
        doc, first = np.cumsum(new) - 1, np.flatnonzero(new)
        joint = ~new[1:] & (place[1:] == place[:-1] + 1)
        ahead = _ahead(joint)
        along = np.maximum.reduceat(_ahead(joint & (beside[1:] == beside[:-1]) & (beside[1:] != 0)), first)
        sure = np.frexp((along + width - 1) // width)[1] - 1
        smallest = value
        for step in _steps(width + 1):
            smallest = np.append(np.minimum(smallest[:-step], smallest[step:]), smallest[-step:])[: len(value)]
        starts, cells, values, levels = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        level = 0
        while len(start := np.flatnonzero(ahead > width * (2 ** (level + 1) - 1))):
            longer = np.zeros(len(value), dtype=np.uint64)
            longer[start] = mixed(value[start] + np.uint64(0x9E3779B97F4A7C15) * mixed(value[start + width * 2**level]))
            value, level = longer, level + 1
            # A text that repeats itself has equal windows.
            _, kept = np.unique(mixed(value[start]) ^ mixed(doc[start].astype(np.uint64)), return_index=True)
            start = start[np.sort(kept)]
            starts.append(start)
            cells.append(mixed(smallest[start] + np.uint64(level)))
            values.append(value[start])
            levels.append(np.full(len(start), level, dtype=np.int32))
        owner = doc[np.concatenate(starts)]
        order = np.argsort(owner, kind="stable")
        owner, cell, flat, level_of = owner[order], *(np.concatenate(c)[order] for c in (cells, values, levels))
        begin = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (owner[1:] != owner[:-1])])[: len(cell)])
        held = _lists(np.diff(np.append(begin, len(cell))), pa.array(signed(flat)))
        owner, cell, level_of = owner[begin], pa.array(signed(cell[begin])), level_of[begin]
        asks = level_of > sure[owner]
        n = len(first)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(d[first]),
                pa.array(x[first]),
                _lists(np.bincount(doc[later], minlength=n), pa.array(place[later])),
                pa.array(sure.astype(np.int32)),
                _lists(np.bincount(owner[asks], minlength=n), cell.filter(pa.array(asks))),
                _lists(
                    np.bincount(owner, minlength=n),
                    pa.StructArray.from_arrays([cell, pa.array(level_of), held], names=["cell", "level", "h"]),
                ),
            ],
            names=["_d", "_x", "places", "sure", "open", "cells"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last document waits for the rows to come.
            d = batch.column(0).to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(d, d[-1]))
            if held and (cut or held[0].column(0)[0].as_py() != d[0]):
                yield judged(pa.concat_batches([*held, batch.slice(0, cut)]))
                held = []
            elif cut:
                yield judged(batch.slice(0, cut))
            held.append(batch.slice(cut))
        if held:
            yield judged(pa.concat_batches(held))

    return work


def _steps(span: int) -> list[int]:
    """Distances at which values are compared one after the other to have the smallest of `span` neighbours."""
    steps, have = [], 1
    while have < span:
        steps.append(min(have, span - have))
        have += steps[-1]
    return steps


def _cut(width: int, carry: int, text_only: bool):
    """Words removed from every text, and what is left of it. `text_only`: nothing is removed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for part, texts in sliced(batch, "_t"):
                gone = np.zeros(len(texts.start), dtype=bool)
                if not text_only:
                    begin, owner = _alone(batch.column(carry + 1).slice(row, part.num_rows))
                    whole = part.column(carry + 2).to_numpy(zero_copy_only=False).astype(bool)
                    if len(gone):
                        gone = texts.covered(begin + texts.word_at[owner], width)
                        gone |= (whole & (texts.counts() >= width))[texts.doc]
                row += part.num_rows
                removed = np.bincount(texts.doc[gone], minlength=texts.n)
                left = []
                for i in range(texts.n):
                    words = texts.words(i)
                    if removed[i]:
                        flags = gone[texts.word_at[i] : texts.word_at[i + 1]].tolist()
                        words = [w for w, out in zip(words, flags) if not out]
                    left.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(carry)]
                    + [
                        pa.array(texts.counts()),
                        pa.array(removed.astype(np.int64)),
                        pa.array([hashlib.sha256(x).hexdigest() for x in left]),
                        pa.array(left, pa.binary()).cast(pa.string()),
                    ],
                    names=[f"_c{i}" for i in range(carry)] + ["n_words", "n_removed", "kept_sha256", "kept_text"],
                )

    return work


def _bitmap(ids: DataFrame) -> DataFrame:
    """Bits of the ids of column `_d`, in at most MAP_BITS / 32,768 rows of 4 KB."""
    bit = F.pmod(F.xxhash64("_d"), F.lit(MAP_BITS))
    return ids.groupBy(F.bitmap_bucket_number(bit).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bits")
    )


def split(docs: DataFrame, ids: DataFrame, key: str = "_d") -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among the ids (column `_d`), and rows whose key is not.

    The bitmap has a fixed size whatever the number of ids, so it may be broadcast; with very many
    ids it is full, and every row takes the long way.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(MAP_BITS))
    at = F.bitmap_bit_position(bit)
    marked = docs.withColumn("_bucket", F.bitmap_bucket_number(bit)).join(
        F.broadcast(written(_bitmap(ids), "bitmap")), "_bucket", "left"
    )
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.expr("shiftright(_byte, cast(_bit % 8 as int)) & 1") == 1, F.lit(False))
    flagged = marked.withColumns({"_byte": byte, "_bit": at}).withColumn("_held", held)
    plain = docs.columns
    return flagged.where("_held").select(*plain), flagged.where(~F.col("_held")).select(*plain)


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Windows of `_d`, `_x`, `_t` rows that stand in several documents: place, hash, and whether
    an earlier document has it (`later`)."""
    # Range sorts sample their input first, so what comes from texts is written before.
    sent = written(docs.select("_d", "_t").mapInArrow(_send_anchors(width), "anchor long, _d long"), "sent")
    beside = sent.repartitionByRange("anchor", "_d").sortWithinPartitions("anchor")
    asked = written(
        beside.mapInArrow(_neighbours, "anchor long, _d long").groupBy("_d").agg(F.collect_set("anchor").alias("_a")),
        "anchors",
    )
    maybe, _ = split(docs, asked)
    texts = maybe.join(asked.withColumnRenamed("_d", "_e"), F.col("_d") == F.col("_e")).select("_d", "_x", "_t", "_a")
    windows = written(texts.mapInArrow(_send_windows(width), "_d long, _x int, place int, h long"), "starts")
    return _shared(windows, "windows", linked=True)


def _shared(windows: DataFrame, name: str, linked: bool = False) -> DataFrame:
    """Of rows with `h`, `_d`, `_x` and `place`, those whose hash stands in several documents, and `later`."""
    more = ["beside"] * linked
    found = written(
        windows.select("h", "_d", "_x", "place")
        .repartitionByRange("h", "_d", "place")
        .sortWithinPartitions("h", "_d", "place")
        .mapInArrow(
            _repeated(linked),
            ", ".join(["h long, _d long, _x int, place int, later boolean, edge_low long", *(f"{c} long" for c in more)]),
        ),
        name,
    )
    # Two hashes per partition at most: what the ends of the partitions have in common.
    ends = found.where(F.col("edge_low").isNotNull()).groupBy("h").agg(F.min("edge_low").alias("lo"), F.max("_d").alias("hi"))
    edge = F.col("edge_low").isNotNull()
    return (
        found.join(F.broadcast(ends), "h", "left")
        .where(~edge | (F.col("lo") < F.col("hi")))
        .select("_d", "_x", "place", "h", F.when(edge, F.col("lo") < F.col("_d")).otherwise(F.col("later")).alias("later"), *more)
    )


def repeated_passages(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Documents (`_d`, `_x`, `_t` rows) with a repeated window: `places` (word numbers) of the windows to
    remove, and `longest`, the greatest length of the levels at which a window of it was repeated."""
    rows = repeated_windows(docs, width).repartition("_d").sortWithinPartitions("_d")
    hits = written(
        rows.mapInArrow(
            _documents(width),
            "_d long, _x int, places array<int>, sure int, open array<bigint>, "
            "cells array<struct<cell: bigint, level: int, h: array<bigint>>>",
        ),
        "passages",
    )
    # Doubling, all levels in one range sort: what is repeated at a length is so at the shorter ones, so a
    # document's greatest level is that of its longest shared window. Only cells that a document has open
    # can tell more than what is sure.
    asked = hits.select(F.explode("open").alias("_d"))
    cells, _ = split(hits.select("_d", "_x", F.inline("cells")), asked, "cell")
    each = cells.select("_d", "_x", F.col("level").alias("place"), F.explode("h").alias("h"))
    reached = _shared(each, "levels").groupBy("_d", "_x").agg(F.max("place").alias("level"))
    longest = (width * F.pow(F.lit(2), F.greatest("sure", "level"))).cast("int")
    return hits.join(reached, ["_d", "_x"], "left").select("_d", "_x", "places", longest.alias("longest"))


def without_repeats(
    docs: DataFrame, carry: list[str], doc_id: str = "doc_id", text: str = "text", width: int = WIDTH
) -> DataFrame:
    """Carried columns and n_words, n_removed, kept_sha256, kept_text and longest (words) of every document."""
    n = len(carry)
    named = [F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)]
    # _x tells rows of one id apart by their texts.
    base = docs.select(
        *named, F.col(doc_id).cast("long").alias("_d"), F.hash(text).alias("_x"), F.col(text).alias("_t")
    )
    with_id = base.where(F.col("_d").isNotNull() & F.col("_t").isNotNull())
    # Two 64-bit hashes and the length name a text; of equal texts the smallest id stands for all.
    same = [F.xxhash64("_t").alias("_k"), F.xxhash64(F.lit(1), "_t").alias("_l"), F.octet_length("_t").alias("_m")]
    keys = with_id.select("_d", "_x", *same)
    first = keys.groupBy("_k", "_l", "_m").agg(F.min("_d").alias("_first"), F.max("_d").alias("_last"))
    copied = first.where(F.col("_first") < F.col("_last")).drop("_last")
    copies = written(
        keys.join(copied, ["_k", "_l", "_m"]).where(F.col("_d") > F.col("_first")).select("_d", "_x").distinct(), "copies"
    )
    rows = with_id.select("_d", "_x", "_t")
    maybe, single = split(rows, copies)
    own = single.union(maybe.join(copies, ["_d", "_x"], "left_anti").select("_d", "_x", "_t"))
    found = repeated_passages(own, width).select("_d", "_x", "places", F.lit(False).alias("_copy"), "longest")
    marks = written(
        found.where((F.size("places") > 0) | (F.col("longest") > 0)).union(
            copies.select("_d", "_x", F.array().cast("array<int>"), F.lit(True), F.lit(None).cast("int"))
        ),
        "marks",
    ).withColumnsRenamed({"_d": "_e", "_x": "_y"})
    listed, free = split(base, marks.select(F.col("_e").alias("_d")))
    joined = listed.join(marks, (F.col("_d") == F.col("_e")) & (F.col("_x") == F.col("_y")), "left")
    ids = [f"_c{i}" for i in range(n)]
    joined = joined.select(*ids, "longest", "_t", "places", F.coalesce("_copy", F.lit(False)).alias("_copy")).select(
        *ids, F.col("longest").alias(f"_c{n}"), "_t", "places", "_copy"
    )
    free = free.select(*ids, F.lit(None).cast("int").alias(f"_c{n}"), "_t")
    schema = free.drop("_t").schema
    for name, kind in (("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string"), ("kept_text", "string")):
        schema = schema.add(name, kind)
    done = joined.mapInArrow(_cut(width, n + 1, False), schema).union(free.mapInArrow(_cut(width, n + 1, True), schema))
    longest = F.coalesce(F.col(f"_c{n}"), F.when(F.col("n_removed") > 0, F.col("n_words")).otherwise(0)).cast("long")
    return done.withColumn(f"_c{n}", longest).withColumnsRenamed(
        {f"_c{i}": c for i, c in enumerate(carry)} | {f"_c{n}": "longest"}
    )
