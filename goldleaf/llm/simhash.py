"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits. If two differ in 3 bits or fewer, one of their halves differs in one
bit at most. The first 31 bits of a half are covered by the words of a Hamming code: each
31-bit string lies within radius 1 of exactly one code word, its home anchor. Whoever is within
the threshold 1 of it lies within radius 1 + 1 = 2 of that anchor, so every fingerprint is
replicated to the (at most 16) anchors within distance 2 of each half, and compared at an
anchor with the fingerprints that are at home there. No pair is missed, whatever the data.

An anchor that more than `CROWD` replicas meet at is dealt to blocks of about so many, and every block's homes are compared
with every block in a group of its own, so no task holds more than two blocks of an anchor.

Links are found between distinct fingerprints, with copies standing behind theirs. An anchor
reports a spanning forest of its links, never all pairs, which leaves the components as they are.

Defined results: a null or empty text has fingerprint zero and is linked like any other; a text
of one or two words is hashed as a whole. Repeated rows are kept as rows. A null doc_id never
names a component unless nothing else does. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.components import components
from goldleaf.llm.skew import join_counted
from goldleaf.llm.words import Texts, sliced
from goldleaf.session import written

BITS = 64
SHINGLE = 3
SEED = 42
DISTANCE = 3
CODE_BITS = 31
#: Fingerprints compared with each other at a time inside one anchor.
BLOCK = 1 << 18
#: Replicas of one anchor that are held together.
CROWD = 1 << 14


def text_fingerprint(words: list[bytes], width: int = SHINGLE) -> int:
    """Majority bits of the hashes of all word shingles; zero without words."""
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    k = min(width, len(words))
    begins = np.concatenate([[0], ends[: len(words) - k]]).tolist()
    stops = (ends[k - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins, stops)], dtype="<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def slice_fingerprints(texts: Texts) -> np.ndarray:
    out = np.zeros(texts.n, dtype=np.uint64)
    for i in range(texts.n):
        out[i] = text_fingerprint(texts.data[texts.at[i] : texts.at[i + 1]].tobytes().lower().split())
    return out


def fingerprints(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """The carried columns of every document and its fingerprint `fp` (the 64 bits as a long)."""
    kept = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], F.col(text).alias("_text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in sliced(batch, "_text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(carry))] + [pa.array(slice_fingerprints(texts).view(np.int64))],
                    names=[f"_c{i}" for i in range(len(carry))] + ["fp"],
                )

    schema = kept.drop("_text").schema.add("fp", "long")
    return kept.mapInArrow(work, schema).withColumnsRenamed({f"_c{i}": c for i, c in enumerate(carry)})


def _syndromes(bits: np.ndarray) -> np.ndarray:
    """Exclusive or of the positions (from 1) of the set bits: 0 for a code word."""
    out = np.zeros(len(bits), dtype=np.int64)
    for i in range(CODE_BITS):
        out ^= ((bits >> i) & 1) * (i + 1)
    return out


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, number of the fingerprint, and whether it is at home there, for every replica.

    Positions a and b of two flips that lead to a code word satisfy a ^ b = syndrome.
    """
    keys, rows, homes = [], [], []
    for half in (0, 1):
        bits = ((fps >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)).astype(np.int64)
        low = _syndromes(bits)
        tag = half << 40

        def put(at: np.ndarray, words: np.ndarray, home: bool, tag: int = tag) -> None:
            keys.append(words | tag)
            rows.append(at)
            homes.append(np.full(len(at), home))

        every = np.arange(len(fps))
        flip = np.where(low > 0, np.int64(1) << np.maximum(low - 1, 0), 0)
        put(every, bits ^ flip, True)
        for a in range(1, CODE_BITS + 1):
            b = low ^ a
            # Each pair once; b = 0 is the single flip, which is the home anchor already.
            at = np.flatnonzero((low > 0) & (b > a))
            put(at, bits[at] ^ (np.int64(1) << (a - 1)) ^ (np.int64(1) << (b[at] - 1)), False)
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(homes)


def spanning(fps: np.ndarray, home: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """A spanning forest of the links between those at home and all, as pairs of numbers.

    Blocks of those at home are compared with all in one go; memory stays at BLOCK times a few
    bytes, and a link is reported only if it joins two trees.
    """
    label = np.arange(len(fps))
    out: list[tuple[int, int]] = []
    own = np.flatnonzero(home)
    step = max(1, BLOCK // len(fps))
    for begin in range(0, len(own), step):
        some = own[begin : begin + step]
        near = np.bitwise_count(fps[some][:, None] ^ fps[None, :]) <= distance
        for i, row in zip(some, near):
            reached = np.flatnonzero(row)
            labels, first = np.unique(label[reached], return_index=True)
            if len(labels) > 1:
                mine = label[i]
                out += [(int(i), int(reached[f])) for f, x in zip(first, labels) if x != mine]
                label[np.isin(label, labels)] = mine
    return out


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of replicas that arrive sorted by group; one group may reach over batches."""
    rest: tuple[np.ndarray, ...] | None = None

    def found(key: np.ndarray, group: np.ndarray, fp: np.ndarray, home: np.ndarray) -> pa.RecordBatch | None:
        edges = np.flatnonzero((np.diff(key) != 0) | (np.diff(group) != 0)) + 1
        begin, end = np.concatenate([[0], edges]), np.append(edges, len(key))
        lone = np.add.reduceat(home.astype(np.int64), begin) == 0
        u, v = [], []
        for a, b in zip(begin[(end - begin > 1) & ~lone].tolist(), end[(end - begin > 1) & ~lone].tolist()):
            own = fp[a:b]
            for i, j in spanning(own.view(np.uint64), home[a:b]):
                u.append(int(own[i]))
                v.append(int(own[j]))
        if u:
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
        return None

    for batch in batches:
        now = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        if rest is not None:
            now = tuple(np.concatenate(x) for x in zip(rest, now))
        same = (now[0] == now[0][-1]) & (now[1] == now[1][-1]) if len(now[0]) else np.zeros(0, bool)
        cut = int(np.argmax(same)) if len(same) else 0
        rest = tuple(x[cut:] for x in now)
        if cut and (out := found(*(x[:cut] for x in now))) is not None:
            yield out
    if rest is not None and len(rest[0]) and (out := found(*rest)) is not None:
        yield out


def _grouped(dealt: DataFrame, crowd: int) -> DataFrame:
    """Replicas with the number of their `group` inside the anchor: 0, or every pair of blocks they are part of."""
    crowded = dealt.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > crowd)
    crowded = crowded.select("anchor", F.ceil(F.col("n") / crowd).cast("int").alias("blocks"))
    own, n = F.pmod(F.xxhash64("fp"), "blocks").cast("int"), F.col("blocks")
    every = F.sequence(F.lit(0), n - 1)
    # As one at home a replica meets every block, as any other it is met by every block's homes.
    meets = F.when(F.col("home"), F.transform(every, lambda b: F.struct((own * n + b).alias("group"), F.lit(True).alias("home"))))
    met = F.transform(F.filter(every, lambda b: ~F.col("home") | (b != own)), lambda b: F.struct((b * n + own).alias("group"), F.lit(False).alias("home")))
    alone = F.array(F.struct(F.lit(0).alias("group"), F.col("home").alias("home")))
    places = F.when(n.isNull(), alone).otherwise(F.concat(F.coalesce(meets, F.array().cast("array<struct<group:int,home:boolean>>")), met))
    return (
        dealt.join(crowded, "anchor", "left").select("anchor", "fp", F.explode(places).alias("x")).select("anchor", "x.group", "fp", "x.home")
    )


def links(classes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Pairs `u`, `v` of distinct fingerprints `fp` that span the links within DISTANCE bits."""

    def replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for a in range(0, len(fps), 50_000):
                some = fps[a : a + 50_000]
                key, row, home = anchors(some.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(some[row]), pa.array(home)], names=["anchor", "fp", "home"]
                )

    dealt = written(classes.select("fp").mapInArrow(replicas, "anchor long, fp long, home boolean"), "replicas")
    return (
        _grouped(dealt, crowd).repartition("anchor", "group").sortWithinPartitions("anchor", "group", "fp")
        .mapInArrow(_links, "u long, v long").distinct()
    )


def classified(docs: DataFrame, carry: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Carried columns, `fp` and `component_id` (smallest id reachable over links) of every document."""
    saved = written(fingerprints(docs, list(dict.fromkeys([*carry, doc_id])), text), "fingerprints")
    classes = written(saved.groupBy("fp").agg(F.min(doc_id).alias("least"), F.count("*").alias("_n")), "classes")
    roots = components(links(classes))
    # Only fingerprints with a link have a root; the others are components of their own.
    linked = classes.join(roots, classes.fp == roots.node).select("fp", "root", "least")
    named = linked.join(linked.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        F.col("fp").alias("_fp"), "component_id"
    )
    by_class = classes.join(named, F.col("fp") == F.col("_fp"), "left").select(
        "fp", "_n", F.coalesce("component_id", "least").alias("component_id")
    )
    # Copies of a text share a fingerprint, so a class may hold any share of the rows.
    return join_counted(saved, written(by_class, "fingerprint-classes"), "fp", "_n").drop("_n")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: the one with the smallest id, and of repeated ids one row.

    A component none of whose documents has an id keeps one of its rows all the same.
    """
    names = docs.columns
    # Two hashes over all columns name a row; rows that agree in both are repeats of each other.
    keyed = docs.select(
        F.struct(*names).alias("_row"), F.col(doc_id).alias("_id"), F.col(text).alias("_t"),
        F.xxhash64(*names).alias("_x"), F.xxhash64(F.lit(1), *names).alias("_y"),
    )
    ids = classified(keyed, ["_id", "_x", "_y"], "_id", "_t").select("_id", "_x", "_y", "component_id")
    least = ids.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_x", "_y")).alias("m"))
    chosen = least.select("m._x", "m._y")
    # The join and the reduction of repeats share one shuffle of the documents.
    hit = keyed.join(chosen, ["_x", "_y"], "left_semi")
    return hit.groupBy("_x", "_y").agg(F.any_value("_row").alias("_row")).select("_row.*")
