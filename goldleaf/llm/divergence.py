"""How far the sources of a language differ in their words, from bitmaps of terms by count.

Terms are counted per (language, source); a language keeps the terms that stand in enough of its documents and numbers
them. A group's counts are then stored the other way round: for every count that occurs, the set of the terms that
have it, as bits of 64 consecutive term numbers. For two groups, ANDing the sets of count a in one and count b in the other and
counting the bits gives the number of terms with that pair of counts, the joint cell, and all of these add the same
f(a, b). Terms that a group lacks are in none of its sets; cells with a zero are what the joint cells leave of a set,
and the cell of two zeros what they leave of the language's terms. With f0 the value of two zeros, this gives

    V f0 + sum_a |A_a| (f(a,0) - f0) + sum_b |B_b| (f(0,b) - f0) + sum_ab |A_a & B_b| (f(a,b) - f(a,0) - f(0,b) + f0)

so a pair of groups only has to meet where both have terms. Sets meet per language, run of term numbers and blocks
of sources: a group of rows is at most two blocks' sources times one run's terms, whatever a source or language holds.

All values are integers, probabilities in units of 1e-9, so sums depend on no order.

Defined results: a null text, language or source is an empty one. Repeated rows and repeated ids count row by row. A text
without terms still makes its group occur; with no kept term in the language (V = 0) every pair has value 0
and there is no term row. A language's only source has no pair. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.llm.words import Texts, text_bytes
from goldleaf.operators.running import row_numbers
from goldleaf.session import written

LEAST_DOCS = 30
SMOOTH = 5
UNIT = 1_000_000_000
TOP = 50
#: Term numbers that are compared together, as a power of two of 64-bit sets.
RUN_BITS = 6
#: Sources of one block.
SOURCES = 128
#: Text handled at once.
SLICE_BYTES = 8 << 20
#: Pairs of sets compared at a time.
PAIRS = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True

COUNTED = "lang string, source string, term string, n long, docs long"


def _terms(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms of some texts, and the number and the text of every occurrence."""
    data = _LOWER[data]
    solid = _LETTER[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int32)
    raw = pa.BinaryArray.from_buffers(
        pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[solid]))]
    ).dictionary_encode()
    doc = np.searchsorted(at, start, side="right") - 1
    return raw.dictionary.cast(pa.string()), raw.indices.to_numpy().astype(np.int64), doc


def _slice_counts(group: np.ndarray, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Group, term, occurrences and documents of every (group, term) in some texts."""
    words, number, doc = _terms(data, at)
    size = max(1, len(words))
    per_doc, times = np.unique(doc * size + number, return_counts=True)
    cells, which = np.unique(group[per_doc // size] * size + per_doc % size, return_inverse=True)
    n = np.bincount(which, weights=times, minlength=len(cells)).astype(np.int64)
    docs = np.bincount(which, minlength=len(cells)).astype(np.int64)
    return cells // size, words.take(pa.array(cells % size)), n, docs


def counted(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """Rows with the term null tell that a group occurs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], names=["lang", "source"])
            names = sorted({(p["lang"], p["source"]) for p in pairs.to_pylist()})
            place = {name: i for i, name in enumerate(names)}
            group = np.array([place[p["lang"], p["source"]] for p in pairs.to_pylist()], dtype=np.int64)
            langs, sources = (pa.array([name[i] for name in names], pa.string()) for i in (0, 1))
            size = np.bincount(group, minlength=len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [langs, sources, pa.nulls(len(names), pa.string()), pa.array(np.zeros(len(names), np.int64)), pa.array(size)],
                names=["lang", "source", "term", "n", "docs"],
            )
            data, at = text_bytes(batch.column(2))
            row = 0
            while row < batch.num_rows:
                upto = int(np.searchsorted(at, at[row] + SLICE_BYTES, side="right")) - 1
                upto = min(max(upto, row + 1), batch.num_rows)
                who, term, n, held = _slice_counts(group[row:upto], data[at[row] : at[upto]], at[row : upto + 1] - at[row])
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(who)), sources.take(pa.array(who)), term, pa.array(n), pa.array(held)],
                    names=["lang", "source", "term", "n", "docs"],
                )
                row = upto

    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    # Dealt by term, which the counts per group and the sums per language that follow can both use.
    parts = docs.select(*plain).mapInArrow(work, COUNTED).repartition("lang", "term")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + 5) / (total + 5 * terms)), exactly; 0 terms have no share."""
    top = F.lit(UNIT).cast("decimal(10,0)") * (n + SMOOTH).cast("decimal(20,0)")
    below = F.nullif((total + SMOOTH * terms).cast("decimal(20,0)"), F.lit(0))
    return F.coalesce(1 + F.call_function("div", top, below), F.lit(0).cast("long"))


def _meet(own: pa.Table) -> list[tuple[str, str, int]]:
    """Joint part of the value of every pair of sources whose sets stand in some rows."""
    own = own.sort_by([("word", "ascending"), ("source", "ascending")])
    names, code = np.unique(np.array(own.column("source").to_pylist(), dtype=object), return_inverse=True)
    word, bits, p, p0, block = (own.column(c).to_numpy() for c in ("word", "bits", "p", "p0", "block"))
    bits = bits.astype(np.int64).view(np.uint64)
    low, high = own.column("low")[0].as_py(), own.column("high")[0].as_py()
    total = np.zeros((len(names), len(names)), dtype=np.int64)
    edges = np.flatnonzero(np.diff(word)) + 1
    for begin, end in zip(np.concatenate([[0], edges]).tolist(), np.append(edges, len(word)).tolist()):
        s = slice(begin, end)
        inside = np.flatnonzero(np.diff(code[s], prepend=-1))
        some = code[s][inside]
        step = max(1, PAIRS // (end - begin))
        rows = np.zeros((len(some), end - begin), dtype=np.int64)
        for a in range(begin, end, step):
            b = min(a + step, end)
            joint = np.bitwise_count(bits[a:b, None] & bits[None, s]).astype(np.int64)
            pa_, za, pb, zb = p[a:b, None], p0[a:b, None], p[None, s], p0[None, s]
            joint *= abs(pa_ - pb) - abs(pa_ - zb) - abs(za - pb) + abs(za - zb)
            np.add.at(rows, np.searchsorted(some, code[a:b]), joint)
        total[np.ix_(some, some)] += np.add.reduceat(rows, inside, axis=1)
    home = np.zeros(len(names), dtype=np.int64)
    home[code] = block
    i, j = np.nonzero(total)
    # Within a block each pair once; between two blocks only pairs across.
    right = (i < j) & (((home[i] == low) & (home[j] == high)) | ((home[i] == high) & (home[j] == low)))
    return [(names[a], names[b], int(total[a, b])) for a, b in zip(i[right].tolist(), j[right].tolist())]


def _joint(key: tuple, own: pa.Table) -> pa.Table:
    found = _meet(own)
    return pa.table(
        {
            "lang": pa.array([key[0].as_py()] * len(found), pa.string()),
            "a": pa.array([x[0] for x in found], pa.string()),
            "b": pa.array([x[1] for x in found], pa.string()),
            "value": pa.array([x[2] for x in found], pa.int64()),
        }
    )


def audited(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP
) -> DataFrame:
    """`lang`, `source`, `part` (`pair`, `term`), `item`, `value`, `rank`."""
    of_term = Window.partitionBy("lang", "term")  # at most a row per source
    cells = counted(docs, text, lang, source).withColumns(
        {"lang_n": F.sum("n").over(of_term), "lang_docs": F.sum("docs").over(of_term)}
    )
    cells = written(cells.where(F.col("term").isNull() | (F.col("lang_docs") >= least_docs)).drop("docs", "lang_docs"), "cells")
    groups = cells.where(F.col("term").isNull()).select("lang", "source")
    terms = cells.where(F.col("term").isNotNull())
    kept = terms.groupBy("lang", "term").agg(F.any_value("lang_n").alias("lang_n"))
    kept = written(row_numbers(kept, ["lang", "term"], "id"), "kept-terms")
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    held = written(terms.join(kept.select("lang", "term", "id"), ["lang", "term"]), "held-terms")
    blocks = F.ceil(F.count("*").over(Window.partitionBy("lang")) / SOURCES).cast("long")
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(sizes, ["lang", "source"], "left").join(of_lang, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "v", "lang_total")]
    )
    groups = groups.withColumn("blocks", blocks).withColumns(
        {"block": F.pmod(F.xxhash64("source"), "blocks"), "p0": share(F.lit(0).cast("long"), F.col("total"), F.col("v"))}
    )
    groups = written(groups, "groups")
    with_p = held.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
    value = F.col("p") - share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    best = _ranked(
        with_p.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
        .where(F.col("value") > 0)
    ).where(F.col("rank") <= top)
    return _ranked(_pairs(with_p, groups)).unionByName(best)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _pairs(with_p: DataFrame, groups: DataFrame) -> DataFrame:
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("id", F.lit(64)).cast("int"))
    sets = with_p.groupBy("lang", "source", "block", "blocks", "p0", "p", F.floor(F.col("id") / 64).alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )
    sets = written(sets, "term-sets")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = sets.withColumn("other", every).select(
        "lang", "source", "block", "p0", "p", "word", "bits", F.shiftright("word", RUN_BITS).alias("run"),
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )
    joint = dealt.groupBy("lang", "run", "low", "high").applyInArrow(_joint, "lang string, a string, b string, value long")
    other = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("z"), "v", F.col("block").alias("other"))

    def met(rows: DataFrame) -> DataFrame:
        """Rows beside each other source of their language."""
        spread = rows.withColumn("other", every).withColumnRenamed("source", "a")
        return spread.join(other, ["lang", "other"]).where(F.col("a") != F.col("b"))

    gap = F.abs(F.col("p0") - F.col("z"))
    levels = sets.groupBy("lang", "source", "blocks", "p0", "p").agg(F.sum(F.bit_count("bits")).alias("size"))
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    alone = met(levels).select("lang", *ends, (F.col("size") * (F.abs(F.col("p") - F.col("z")) - gap)).alias("value"))
    zeros = met(groups.drop("v", "block")).where(F.col("a") < F.col("b")).select("lang", "a", "b", (F.col("v") * gap).alias("value"))
    summed = zeros.unionByName(alone).unionByName(joint.select("lang", *ends, "value")).groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value")
    )
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return summed.select("lang", both.alias("_x"), "value").select(
        "lang", "_x.source", F.lit("pair").alias("part"), "_x.item", "value"
    )
