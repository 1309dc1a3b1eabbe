"""Toxicity of whole texts: gradient-boosted trees over a few dense features, then calibrated.

1. A lexicon is learned from labelled training rows: words and beginnings of words that stand in
   far more toxic texts than others, with their log-odds. (Fixed word lists would miss what a corpus
   really holds, and most of its languages.)
2. Every text becomes a dozen numbers: densities and weights of lexicon hits, hits near a second
   person, capitals, punctuation, obfuscated spelling.
3. Boosted trees are fitted to one part of the training rows and an isotonic regression to the other
   part, so that a score can be read as a probability. The rows the trees see are measured with
   lexicons learned from other rows (`FOLDS`), as texts without a label will be.

At most `TRAIN_ROWS` labelled rows are used, those with the smallest hash of their id; held-out rows
(crc32 of the id as text, modulo 3, is 1) never. Labels, language, source and id are no inputs.

Defined results: a null or empty text has features zero and gets a score like any other. A row with
a null doc_id is not held out. A label that is null is no label; of several labels of an id
the largest counts. Without training rows of both kinds all scores are the share of
toxic ones among the training rows, or 0. Repeated rows get equal scores. An empty table gives an
empty result. Extra columns are carried along if asked for, otherwise ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.llm.words import Texts, sliced
from goldleaf.session import written

TRAIN_ROWS = 40_000
#: Entries of the lexicon at most; toxic texts an entry stands in at least; least log-odds.
LEXICON = 600
SUPPORT = 5
ODDS = 2.0
STRONG = 4.0
PREFIXES = (4, 5, 6, 7)
NEAR = 5
CUT = 0.7
TREES, DEPTH, STEP = 20, 3, 0.2
#: Parts of the rows the trees are fitted to; each is measured with a lexicon of the others.
FOLDS = 3

#: Second-person words of the corpus' languages.
SECOND_PERSON = frozenset(
    "you your yours yourself du dich dir dein deine ihr euch sie tu te toi ton ta vous votre tú usted ustedes su".split()
)

FEATURES = (
    "log_words", "strong_density", "strong_hits", "mild_density", "mild_hits", "weight", "weight_density",
    "distinct_strong", "near_you", "capitals", "shouted", "exclaimed", "asked", "obfuscated",
)

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_LEET = str.maketrans("@430157$!", "aaeoistsi")


def plain_word(word: str) -> str:
    return _EDGES.sub("", word).lower()


def units(word: str) -> list[str]:
    """What the lexicon knows of a word: itself, and its beginnings marked by a hyphen."""
    return [word] + [word[:n] + "-" for n in PREFIXES if len(word) > n]


def _distinct(texts: Texts) -> tuple[list[str], np.ndarray]:
    """Distinct raw words of some texts, and the number of each word among them."""
    sizes = texts.end - texts.start
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    packed = np.ascontiguousarray(texts.data[texts.solid])
    words = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    coded = words.dictionary_encode()
    return [w.decode("utf-8", "replace") for w in coded.dictionary.to_pylist()], coded.indices.to_numpy()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that each unit stands in, toxic and not, summed over a slice."""
    for batch in batches:
        for part, texts in sliced(batch, "_t"):
            toxic = part.column(0).to_numpy(zero_copy_only=False).astype(bool)
            raw, which = _distinct(texts)
            names: dict[str, int] = {}
            owner, unit = [], []
            for i, word in enumerate(map(plain_word, raw)):
                if word:
                    for u in units(word):
                        owner.append(i)
                        unit.append(names.setdefault(u, len(names)))
            if not names:
                continue
            # Each pair of text and unit once.
            owner, unit = np.array(owner), np.array(unit)
            order = np.argsort(owner, kind="stable")
            first = np.searchsorted(owner[order], np.arange(len(raw) + 1))
            size = np.diff(first)[which]
            upto = np.cumsum(size)
            pairs = unit[order][np.repeat(first[which] - upto + size, size) + np.arange(upto[-1])]
            pairs = np.unique(np.repeat(texts.doc, size) * len(names) + pairs)
            hit, bad = pairs % len(names), toxic[pairs // len(names)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(names)),
                    pa.array(np.bincount(hit[bad], minlength=len(names))),
                    pa.array(np.bincount(hit[~bad], minlength=len(names))),
                ],
                names=["unit", "toxic", "clean"],
            )


def learn_lexicon(rows: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Units with the strongest evidence, from rows of `_y` and `_t`; at most LEXICON of them."""
    counts = rows.select("_y", "_t").mapInArrow(_count, "unit string, toxic long, clean long").groupBy("unit").agg(
        F.sum("toxic").alias("a"), F.sum("clean").alias("b")
    )
    odds = F.log((F.col("a") + 0.5) / (toxic + 1.0)) - F.log((F.col("b") + 0.5) / (clean + 1.0))
    best = counts.where(F.col("a") >= SUPPORT).withColumn("odds", odds).where(F.col("odds") >= ODDS)
    top = best.orderBy((F.col("odds") * F.sqrt("a")).desc(), "unit").limit(LEXICON)
    return {r.unit: r.odds for r in top.select("unit", "odds").collect()}


class Measure:
    """Features of texts against a lexicon."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon
        self.lengths = [n for n in PREFIXES if any(u[-1] == "-" and len(u) == n + 1 for u in lexicon)]

    def weight(self, word: str) -> float:
        get = self.lexicon.get
        return max([get(word, 0.0)] + [get(word[:n] + "-", 0.0) for n in self.lengths if len(word) > n])

    def word(self, raw: str) -> tuple[float, bool, bool, bool, bool]:
        """Weight, second person, shouted, obfuscated, ends in an exclamation mark."""
        word = plain_word(raw)
        mixed = not word.isalpha() and any(c.isalpha() for c in word)
        weight = self.weight(word)
        if mixed and not weight:
            weight = self.weight(plain_word(raw.lower().translate(_LEET)))
        return weight, word in SECOND_PERSON, len(raw) > 2 and raw.isupper(), mixed, raw.endswith("!")

    def texts(self, texts: Texts) -> np.ndarray:
        out = np.zeros((texts.n, len(FEATURES)))
        if not len(texts.start):
            return out
        raw, which = _distinct(texts)
        table = np.array([self.word(r) for r in raw], dtype=np.float64)
        weight, you, shouted, mixed, loud = table[which].T
        n = texts.counts()
        total = lambda x: np.bincount(texts.doc, weights=x, minlength=texts.n)
        hit, strong = weight > 0, weight >= STRONG
        # Second persons up to NEAR words away, in the same text.
        upto = np.concatenate([[0], np.cumsum(you)])
        at = np.arange(len(which))
        low = np.maximum(at - NEAR, texts.word_at[texts.doc])
        high = np.minimum(at + NEAR + 1, texts.word_at[texts.doc + 1])
        near = hit & (upto[high] > upto[low])
        pairs = np.unique(texts.doc[strong] * len(raw) + which[strong]) if strong.any() else np.zeros(0, np.int64)
        data = texts.data
        length = np.maximum(np.diff(texts.at), 1)
        share = lambda x: total(x) / np.maximum(n, 1)
        for i, x in enumerate(
            (
                np.log1p(n), share(strong), total(strong), share(hit & ~strong), total(hit & ~strong), total(weight),
                share(weight), np.bincount(pairs // len(raw), minlength=texts.n), share(near),
                texts.per_text((data >= 65) & (data <= 90)) / length, share(shouted), texts.per_text(data == 33) / np.maximum(n, 1),
                texts.per_text(data == 63) / np.maximum(n, 1), share(mixed),
            )
        ):
            out[:, i] = x
        return out


def measured(rows: DataFrame, carry: list[str], lexicon: dict[str, float]) -> DataFrame:
    """Carried columns and `features` (an array of doubles) of rows with a text column `_t`."""
    kept = rows.select(*carry, "_t")
    schema = T.StructType([*kept.drop("_t").schema.fields, T.StructField("features", T.ArrayType(T.DoubleType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measure(lexicon)
        for batch in batches:
            for part, texts in sliced(batch, "_t"):
                flat = measure.texts(texts)
                bounds = pa.array(np.arange(texts.n + 1, dtype=np.int32) * len(FEATURES))
                lists = pa.ListArray.from_arrays(bounds, pa.array(flat.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(carry))] + [lists], names=[*carry, "features"]
                )

    return kept.mapInArrow(work, schema)


def held_out(doc_id: str | Column) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1


def scored(
    docs: DataFrame, labels: DataFrame, carry: list[str], doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """Carried columns, held_out, score and predicted of every document."""
    n = len(carry)
    base = docs.select(
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
        F.col(doc_id).cast("long").alias("_d"), held_out(doc_id).alias("_held"), F.col(text).alias("_t"),
    )
    marked = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("_e")).agg(
        F.max(F.col(label)).cast("int").alias("_y")
    )
    # Ids are chosen before any text is fetched.
    chosen = written(
        marked.where(F.col("_e").isNotNull() & ~held_out("_e")).orderBy(F.xxhash64("_e"), "_e").limit(TRAIN_ROWS), "labelled"
    )
    # TRAIN_ROWS rows of two numbers.
    train = written(base.select("_d", "_t").join(F.broadcast(chosen), F.col("_d") == F.col("_e")).select("_e", "_y", "_t"), "train")
    sizes = {r._y: r.n for r in train.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    toxic, every = sizes.get(1, 0), sum(sizes.values())
    ids = [f"_c{i}" for i in range(n)]
    named = {f"_c{i}": c for i, c in enumerate(carry)}
    if not toxic or toxic == every:
        flat = base.select(*ids, F.col("_held").alias("held_out"), F.lit(toxic / every if every else 0.0).alias("score"))
        return flat.withColumn("predicted", (F.col("score") >= CUT).cast("int")).withColumnsRenamed(named)

    part = F.when(F.pmod(F.xxhash64(F.lit(3), "_e"), F.lit(4)) == 0, -1).otherwise(F.pmod(F.xxhash64(F.lit(5), "_e"), F.lit(FOLDS)))
    train = train.withColumn("_part", part.cast("int"))
    # A row per part and label.
    tally = {(r._part, r._y): r.n for r in train.groupBy("_part", "_y").agg(F.count("*").alias("n")).collect()}
    if not all(any(p >= 0 and y == kind for p, y in tally) for kind in (0, 1)):  # too few rows to set any aside
        train = train.withColumn("_part", F.lit(0))
        tally = {(0, 1): toxic, (0, 0): every - toxic}

    def lexicon_without(fold: int) -> dict[str, float]:
        others = {key: n for key, n in tally.items() if key[0] not in (-1, fold)}
        mine = train.where((F.col("_part") >= 0) & (F.col("_part") != fold))
        return learn_lexicon(mine, *(sum(n for (_, y), n in others.items() if y == kind) for kind in (1, 0)))

    lexicon = lexicon_without(FOLDS)
    folds = [
        measured(train.where(F.col("_part") == f), ["_e", "_y", "_part"], lexicon_without(f)) for f in range(FOLDS)
    ]
    aside = measured(train.where(F.col("_part") < 0), ["_e", "_y", "_part"], lexicon)
    points = written(reduce(DataFrame.union, folds, aside), "points").withColumn("x", array_to_vector("features"))
    fitting = F.col("_part") >= 0
    trees = GBTClassifier(
        featuresCol="x", labelCol="_y", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=1, subsamplingRate=1.0,
    ).fit(points.where(fitting))
    chance = vector_to_array("probability")[1]
    rest = trees.transform(points.where(~fitting)).select(chance.alias("chance"), F.col("_y").cast("double").alias("_y"))
    if rest.agg(F.max("_y") - F.min("_y")).head()[0] != 1.0:  # too few rows to set any aside
        rest = trees.transform(points).select(chance.alias("chance"), F.col("_y").cast("double").alias("_y"))
    steps = IsotonicRegression(featuresCol="chance", labelCol="_y", predictionCol="fair").fit(rest)

    rows = measured(base, [*ids, "_held"], lexicon).withColumn("x", array_to_vector("features"))
    judged = steps.transform(trees.transform(rows).withColumn("chance", chance))
    # A trace of the trees' own score orders what the steps make equal.
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.98 * F.col("fair") + 0.02 * F.col("chance")))
    return judged.select(*ids, F.col("_held").alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int")
    ).withColumnsRenamed(named)
