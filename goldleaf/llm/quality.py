"""Quality rules per document, judged once more per host.

Documents are measured one by one. Failures of the rules are then counted per host; a host's
rate is shrunk towards the rate of all hosts by a beta prior whose two parameters are fitted to
the hosts themselves, so that a host of three documents is not condemned by two. The host's
verdict is joined back to its documents.

* The hard rules (`base_failed`) reject a document wherever it comes from.
* A document that breaks a soft rule (symbols, repeated lines, odd word length) is judged by both its own lapse and its
  host: the host's shrunk rate gives the odds that a document of it is bad, and `beyond`, how many times its limit the
  worst measure is, is the evidence of the document itself. It is rejected where odds times evidence are above one. So a
  narrow lapse is forgiven unless every other document of the host fails, and a gross one unless the host hardly knows any.
* A document that breaks no rule is kept on any host.

Defined results: a null or empty text has no words and fails (fewer than 20 words). Documents
with a null host share one host. Repeated rows and repeated ids are judged row by row. An empty
table gives an empty result. Extra columns are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.words import Texts, mixed, sliced
from goldleaf.session import written

LEAST_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
#: Soft rules: symbols per word, share of lines that repeat an earlier one, characters per word.
SYMBOL_PERCENT = 30
DUP_LINE_PERCENT = 50
WORD_CHARS = (2, 20)
#: Strength of the prior in documents, where the hosts' rates do not vary enough to tell.
STRENGTH = (2.0, 1000.0)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def repeated_words(texts: Texts, width: int = WINDOW) -> np.ndarray:
    """Words of each text in windows that the text holds twice or more."""
    begin = texts.windows(width)
    if not len(begin):
        return np.zeros(texts.n, dtype=np.int64)
    keys = texts.window_hashes(texts.word_hashes(), begin, width)
    keys = mixed(keys + texts.doc[begin].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
    inside = texts.covered(begin[count[which] > 1], width)
    return np.bincount(texts.doc[inside], minlength=texts.n)


def lines(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word in each text, and those of them equal to an earlier one."""
    breaks = np.flatnonzero(texts.data == 0x0A)
    start = np.unique(np.concatenate([texts.at[:-1], breaks + 1]))
    start = start[start < len(texts.data)]
    if not len(start):
        return np.zeros(texts.n, dtype=np.int64), np.zeros(texts.n, dtype=np.int64)
    end = np.append(start[1:], len(texts.data))
    # A line ends before its line feed; the last one of a text has none.
    end = end - (texts.data[end - 1] == 0x0A)
    holds = np.searchsorted(texts.start, end) > np.searchsorted(texts.start, start)
    start, end = start[holds], end[holds]
    doc = np.searchsorted(texts.at, start, side="right") - 1
    keys = texts.span_hashes(start, end) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, first = np.unique(mixed(keys), return_index=True)
    every = np.bincount(doc, minlength=texts.n)
    return every, every - np.bincount(doc[first], minlength=texts.n)


def measure_texts(texts: Texts) -> dict[str, np.ndarray]:
    n_lines, n_dup = lines(texts)
    return {
        "n_words": texts.counts(),
        "word_chars": texts.per_text(texts.solid & ((texts.data & 0xC0) != 0x80)),
        "n_symbols": texts.per_text(_SYMBOL[texts.data]),
        "n_lines": n_lines,
        "n_dup_lines": n_dup,
        "n_repeat_words": repeated_words(texts),
    }


def measured(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """The carried columns of every document with its measures."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in sliced(batch, "_text"):
                found = measure_texts(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(carry))]
                    + [pa.array(found[m].astype(np.int64)) for m in MEASURES],
                    names=[f"_c{i}" for i in range(len(carry))] + list(MEASURES),
                )

    kept = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], F.col(text).alias("_text"))
    schema = kept.drop("_text").schema
    for m in MEASURES:
        schema = schema.add(m, "long")
    return kept.mapInArrow(work, schema).withColumnsRenamed({f"_c{i}": c for i, c in enumerate(carry)})


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )


def beyond() -> Column:
    """How many times its limit the document's worst measure is; for repeated lines by odds, as shares end at one."""
    n, low, high = F.col("n_words"), *WORD_CHARS
    once = F.col("n_lines") - F.col("n_dup_lines")
    return F.coalesce(
        F.greatest(
            100 * F.col("n_symbols") / F.nullif(SYMBOL_PERCENT * n, F.lit(0)),
            (100 - DUP_LINE_PERCENT) * F.col("n_dup_lines") / F.nullif(DUP_LINE_PERCENT * once, F.lit(0)),
            F.col("word_chars") / F.nullif(high * n, F.lit(0)),
            low * n / F.nullif(F.col("word_chars"), F.lit(0)),
        ),
        F.lit(0.0),
    )


def soft_failed() -> Column:
    """Rules a document may break, depending on its host and on how far."""
    return F.col("beyond") > 1


def host_verdicts(judged: DataFrame, host: str) -> DataFrame:
    """One row per host: documents, failures, and the shrunk rate of failures.

    The prior's mean is the failure rate of all documents; its strength comes from how far the
    hosts' rates spread beyond what chance alone gives (method of moments). The sums behind it
    are one row, and counts per host are combined before they are shuffled.
    """
    hosts = judged.groupBy(host).agg(
        F.count("*").alias("host_docs"),
        F.sum((F.col("base_failed") | F.col("soft_failed")).cast("long")).alias("host_failed"),
    )
    rate = F.col("host_failed") / F.col("host_docs")
    all_hosts = hosts.agg(
        F.sum("host_docs").alias("n"),
        F.sum("host_failed").alias("f"),
        F.sum(F.col("host_failed") * rate).alias("ff"),
        F.sum(F.col("host_docs").cast("double") * F.col("host_docs")).alias("nn"),
        F.count("*").alias("k"),
    )
    mean = F.col("f") / F.col("n")
    # Between-host variance of the rates, weighted by documents.
    extra = F.col("ff") - F.col("n") * mean * mean - (F.col("k") - 1) * mean * (1 - mean)
    spread = extra / F.nullif(F.col("n") - F.col("nn") / F.col("n"), F.lit(0.0))
    strength = F.when(spread > 0, mean * (1 - mean) / spread - 1).otherwise(F.lit(STRENGTH[1]))
    prior_mean = all_hosts.select(mean).scalar()
    prior_strength = all_hosts.select(F.least(F.greatest(strength, F.lit(STRENGTH[0])), F.lit(STRENGTH[1]))).scalar()
    shrunk = (F.col("host_failed") + prior_mean * prior_strength) / (F.col("host_docs") + prior_strength)
    return hosts.select(F.col(host).alias("_host"), "host_docs", "host_failed", shrunk.alias("host_rate"))


def judged(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    rows = measured(docs, carry, text).withColumns({"base_failed": base_failed(), "beyond": beyond()})
    return rows.withColumn("soft_failed", soft_failed())


def _with_verdicts(rows: DataFrame, verdicts: DataFrame, host: str) -> DataFrame:
    guilty = F.col("soft_failed") & (F.col("beyond") * F.col("host_rate") > 1 - F.col("host_rate"))
    return (
        rows.join(verdicts, F.col(host).eqNullSafe(F.col("_host")), "left")
        .drop("_host")
        .withColumn("kept", ~F.col("base_failed") & ~guilty)
    )


def judge(docs: DataFrame, carry: list[str], host: str = "source", text: str = "text") -> DataFrame:
    """The carried columns of every document, its measures, its host's rate, and whether it is kept."""
    # Written once, without the texts: the counts per host and the join both read it.
    rows = written(judged(docs, list(dict.fromkeys([*carry, host])), text), "quality")
    return _with_verdicts(rows, host_verdicts(rows, host), host)


def keep_good(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The documents that are kept, with all their columns.

    Texts are measured once, to rows without them; the rejected documents are then taken out by two hashes of all
    columns, in which only equal rows, and so equal verdicts, agree.
    """
    keys = [F.xxhash64(*docs.columns).alias("_x"), F.xxhash64(F.lit(1), *docs.columns).alias("_y")]
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), *keys, F.col(host).alias("_h"), F.col(text).alias("_t"))
    verdicts = judge(keyed, ["_x", "_y"], "_h", "_t")
    bad = verdicts.where(~F.col("kept")).select("_x", "_y").distinct()
    return keyed.join(bad, ["_x", "_y"], "left_anti").select("_row.*")
