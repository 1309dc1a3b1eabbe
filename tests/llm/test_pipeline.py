"""The whole pipeline against plain Python, row by row."""

from __future__ import annotations

import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_corpus import plain_components, plain_fingerprint
from test_texts import GOOD, JUNK, NARROW, crc, plain_learned, plain_spans, plain_verdicts

import corpus_pipeline
from goldleaf.llm.oracle import MIXING
from goldleaf.llm.queries import vocabulary
from goldleaf.session import scratch

KINDS = ("EMAIL", "IP", "CARD", "PHONE")


def plain_masked(text, spans):
    out, at = [], 0
    for start, rank, stop in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[rank]}]"]
        at = max(at, stop)
    return "".join(out) + text[at:]


def plain_run(rows):
    """Rows are (doc_id, text, lang, source, n_chars); the pieces of the last stage without their places."""
    from tokenizers import Tokenizer

    rows = [r for r, kept in zip(rows, plain_verdicts([(r[1], r[3]) for r in rows])) if kept]
    least = plain_components([(r[0], plain_fingerprint(r[1])) for r in rows])
    rows = [r for r, (doc_id, _, root) in zip(rows, least) if doc_id == root]
    learned = plain_learned([r[1] for r in rows])
    rows = [(i, plain_masked(t, sorted(plain_spans(t) + sorted(new))), lang, s, n) for (i, t, lang, s, n), new in zip(rows, learned)]
    db = duckdb.connect()
    db.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]))
    mixed = db.execute(MIXING).fetchall()
    copies = {doc_id: taken // size for doc_id, size, _, _, taken in mixed if size}
    coder = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    out = []
    for i, t, *_ in rows:
        ids = coder.encode(t, add_special_tokens=False).ids + [1]
        out += [(i, k // 4096, k, len(ids[k : k + 4096]), crc(ids[k : k + 4096])) for k in range(0, len(ids), 4096)] * copies.get(i, 0)
    return out


@pytest.fixture(scope="module")
def planted():
    """Junk, narrow lapses, exact copies, near copies of 0.8 to 0.99, identifiers, long texts, nulls."""
    rng = random.Random(11)
    vocab = [f"{chr(97 + i % 26)}{chr(98 + i // 26 % 20)}{i}x" for i in range(900)]
    plain = [re.sub(r"\d", "", w) or "w" for w in vocab]
    line = lambda n: " ".join(rng.choice(plain) for _ in range(n))
    texts = [line(rng.randint(25, 300)) for _ in range(90)] + [line(9000), GOOD, NARROW, JUNK, JUNK + " x", None, "", "short"]
    base = line(300)
    for changes in (0, 0, 1, 2, 5, 12, 25, 30):
        own = base.split()
        for i in rng.sample(range(300), changes):
            own[i] = f"other{changes}"
        texts.append(" ".join(own))
    texts += [f"{line(30)} write to u{i}@mail.org or call +1 (802) 555-98{i:02d}" for i in range(20)]
    texts += [f"{line(30)} write to user{i}0" for i in range(2)] + [f"{line(25)} 4111 1111 1111 1111 and 10.0.0.{i}" for i in range(4)]
    return [(i, t, "en", f"s{i % 4}" if i % 17 else None, len(t or "")) for i, t in enumerate(texts)]


def test_pipeline_by_brute_force(spark, planted):
    folder = scratch(spark, "planted")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(planted, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, folder).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    want = plain_run(planted)
    assert sorted(map(tuple, got)) == sorted(want)
    kept = {w[0] for w in want}
    assert {r[0] for r in planted if r[1] in (None, "", "short")} & kept == set() and len(kept) > 90


def test_stages_keep_columns_and_take_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, "")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert after.columns == docs.columns
            path = scratch(spark, name)
            after.write.parquet(path)
            docs = spark.read.parquet(path)
        assert {"doc_id", "sequence_id", "offset"} <= set(docs.columns)
    assert docs.where(F.lit(True)).count() == 0
