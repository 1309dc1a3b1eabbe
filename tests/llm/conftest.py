from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, _t string, score double, fp string"


def odd_rows() -> list[tuple]:
    """Nulls in any column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)] + ["é,", "日本", "Mail", "you", "idiot", "#", "a@b.cc", "10.0.0.1", "+1 (802) 555-9869"]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = line(30)
    texts = [None, "", " \n\t ", "one", "two words", line(9), line(25), passage, f"{line(8)} {passage}\n{line(40)}"]
    texts += [f"{passage} {line(3)}", "same line here\n" * 5, "be " * 300, line(4000), "x" * 30_000, "7" * 3000]
    texts += [line(60) for _ in range(12)] + ["MIT License and the Apache License, Version 2.0", "a\x0bb\x0cc\rd\xa0e f  g \n\n h"]
    rows = [(i, t, None if i % 7 == 3 else "en", None if i % 5 == 2 else f"s{i % 3}", None, i, "x", 0.5, "y") for i, t in enumerate(texts)]
    rows += [(40 + i, rows[7][1], "en", "s0", 1, 1, None, None, None) for i in range(5)]
    rows += [rows[8], rows[8], (None, passage, "en", "s1", 1, 1, "x", 0.5, "y"), (8, line(30), "en", "s1", 1, 1, "x", 0.5, "y")]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
