"""License notices by a positional index of rare words.

The index holds the distinctive words of public notices with their positions: of each notice the `TOP` words with the
highest inverse document frequency over all files. Every license word of a file is looked up, so a file may hold any
number of notices among any other license words. Where a file's word and a notice's word meet, the difference of their positions says
where the notice would begin; words that agree on that place, up to `SLACK` words inserted or left out, add up their
weights. A notice that reaches `SHARE` of its weight at a place is a candidate there, and becomes a label if all its
mandatory phrases stand where the notice has them, by the same measure: a phrase somewhere else in the file, or one that a denial precedes, proves nothing.

Beside that, places of three fixed phrases are found exactly (the base); their labels always stay. The score is the
largest verified share; a file with a base phrase that no denial precedes has at least the share
that its best place holds of a notice with that label, so a mere mention scores less than a grant.

All of it is DataFrame expressions. A text is cut into words once; everything else goes by word numbers, in time
proportional to its words. The index has a few hundred rows whatever the corpus, and only files with a license
word leave the scan with more than their counts.

Defined results: words are runs of ASCII letters and digits and of all characters beyond ASCII, A to Z
lower-cased. A null or empty text has no words, no label and score 0. Repeated rows get equal
results. An empty table gives an empty result. Extra columns are carried along if asked for,
otherwise ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.session import local_rows, written

#: Phrases whose places are counted, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Texts of public notices.
_MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software.
"""
_ISC = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
"""
_BSD_LEAD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
"""
_BSD_TWO = """
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THREE = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS"
_APACHE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
"""
_GNU = """
{name} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as
published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.
"""
_MPL = """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
_ZLIB = """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely
"""
_UNLICENSE = """
This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
sell, or distribute this software
"""


def _gnu(kind: str, version: str) -> str:
    return _GNU.format(name="This program", kind=kind, version=version)


#: Label, notice, and the phrases without which it is not one.
NOTICES = (
    ("mit", "released under the terms of the mit license", ("under the terms of the mit license",)),
    ("mit", "licensed under the mit license", ("licensed under the mit license",)),
    ("mit", _MIT, ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    ("isc", _ISC, ("permission to use copy modify and or distribute this software", "with or without fee is hereby granted")),
    ("apache", "licensed under the apache license version 2 0", ("under the apache license",)),
    ("apache-2.0", _APACHE, ("licensed under the apache license version 2 0", "in compliance with the license")),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    ("gpl-2", _gnu("", "2"), ("the gnu general public license", "either version 2 of the license")),
    ("gpl-3", _gnu("", "3"), ("the gnu general public license", "either version 3 of the license")),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("lgpl-2.1", _gnu("Lesser ", "2.1"), ("gnu lesser general public license", "either version 2 1 of the license")),
    ("lgpl-3", _gnu("Lesser ", "3"), ("gnu lesser general public license", "either version 3 of the license")),
    ("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    ("agpl-3", _gnu("Affero ", "3"), ("gnu affero general public license", "either version 3 of the license")),
    ("bsd", _BSD_LEAD, ("redistribution and use in source and binary forms",)),
    ("bsd-2-clause", _BSD_TWO + _AS_IS, ("redistributions in binary form must reproduce", "with the distribution this software is provided")),
    ("bsd-3-clause", _BSD_TWO + _BSD_THREE, ("redistributions in binary form must reproduce", "neither the name of")),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("mpl-2.0", _MPL, ("mozilla public license v 2 0", "if a copy of the mpl was not distributed")),
    ("zlib", _ZLIB, ("without any express or implied warranty", "to alter it and redistribute it freely")),
    ("unlicense", _UNLICENSE, ("free and unencumbered software", "into the public domain")),
    ("cc", "this work is licensed under a creative commons attribution license", ("creative commons attribution",)),
    ("cc", "licensed under cc by nc 4 0", ("licensed under cc",)),
)

#: Words too common to be looked up.
COMMON = frozenset(
    "a above after all an and any anyone appear are as at authors be by can code copy do either event except file files following "
    "for form forms free from held http https if in included into including is it its later list may materials met must name "
    "names no not obtain of one option or org other person persons prior program public published shall so software source "
    "specific subject such terms that the these this to under use used v version was whom will with without work written www you "
    "your 0 1 2 3 4".split()
)
#: Words that deny what follows, and how far.
DENIALS, DENIAL_REACH = ("not", "no", "never", "non"), 4
TOP = 8
SLACK = 4
SHARE = 0.6

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_HITS = "array<struct<at:int,word:string>>"


def split_words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def _rare(notice: str) -> list[tuple[int, str]]:
    return [(i, w) for i, w in enumerate(split_words(notice)) if w not in COMMON]


def _place(notice: str, phrase: str) -> int:
    """Word of the notice at which a phrase of it begins."""
    words, own = split_words(notice), phrase.split()
    return next(i for i in range(len(words)) if words[i : i + len(own)] == own)


#: Mandatory phrases: notice, words, and where the notice has them.
KEYS = [(n, key.split(), _place(text, key)) for n, (_, text, keys) in enumerate(NOTICES) for key in keys]
VOCABULARY = sorted({w for _, text, _ in NOTICES for _, w in _rare(text)} | {w for phrase in BASE for w in phrase.split()})


def words_of(text: Column) -> Column:
    # The Kelvin sign is the one character beyond ASCII whose lower case is a letter of ASCII.
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("κ"))
    return F.regexp_extract_all(F.lower(plain), F.lit(WORD), F.lit(0))


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _hits(words: Column) -> Column:
    """License words with their numbers."""
    known = F.transform(words, lambda w, i: F.when(w.isin(VOCABULARY), F.struct(i.alias("at"), w.alias("word"))))
    return F.when(F.arrays_overlap(words, _literal(VOCABULARY)), F.array_compact(known)).otherwise(F.array().cast(_HITS))


def _phrase_places(hits: Column, phrase: list[str]) -> Column:
    """Numbers of the words at which a phrase of license words begins."""

    def begins(hit: Column, i: Column) -> Column:
        whole = hit.word == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            after = F.get(hits, i + k)
            whole = whole & (after.word == word) & (after.at == hit.at + k)
        return F.when(whole, hit.at)

    return F.array_compact(F.transform(hits, begins))


def _key_places(words: Column, hits: Column) -> Column:
    """key and at: where a mandatory phrase stands, and where its notice would begin."""
    def places(key: int, phrase: list[str], place: int) -> Column:
        # Looked for at its first license word.
        rare = next(i for i, w in enumerate(phrase) if w in VOCABULARY)

        def stands(hit: Column) -> Column:
            begin = F.greatest(hit.at - rare, F.lit(0))
            whole = F.slice(words, begin + 1, len(phrase)) == _literal(phrase)
            return (hit.word == phrase[rare]) & whole & ~_denied(words, begin)

        return F.transform(
            F.filter(hits, stands), lambda h: F.struct(F.lit(key).alias("key"), (h.at - rare - place).alias("at"))
        )

    found = [places(k, phrase, place) for k, (_, phrase, place) in enumerate(KEYS)]
    return F.when(F.size(hits) > 0, F.concat(*found)).otherwise(F.array().cast("array<struct<key:int,at:int>>"))


def _denied(words: Column, place: Column) -> Column:
    first = F.greatest(place - DENIAL_REACH, F.lit(0))
    return F.arrays_overlap(F.slice(words, first + 1, place - first), _literal(list(DENIALS)))


def scanned(docs: DataFrame, carry: dict[str, str], text: str) -> DataFrame:
    """Carried columns, a row number, word count, base places by phrase, those among them that nothing denies, license
    words with their places, and the mandatory phrases."""
    plain = docs.select(*[F.col(c).alias(n) for c, n in carry.items()], words_of(F.col(text)).alias("_w"))
    hits = plain.withColumn("_hits", _hits(F.col("_w")))
    base = {f"_b{i}": _phrase_places(F.col("_hits"), p.split()) for i, p in enumerate(BASE)}
    placed = hits.withColumns(base)
    meant = {f"_s{i}": F.filter(f"_b{i}", lambda p: ~_denied(F.col("_w"), p)) for i in range(len(BASE))}
    return placed.select(
        *carry.values(), F.monotonically_increasing_id().alias("_row"), F.size("_w").cast("long").alias("n_words"), *base,
        *[c.alias(n) for n, c in meant.items()], "_hits", _key_places(F.col("_w"), F.col("_hits")).alias("_keys"),
    )


def weights(found: DataFrame, hits: DataFrame) -> DataFrame:
    """word and idf of every license word that occurs, over all documents."""
    df = hits.select("_row", "word").distinct().groupBy("word").agg(F.count("*").alias("df"))
    every = found.select(F.count("*")).scalar()
    return df.select("word", F.log1p(every / F.col("df")).alias("idf"))


def _cells(rows: DataFrame, offset: Column) -> DataFrame:
    """Two overlapping grids of 2 * SLACK words: places up to SLACK apart share a cell of one of them."""
    return rows.withColumn("_grid", F.explode(F.array(F.lit(0), F.lit(SLACK)))).withColumn(
        "_cell", F.floor((offset + F.col("_grid")) / (2 * SLACK))
    )


CELL = ["_row", "notice", "_grid", "_cell"]


def matched(found: DataFrame) -> DataFrame:
    """_row, notice, its share at the best of its places, and whether it is verified at a place with SHARE or more."""
    spark = found.sparkSession
    postings = local_rows(
        spark,
        [{"notice": n, "place": i, "w": w} for n, (_, text, _) in enumerate(NOTICES) for i, w in _rare(text)],
        "notice int, place int, w string",
    )
    hits = found.select("_row", F.explode("_hits").alias("h")).select("_row", F.col("h.at").alias("at"), F.col("h.word").alias("word"))
    # As many rows as the vocabulary has words at most.
    idf = written(weights(found, hits), "idf")
    # A notice's TOP rarest words; one that no file has weighs as the rarest there is.
    rarest = idf.select(F.max("idf")).scalar()
    listed = postings.select("notice", "w").distinct().join(F.broadcast(idf), F.col("w") == F.col("word"), "left")
    tops = written(
        listed.withColumn("idf", F.coalesce("idf", rarest))
        .groupBy("notice")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("idf", "w")), asc=False), 1, TOP).alias("top"))
        .select("notice", F.explode("top").alias("t"))
        .select("notice", "t.idf", "t.w"),
        "notice-words",
    )
    index = postings.join(F.broadcast(tops), ["notice", "w"])
    met = hits.join(F.broadcast(index), F.col("word") == F.col("w"))
    sums = (
        _cells(met, F.col("at") - F.col("place"))
        .groupBy(*CELL, "word")
        .agg(F.max("idf").alias("idf"))
        .groupBy(*CELL)
        .agg(F.sum("idf").alias("held"))
    )
    full = tops.groupBy("notice").agg(F.sum("idf").alias("full"))
    shares = sums.join(F.broadcast(full), "notice").select(*CELL, F.least(F.lit(1.0), F.col("held") / F.col("full")).alias("share"))
    needed = local_rows(
        spark, [{"key": k, "notice": n, "every": len(NOTICES[n][2])} for k, (n, _, _) in enumerate(KEYS)], "key int, notice int, every int"
    )
    keys = found.select("_row", F.explode("_keys").alias("k")).select("_row", "k.key", "k.at").join(F.broadcast(needed), "key")
    # Every mandatory phrase at the place where the notice has it.
    proven = (
        _cells(keys, F.col("at")).groupBy(*CELL, "every").agg(F.count_distinct("key").alias("n")).where(F.col("n") == F.col("every"))
        .select(*CELL, F.lit(True).alias("proven"))
    )
    verified = F.coalesce("proven", F.lit(False)) & (F.col("share") >= SHARE)
    best = F.max(F.struct(verified.alias("verified"), F.col("share").alias("share"))).alias("b")
    return shares.join(proven, CELL, "left").groupBy("_row", "notice").agg(best).select("_row", "notice", "b.share", "b.verified")


def labelled(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """Carried columns, n_words, n_base, first_word, last_word, base_labels, labels (arrays), score."""
    named = {c: f"_c{i}" for i, c in enumerate(carry)}
    found = written(scanned(docs, named, text), "license-words")
    shares = matched(found).groupBy("_row").agg(F.collect_list(F.struct("notice", "share", "verified")).alias("_m"))
    marked = found.join(shares.withColumnRenamed("_row", "_r"), F.col("_row") == F.col("_r"), "left")
    places = F.concat(*[F.col(f"_b{i}") for i in range(len(BASE))])
    names = _literal([label for label, _, _ in NOTICES])
    none = F.array().cast("array<string>")
    by_base = F.array_compact(
        F.array(*[F.when(F.size(f"_b{i}") > 0, F.lit(label)) for i, label in enumerate(BASE.values())])
    )
    # A base label is meant where it stands undenied; then its notices count as far as they are there.
    meant = F.array_compact(
        F.array(*[F.when(F.size(f"_s{i}") > 0, F.lit(label)) for i, label in enumerate(BASE.values())])
    )
    sure = F.filter("_m", lambda m: m.verified)
    by_notice = F.coalesce(F.transform(sure, lambda m: F.element_at(names, m.notice + 1)), none)
    counts = F.filter("_m", lambda m: m.verified | F.array_contains(meant, F.element_at(names, m.notice + 1)))
    return marked.select(
        *[F.col(n).alias(c) for c, n in named.items()], "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(by_base)).alias("base_labels"),
        F.array_sort(F.array_distinct(F.concat(by_base, by_notice))).alias("labels"),
        F.coalesce(F.array_max(F.transform(counts, lambda m: m.share)), F.lit(0.0)).alias("score"),
    )
