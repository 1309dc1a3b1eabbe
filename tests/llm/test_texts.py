"""Operators on single texts against plain Python over whole texts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pytest

from goldleaf.llm import arrowfiles, licenses, packing, pii, quality
from goldleaf.llm.queries import vocabulary
from goldleaf.llm.tokens import Encoder
from goldleaf.llm.words import Texts
from goldleaf.session import scratch
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def as_set(rows):
    return sorted(map(repr, rows))


# Quality ----------------------------------------------------------------------


def plain_quality(text):
    w, windows, covered = words(text), {}, set()
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    for places in windows.values():
        if len(places) > 1:
            for i in places:
                covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
        len(w) < 20 or 100 * len(covered) > 30 * len(w),
    )


def test_quality_measures(odd):
    got = quality.judge(odd, ["doc_id", "text"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    want = [(r.doc_id, *plain_quality(r.text)) for r in odd.collect()]
    assert as_set(map(tuple, got.collect())) == as_set(want)


def plain_verdicts(rows):
    """kept of (text, host) rows: hard rules, or odds of the host times how far beyond its limit the worst measure is."""
    judged = []
    for text, host in rows:
        n, chars, symbols, dup, repeat, failed = plain_quality(text)
        lines = len([x for x in (text or "").split("\n") if WORD.search(x)])
        beyond = max(symbols / (0.3 * n), dup / (lines - dup), chars / (20 * n), 2 * n / chars) if n else 0
        judged.append((host, failed, beyond))
    hosts = {}
    for host, failed, beyond in judged:
        hosts.setdefault(host, []).append(failed or beyond > 1)
    n, k = len(judged), len(hosts)
    mean = sum(map(sum, hosts.values())) / n
    extra = sum(sum(h) ** 2 / len(h) for h in hosts.values()) - n * mean**2 - (k - 1) * mean * (1 - mean)
    free = n - sum(len(h) ** 2 for h in hosts.values()) / n
    spread = extra / free if free else 0
    strength = min(max(mean * (1 - mean) / spread - 1, 2), 1000) if spread > 0 else 1000
    rate = {h: (sum(v) + mean * strength) / (len(v) + strength) for h, v in hosts.items()}
    return [not failed and not (beyond > 1 and beyond * rate[host] > 1 - rate[host]) for host, failed, beyond in judged]


GOOD = " ".join(f"w{i}" for i in range(40))
#: Symbols at 1.1, 2.2 and 10 times their limit.
NARROW = GOOD + " " + " ".join(f"#{i}" for i in range(20))
NOISY = GOOD + " " + " ".join(f"#{i}#" for i in range(20))
JUNK = " ".join(f"w{i}### v{i}$$$" for i in range(20))


def test_host_verdicts(spark):
    rows = [(i, NOISY, "bad") for i in range(60)] + [(100 + i, GOOD, "bad") for i in range(5)]
    rows += [(200 + i, GOOD, "fine") for i in range(60)] + [(300, NOISY, "fine"), (301, NARROW, None), (302, GOOD, None), (303, GOOD, None)]
    rows += [(400, "short", "fine"), (401, None, "fine"), (402, JUNK, "fine")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    got = {r.doc_id: r for r in quality.judge(docs, ["doc_id"]).collect()}
    # Noise counts on the noisy host only; clean documents stay there.
    assert not got[0].kept and got[100].kept and got[300].kept and got[301].kept and not got[400].kept and not got[401].kept
    assert got[0].host_rate > 0.5 > got[300].host_rate
    assert [got[i].kept for i, _, _ in rows] == plain_verdicts([(t, h) for _, t, h in rows])
    stays = quality.keep_good(docs)
    assert stays.columns == docs.columns and {r.doc_id for r in stays.collect()} == {i for i, r in got.items() if r.kept}


def test_a_host_of_which_a_third_is_bad(spark):
    """Its noise goes and its narrow lapses stay; noise on the other hosts stays, junk goes on all of them."""
    rows = [(i, NOISY if i < 60 else NARROW if i < 70 else GOOD, "bad") for i in range(200)]
    rows += [(1000 + i, NOISY if i % 40 == 0 else JUNK if i % 13 == 0 else GOOD, f"s{i % 9}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    got = {r.doc_id: r for r in quality.judge(docs, ["doc_id"]).collect()}
    assert not any(r.base_failed for r in got.values()) and all(r.host_rate < 0.5 for r in got.values())
    assert not any(got[i].kept for i in range(60)) and all(got[i].kept for i in range(60, 200))
    assert all(got[i].kept == (t != JUNK) for i, t, h in rows if h != "bad")
    assert [got[i].kept for i, _, _ in rows] == plain_verdicts([(t, h) for _, t, h in rows])


def test_verdicts_on_odd_rows(odd):
    rows = odd.select("doc_id", "text", "source").collect()
    want = plain_verdicts([(r.text, r.source) for r in rows])
    got = quality.judge(odd, ["doc_id", "text"]).select("doc_id", "text", "source", "kept").collect()
    assert as_set(map(tuple, got)) == as_set((*r, k) for r, k in zip(rows, want))
    assert quality.keep_good(odd).count() == sum(want)


# Personal data ----------------------------------------------------------------

SHAPES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for rank, (kind, shape) in enumerate(SHAPES.items()):
        for m in re.finditer(shape, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip":
                ok = all(int(x) <= 255 for x in m.group().split("."))
            elif kind == "card":
                ok = 12 <= len(digits) <= 19 and luhn(digits)
            else:
                ok = kind == "email" or 9 <= len(digits) <= 15
            if ok:
                out.append((m.start(), rank, m.end()))
    return sorted(out)


TRICKY = [
    "a.b@c.d_e@f.g a@b.c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 000.1.2.255 1.2.3", "4111 1111 1111 1111, 4111-1111-1111-1112",
    "+1 (802) 555-9869. +1234567 +-1 +1(2)3.4-5 6 7 8 9 0 1", "\U0001f600 x@y.zz \U0001f600 10.0.0.1", "@ + . 1-", "a@b.cc " * 400,
]


def test_base_spans(spark, odd):
    docs = odd.select("text").union(spark.createDataFrame([(t,) for t in TRICKY], "text string"))
    got = pii.spotted(docs, ["text"]).collect()
    assert as_set((r.text, [tuple(s) for s in r.base]) for r in got) == as_set((r.text, plain_spans(r.text)) for r in docs.collect())
    assert all(set(r.base) <= set(r.spans) for r in got)


def plain_contexts(texts):
    """(text number, start, stop, rank of a seed, token, patterns) of every seed and token."""
    import regex

    out = []
    word = regex.compile(r"[\p{L}\p{N}](?:[^\x20\x09-\x0D]*[\p{L}\p{N}])?")
    for n, text in enumerate(texts):
        base = plain_spans(text)
        found = [(a, b, rank) for a, rank, b in base]
        for m in re.finditer(pii.TOKEN, text):
            if len(m.group()) >= pii.LEAST and not any(a < m.end() and b > m.start() for a, _, b in base):
                found.append((m.start(), m.end(), None))
        for a, b, rank in found:
            last = word.findall(text[max(0, a - 80) : a].lower())[-2:]
            out.append((n, a, b, rank, text[a:b].lower(), ([last[-1]] if last else []) + ([" ".join(last)] if len(last) > 1 else [])))
    return out


def plain_learned(texts):
    """Learned spans per text: the bootstrap with dictionaries."""
    seen = plain_contexts(texts)
    rank_of, graph = {}, {}
    for _, _, _, rank, token, patterns in seen:
        for p in patterns:
            held = graph.setdefault(p, {})
            old = held.get(token)
            held[token] = rank if old is None else old if rank is None else min(rank, old)
    graph = {p: held for p, held in graph.items() if len(held) >= pii.SUPPORT}
    weights = {p: {k: [sum(r == k for r in held.values())] * 2 for k in set(held.values()) - {None}} for p, held in graph.items()}

    def scored(weights):
        return {
            (p, k): w / (len(graph[p]) + pii.PRIOR) for p, kinds in weights.items() for k, (n, w) in kinds.items() if n >= pii.SUPPORT
        }

    scores = scored(weights)
    for _ in range(pii.ROUNDS - 1):
        wrong = {}
        for (p, k), score in scores.items():
            if score >= pii.CONFIDENT:
                for token, rank in graph[p].items():
                    if rank is None:
                        wrong[token, k] = wrong.get((token, k), 1) * (1 - score)
        after = {p: {k: list(x) for k, x in kinds.items()} for p, kinds in weights.items()}
        for p, held in graph.items():
            for (token, k), w in wrong.items():
                if held.get(token, 0) is None:
                    x = after.setdefault(p, {}).setdefault(k, [0, 0])
                    x[0], x[1] = x[0] + 1, x[1] + 1 - w
        scores = scored(after)
    best = {}
    for (p, k), score in scores.items():
        if score >= pii.CONFIDENT:
            best[p] = max(best.get(p, (0, -9)), (score, -k))
    out = [set() for _ in texts]
    for n, a, b, rank, _, patterns in seen:
        said = [best[p] for p in patterns if p in best]
        if rank is None and said:
            out[n].add((a, -max(said)[1], b))
    return out


def check_spans(docs):
    got = pii.spotted(docs, ["text"]).collect()
    texts = [r.text or "" for r in got]
    learned = plain_learned(texts)
    for r, new in zip(got, learned):
        assert [tuple(s) for s in r.base] == plain_spans(r.text)
        assert [tuple(s) for s in r.spans] == sorted(plain_spans(r.text) + sorted(new))
    return learned


def test_learned_spans_by_brute_force(spark, odd):
    rng = random.Random(7)
    near = ["mail me at", "account number", "order", "serial", "the"]

    def entity():
        k = rng.randrange(4)
        n = "".join(rng.choice("0123456789") for _ in range(rng.choice([3, 6, 9])))
        return [f"u{n}@x{rng.randrange(9)}.org", f"10.{rng.randrange(300)}.1.{n[:2]}", f"id-{n}", f"{n} {n}"][k]

    rows = [(" ".join(x for _ in range(rng.randint(0, 25)) for x in (rng.choice(near), entity(), "and so on")),) for _ in range(60)]
    rows += [(f"account number AB{i:05d}",) for i in range(30)] + [(f"write to a{i}@b.cc",) for i in range(30)] + [(f"write to user{i}0",) for i in range(4)]
    assert any(check_spans(odd.select("text").union(spark.createDataFrame(rows, "text string"))))


def test_long_texts_in_pieces(spark, monkeypatch):
    """Pieces as short as can be give what whole texts give."""
    rng = random.Random(3)
    bits = ["mail me at", "a@b.cc", "10.0.0.1", "+1 (802) 555-9869", "4111 1111 1111 1111", "x1\ny2", "555 010 1234", "word", "\n", "1", "7-7", "é9z"]
    rows = [(" ".join(rng.choice(bits) for _ in range(400)),) for _ in range(8)] + [("7 " * 3000,), ("a@b.cc" * 900,), ("z9 " * 2500,)]
    docs = spark.createDataFrame(rows, "text string")
    whole = as_set(map(tuple, pii.redacted(docs).collect()))
    check_spans(docs)
    monkeypatch.setattr(pii, "PIECE", 3)
    monkeypatch.setattr(pii, "TOGETHER", 2)
    monkeypatch.setattr(pii, "CUT", pii.CUT.replace("2000", "3"))
    check_spans(docs)
    assert as_set(map(tuple, pii.redacted(docs).collect())) == whole


def seconds(work):
    start = time.time()
    work()
    return time.time() - start


@pytest.mark.parametrize("scan", [lambda d: pii.redacted(d), lambda d: licenses.labelled(d, ["doc_id"])])
def test_time_in_proportion_to_matches(spark, scan):
    """Ten times the matches in one text take about ten times as long, not a hundred."""

    def took(n):
        docs = spark.createDataFrame([(1, "mail a1b2c@d.ee or the mit license x9876 " * n)], "doc_id int, text string")
        return seconds(lambda: scan(docs).collect())

    took(100)
    few, many = took(2_000), took(20_000)
    assert many < 25 * few


def test_contexts_discover_and_mask(spark):
    rows = [(i, f"please phone me at +1 555 010 {1000 + i} now") for i in range(20)]
    rows += [(50, "please phone me at 5550101234 now"), (51, "I was there at 5550101234 once"), (52, "room 5550101234")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    texts = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert texts[0] == "please phone me at [PHONE] now" and texts[50] == "please phone me at [PHONE] now"
    assert texts[52] == "room 5550101234"


def test_contexts_without_seeds_are_learned(spark):
    rows = [(i, f"please phone me at +1 555 010 {1000 + i} now") for i in range(100)]
    # Numbers met after a learned context and after a new one, and one after the new context alone.
    rows += [(200 + i, f"please phone me at {5550101000 + i} now") for i in range(20)]
    rows += [(300 + i, f"her extension being {5550101000 + i} now") for i in range(20)]
    rows += [(400, "her extension being 5550109999 now"), (401, "the order number was 5550109999 once")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    texts = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert texts[205] == "please phone me at [PHONE] now"
    assert texts[305] == texts[400] == "her extension being [PHONE] now" and texts[401] == rows[-1][1]


def test_grouped_numbers_are_masked_whole(spark):
    grouped = ["555 010 1234", "555010 12345", "555.010.1234", "555-010-1234", "(555) 010 1234", "(555)010-1234", "[555] 0101234"]
    rows = [(i, f"please phone me at +1 555 010 {1000 + i} now") for i in range(60)]
    rows += [(100 + i, f"please phone me at {x} now") for i, x in enumerate(grouped)]
    rows += [(200, "no 12 please phone me at 5550101234 now"), (201, "the sum is 555 010 1234 today")]
    rows += [(202, "please phone me at 55501 10.0.0.1 now"), (203, "please phone me at 55501 2nd floor")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    texts = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert {texts[100 + i] for i in range(len(grouped))} == {"please phone me at [PHONE] now"}
    assert texts[200] == "no 12 please phone me at [PHONE] now" and texts[201] == rows[-3][1]
    assert texts[202] == "please phone me at [PHONE] [IP] now" and texts[203] == "please phone me at [PHONE] 2nd floor"


def test_overlapping_spans_are_masked_once(spark):
    row = spark.range(1).select(
        pii.masked(F.lit("0123456789"), F.expr("array(struct(1 AS start, 2 AS rank, 5 AS stop), struct(3 AS start, 3 AS rank, 7 AS stop))"))
    )
    assert row.first()[0] == "0[CARD]789"


# Licenses ---------------------------------------------------------------------


def plain_licenses(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), sorted(labels)


LICENSED = [
    "a-MIT--LICENSE", "\u212a mit license", "mitlicense mit licenses", "The General\nPublic (License)", "mit license " * 50,
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met", "Licensed under CC BY-NC 4.0.", "a general remark on public licenses", "M\u0130T license", "li\u212ae mit license",
]


def test_licenses(spark, odd):
    docs = odd.select("text").union(spark.createDataFrame([(t,) for t in LICENSED], "text string"))
    got = licenses.labelled(docs, ["text"]).collect()
    base = ((r.text, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got)
    assert as_set(base) == as_set((r.text, plain_licenses(r.text)) for r in docs.collect())
    by_text = {r.text: r for r in got}
    assert by_text[LICENSED[5]].labels == ["bsd"] and by_text[LICENSED[6]].labels == ["cc"] and by_text[LICENSED[7]].labels == []
    assert all(0 <= r.score <= 1 and set(r.base_labels) <= set(r.labels) for r in got)


#: Notices among which the rare words are counted, so that no word is the rarest just because a test has few files.
APART = " " + " ".join(f"w{i}" for i in range(60)) + " "


def found_labels(spark, texts):
    every = list(dict(enumerate(texts)).items()) + [(1000 + i, text) for i, (_, text, _) in enumerate(licenses.NOTICES)]
    docs = spark.createDataFrame(every, "doc_id int, text string")
    return {r.doc_id: r for r in licenses.labelled(docs, ["doc_id"]).collect()}


def test_every_notice_is_found(spark):
    """Each notice alone has its label, and one of another version or number of clauses does not."""
    got = found_labels(spark, [])
    for i, (label, _, _) in enumerate(licenses.NOTICES):
        assert label in got[1000 + i].labels and got[1000 + i].score == pytest.approx(1), label
    at = {label: got[1000 + i].labels for i, (label, _, _) in enumerate(licenses.NOTICES)}
    assert "gpl-3" not in at["gpl-2"] and "gpl-2" not in at["gpl-3"] and "gpl-3" not in at["lgpl-3"] + at["agpl-3"]
    assert "bsd-3-clause" not in at["bsd-2-clause"] and "bsd-2-clause" not in at["bsd-3-clause"]
    assert at["isc"] == ["isc"] and at["zlib"] == ["zlib"] and at["unlicense"] == ["unlicense"]


def test_files_with_several_notices(spark):
    notice = {}
    for label, text, _ in licenses.NOTICES:
        notice.setdefault(label, text)
    others = "mozilla affero commons creative attribution lesser gnu redistribute distribution foundation charge obtaining"
    texts = [
        notice["bsd"] + APART + notice["isc"], notice["bsd"] + APART + notice["isc"] + APART + notice["mpl"],
        others + APART + notice["isc"] + APART + others, others, "x // " + notice["gpl-2"].replace("\n", "\n// ") + APART + notice["apache-2.0"],
    ]
    # Plain files, in which the words of the notices are not the rarest.
    got = found_labels(spark, texts + [f"{notice['bsd'] if i % 2 else notice['isc']} {i}" for i in range(20)])
    assert got[0].labels == ["bsd", "isc"] and got[1].labels == ["bsd", "isc", "mpl"]
    assert got[2].labels == ["isc"] and got[2].score >= licenses.SHARE and got[3].labels == []
    assert set(got[4].labels) >= {"gpl", "gpl-2", "apache", "apache-2.0"} and "gpl-3" not in got[4].labels
    assert all(got[5 + i].labels == [["isc", "bsd"][i % 2]] for i in range(20))


def test_phrases_elsewhere_and_denials(spark):
    """A mandatory phrase somewhere else proves nothing; a mention scores less than a grant, a denial nothing."""
    isc = licenses.split_words(dict((label, text) for label, text, _ in licenses.NOTICES)["isc"])
    first, last = " ".join(isc[:13]), " ".join(isc[13:])
    got = found_labels(spark, [
        first + " x " * 300 + last, "not under the mit license", "we compare the mit license with others",
        "this file is licensed under the mit license", "no word of the gnu general public license", "mit license",
    ])
    assert got[0].labels == []
    assert [got[i].base_labels for i in (1, 2, 3, 4)] == [["mit"], ["mit"], ["mit"], ["gpl"]]
    assert got[1].score == 0 and 0 < got[2].score < got[3].score == pytest.approx(1) and 0 < got[5].score < 1


def plain_notices(texts):
    """Labels of the notices and the scores, by comparing every place with every notice."""
    words = [plain_words(t) for t in texts]
    df = {}
    for w in words:
        for x in set(w) & set(licenses.VOCABULARY):
            df[x] = df.get(x, 0) + 1
    idf = {x: math.log1p(len(texts) / n) for x, n in df.items()}
    rarest = max(idf.values(), default=0)
    out = []
    for w in words:
        labels, shares = set(), [0.0]
        meant = set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            if any(not set(w[max(0, i - 4) : i]) & set(licenses.DENIALS) for i in at):
                meant.add(label)
        for n, (label, text, keys) in enumerate(licenses.NOTICES):
            own = [(i, x) for i, x in enumerate(licenses.split_words(text)) if x not in licenses.COMMON]
            ranked = sorted({x for _, x in own}, key=lambda x: (idf.get(x, rarest), x), reverse=True)[: licenses.TOP]
            top = {x: idf.get(x, rarest) for x in ranked}
            cells, proofs = {}, {}
            for at, x in enumerate(w):
                for i, y in own:
                    if x == y and x in top:
                        for grid in (0, licenses.SLACK):
                            cells.setdefault((grid, (at - i + grid) // (2 * licenses.SLACK)), set()).add(x)
            for key in keys:
                k, place = key.split(), licenses._place(text, key)
                for at in range(len(w)):
                    if w[at : at + len(k)] == k and not set(w[max(0, at - 4) : at]) & set(licenses.DENIALS):
                        for grid in (0, licenses.SLACK):
                            proofs.setdefault((grid, (at - place + grid) // (2 * licenses.SLACK)), set()).add(key)
            best = {False: 0.0, True: 0.0}
            for cell, held in cells.items():
                share = min(1.0, sum(top[x] for x in held) / sum(top.values()))
                sure = share >= licenses.SHARE and proofs.get(cell) == set(keys)
                best[sure] = max(best[sure], share)
            if best[True]:
                labels.add(label)
                shares.append(best[True])
            elif label in meant:
                shares.append(best[False])
        out.append((labels, max(shares)))
    return out


def plain_words(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def test_labels_by_brute_force(spark, odd):
    rng = random.Random(9)
    texts = [r.text for r in odd.select("text").collect()] + LICENSED
    for _ in range(120):
        parts = []
        for _ in range(rng.randint(1, 3)):
            w = licenses.split_words(rng.choice(licenses.NOTICES)[1])
            for _ in range(rng.choice([0, 0, 1, 3, 12])):  # words lost, or put in
                i = rng.randrange(len(w))
                w[i : i + rng.randint(0, 1)] = [rng.choice(["license", "foo", "mit", "not", "the"])] * rng.randint(0, 2)
                w = w or ["x"]
            parts.append(" ".join(w[rng.choice([0, 0, 5]) :]))
        texts.append(" y ".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in licenses.labelled(docs, ["doc_id"]).collect()}
    for i, (labels, score) in enumerate(plain_notices(texts)):
        assert set(got[i].labels) == labels | set(got[i].base_labels), texts[i]
        assert abs(got[i].score - score) < 1e-9, texts[i]


# Tokens -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def plain_ids():
    from tokenizers import Tokenizer

    def ids(name, text, end):
        if name not in known:
            known[name] = Tokenizer.from_file(vocabulary(name))
        return known[name].encode(text or "", add_special_tokens=False).ids + [end]

    known = {}
    return ids


SPECIAL = [
    "one <|endoftext|> two", "<|endoftext|>", "<|endoftext|><|startoftext|> x", "a<|endoftext|>", "<|ENDOFTEXT|> y", "no | token <| here |>",
    "<|endoftext|> " * 40, "plain text\nof two lines", "<|startoftext|>a b<|endoftext|>\n",
]


@pytest.mark.parametrize("name, word_ends", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_special_tokens_are_those_of_the_library(name, word_ends):
    from tokenizers import Tokenizer

    raw = [t.encode() for t in SPECIAL]
    texts = Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    ids, counts = Encoder(vocabulary(name), word_ends).encode(texts)
    plain = Tokenizer.from_file(vocabulary(name))
    want = [plain.encode(t, add_special_tokens=False).ids for t in SPECIAL]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    assert len(want[0]) in (3, 4)


def as_texts(rows):
    raw = [t.encode() for t in rows]
    return Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


def counted(coder, monkeypatch):
    """The strings that the encoder gives to the whole tokenizer from now on, and those for its model alone."""
    given = {"tokenizer": [], "model": []}

    class Counted:
        def __init__(self, inner, seen):
            self.inner, self.seen = inner, seen

        def encode_batch_fast(self, strings, **kw):
            self.seen += strings
            return self.inner.encode_batch_fast(strings, **kw)

    for name, seen in given.items():
        monkeypatch.setattr(coder, name, Counted(getattr(coder, name), seen))
    return given


#: Words, signs and white space whose neighbours matter.
JOINTS = [*"abXZ '.,;!?*&#$|<_^`~-(){0129\n", "  ", *"èÉßÿ×÷ªµ日ΣςİЙﬁÅ≠\u0301\u0338\u0345\u00ad\u200d\u00a0\t", "'s", "'RE", " don't"]


@pytest.mark.parametrize("name, word_ends", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_words_go_to_the_model_alone(name, word_ends, monkeypatch):
    """Only what is no plain word takes the costly way; ids are those of the library."""
    from tokenizers import Tokenizer

    rng = random.Random(3)
    prose = [" ".join("".join(rng.choices("aeinorstéüÀß", k=8)) + rng.choice(["", ",", ".", "***"]) for _ in range(300)) for _ in range(5)]
    odd = ["".join(rng.choices(JOINTS, k=rng.randrange(12))) for _ in range(6000)]
    plain = Tokenizer.from_file(vocabulary(name))
    coder = Encoder(vocabulary(name), word_ends)
    for rows in (prose, odd):
        want = [x.ids for x in plain.encode_batch_fast(rows, add_special_tokens=False)]
        with monkeypatch.context() as patch:
            given = counted(coder, patch) if rows is prose else {}
            ids, counts = coder.encode(as_texts(rows))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
        if rows is prose:
            assert sum(map(len, given["tokenizer"])) < 20 and sum(map(len, given["model"])) > 10_000


def test_pieces_met_again_are_not_learnt_again(monkeypatch):
    from goldleaf.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    coder = Encoder(vocabulary("word_bpe_49k.json"), True)
    first = coder.encode(as_texts(["often " * 3]))[0].tolist()
    learnt = []
    monkeypatch.setattr(coder, "_learn", lambda pieces, learn=coder._learn: (learnt.extend(pieces), learn(pieces)))
    for i in range(20):
        new = " ".join(f"x{'abcdefghij'[i % 10]}{'klmnopqrst'[k]}{'uv'[i // 10]}" for k in range(10))
        ids, counts = coder.encode(as_texts([f"often {new}", "often often often"]))
        assert ids[counts[0] :].tolist() == first and len(coder.known) < 70
    assert len(learnt) == 200 and b"often" not in learnt


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing(odd, plain_ids, capacity):
    got = packing.packed(odd, ["doc_id"], vocabulary("word_bpe_49k.json"), capacity=capacity, with_ids=True).collect()
    want = []
    for r in odd.collect():
        ids = plain_ids("word_bpe_49k.json", r.text, 1)
        want += [(r.doc_id, k // capacity, k, len(ids[k : k + capacity]), crc(ids[k : k + capacity])) for k in range(0, len(ids), capacity)]
    assert as_set(tuple(r)[:5] for r in got) == as_set(want)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(held) <= 1.1 * sum(w[3] for w in want) / capacity + 2


def test_sequences_are_put_together(spark, odd):
    pieces = packing.packed(odd, [], vocabulary("word_bpe_49k.json"), with_ids=True)
    sizes = {r.sequence_id: r.n for r in pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()}
    assert {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(pieces).collect()} == sizes


def test_sum_of_squares_rule():
    bins, places = packing.sum_of_squares(np.array([6, 6, 4, 4]), 10)
    assert sorted(zip(bins.tolist(), places.tolist())) == [(0, 0), (0, 6), (1, 0), (1, 6)]
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 300, 4000)
    bins, places = packing.sum_of_squares(sizes, 1000)
    assert np.bincount(bins, weights=sizes).max() <= 1000 and bins.max() + 1 <= sizes.sum() / 1000 * 1.01 + 1


def test_sequences_that_fit_are_joined():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 1000, 5000)
    bins, places = packing.sum_of_squares(sizes, 1000)
    after, at = packing.joined(bins, places, sizes, 1000)
    loads = np.bincount(after, weights=sizes)
    assert loads.max() <= 1000 and loads.min() > 0 and after.max() <= bins.max()
    smallest = np.sort(loads)[:2]
    assert smallest.sum() > 1000  # no two of them fit any more
    for b in range(after.max() + 1):
        own = np.argsort(at[after == b])
        assert (np.cumsum(sizes[after == b][own])[:-1] == at[after == b][own][1:]).all() and at[after == b].min() == 0


def test_equal_rows_are_packed_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    docs = spark.createDataFrame([(7, "the same short text")] * 400, "doc_id int, text string").repartition(4)
    got = packing.packed(docs, ["doc_id"], vocabulary("word_bpe_49k.json"), capacity=64)
    groups = got.groupBy(F.shiftright("sequence_id", 36).alias("g")).count().collect()
    assert len(groups) == 8 and max(r["count"] for r in groups) < 120


def test_arrow_files_round_trip(odd, plain_ids):
    got = arrowfiles.round_trip(odd, vocabulary("byte_bpe_50k.json")).collect()
    rows = [(r.doc_id, plain_ids("byte_bpe_50k.json", r.text, 0)) for r in odd.collect()]
    assert as_set((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == as_set((d, len(i), crc(i)) for d, i in rows)
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id is None for r in in_order] == sorted(r.doc_id is None for r in in_order)
    assert [r.doc_id for r in in_order if r.doc_id is not None] == sorted(d for d, _ in rows if d is not None)
    assert [r.start for r in in_order] == np.cumsum([0] + [r.n_tokens for r in in_order])[:-1].tolist()


def test_arrow_files_of_words_and_signs(spark, plain_ids):
    """Words by the model alone and pieces by all steps give the ids of a plain call."""
    rng = random.Random(8)
    words = ["été", "Straße", "l'eau", "don't", "***", "a×b", "naïve,", "ÀÉ.", "x_1", "日本。", "plain", "Word"]
    rows = [(i, rng.choice(" \n").join(rng.choices(words, k=i % 40))) for i in range(300)]
    got = arrowfiles.round_trip(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary("byte_bpe_50k.json")).collect()
    want = {(i, len(x), crc(x)) for i, t in rows for x in [plain_ids("byte_bpe_50k.json", t, 0)]}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == want


def test_arrow_files_random_access(spark, odd):
    folder = arrowfiles._made(odd, scratch(spark, "files"))
    index = arrowfiles.write_sequences(odd, folder, vocabulary("byte_bpe_50k.json"), length=16).collect()
    for uri in {r.file for r in index}:
        mine = sorted((r.place, r.n_tokens) for r in index if r.file == uri)
        total = sum(n for _, n in mine)
        held = arrowfiles.SequenceFile(uri)
        last, mask = held.sequence((total - 1) // 16)
        assert len(last) == 16 and sum(mask.to_pylist()) == (total - 1) % 16 + 1
        assert len(held.ids(0, total)) == total and not last.flags.owndata


# All of them ------------------------------------------------------------------


def test_empty_tables(none):
    tokens = vocabulary("word_bpe_49k.json")
    for found in (
        quality.judge(none, ["doc_id"]), quality.keep_good(none), pii.spotted(none, ["doc_id"]), pii.redacted(none),
        licenses.labelled(none, ["doc_id"]), packing.packed(none, ["doc_id"], tokens),
        arrowfiles.round_trip(none, vocabulary("byte_bpe_50k.json")),
    ):
        assert found.count() == 0


def test_rows_keep_their_columns(odd):
    same = pii.redacted(odd)
    assert same.columns == odd.columns and same.count() == odd.count()
    untouched = odd.drop("text").exceptAll(same.drop("text"))
    assert untouched.count() == 0
    assert hashlib.sha256(b"").hexdigest() == pii.spotted(odd.where("text = 'one'"), []).select(
        F.sha2(pii.written_out(F.col("base")), 256)
    ).first()[0]
