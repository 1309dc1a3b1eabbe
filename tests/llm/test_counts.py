"""Exact duplicates, centroids and divergence against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldleaf.llm import centroids, divergence, exactdups
from goldleaf.session import scratch

SPACE = re.compile(r"[\x20\x09-\x0D]+")


# Exact duplicates -------------------------------------------------------------


def check_copies(docs, found):
    """The contract's columns by brute force; of each group one row stays."""
    groups = defaultdict(list)
    rows = [(r.doc_id, SPACE.sub(" ", r.text or "")) for r in docs.select("doc_id", "text").collect()]
    for i, t in rows:
        groups[t].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    sha = {t: hashlib.sha256(t.encode()).hexdigest() for t in groups}
    got = found.select("doc_id", "keep_id", "group_size", "text_sha256", "kept").collect()
    want = [(i, least[t], len(groups[t]), sha[t]) for i, t in rows]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:4]) for r in got)
    stay = [r for r in got if r.kept]
    assert Counter(r.text_sha256 for r in stay) == Counter(sha.values())
    assert all(r.doc_id == r.keep_id for r in stay)


def test_copies_on_odd_rows(odd):
    check_copies(odd, exactdups.judged(odd, ["doc_id"]))


def test_clashing_columns(spark):
    names = ["content", "digest", "file", "at", "_id", "n", "least", "kept", "doc_id", "text"]
    docs = spark.createDataFrame([(*["x"] * 8, i, "same" if i % 2 else f"t{i}") for i in range(12)], ", ".join(f"{c} {'long' if c == 'doc_id' else 'string'}" for c in names))
    check_copies(docs, exactdups.judged(docs, ["doc_id"]))
    assert exactdups.judged(docs, ["content", "file", "doc_id"]).where("content = 'x' and file = 'x'").count() == 12


def test_texts_under_one_digest_are_told_apart(spark, odd):
    """A digest of one hexadecimal character: nearly all texts meet others under theirs."""
    short = exactdups.Deduplicator(spark, scratch(spark, "exact"), lambda c: F.substring(F.sha2(c, 256), 1, 1))
    short.add(odd, ["doc_id"])
    check_copies(odd, short.results())


def test_state_is_kept_over_additions(spark, odd):
    """Later documents meet earlier ones; a smaller id that comes later takes over."""
    folder = scratch(spark, "exact")
    parts = [odd.where("size % 3 = 0"), odd.where("size % 3 <> 0"), odd.limit(0)]
    more = spark.createDataFrame([(-5, "two  words"), (2000, "two\twords"), (2001, "new")], "doc_id long, text string")
    for part in parts:
        # A new object every time: nothing is remembered but what the folder holds.
        exactdups.Deduplicator(spark, folder).add(part, ["doc_id"])
    last = exactdups.Deduplicator(spark, folder)
    last.add(more, ["doc_id"])
    check_copies(odd.select("doc_id", "text").union(more), last.results())
    assert last.state().agg(F.sum("n")).first()[0] == odd.count() + 3
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_very_large_groups(spark, plan_of):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.floor(F.col("id") / 2))).alias("text"))
    found = exactdups.judged(rows, ["doc_id"])
    check_copies(rows, found)
    assert "BroadcastHashJoin" in plan_of(found) and "Python" not in plan_of(found) and "Arrow" not in plan_of(found)


def test_no_documents(none):
    assert exactdups.judged(none, ["doc_id"]).count() == 0


# Centroids --------------------------------------------------------------------


def plain_clusters(rows, clusters, rounds, dims):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:clusters]
    middle = [v for _, v in first]
    if not middle:
        return []

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middle)) for _, v in kept]

    for _ in range(rounds):
        own = defaultdict(list)
        for (_, v), (_, c) in zip(kept, assign()):
            own[c].append(v)
        for c, vs in own.items():
            middle[c] = [sum(x) // len(vs) for x in zip(*vs)]
    done = assign()
    inertia = Counter()
    for d, c in done:
        inertia[c] += d
    return [(i, c, d, inertia[c], sum(inertia.values()), middle[c]) for (i, _), (d, c) in zip(kept, done)]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(5)
    near = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in near[i % 4]]) for i in range(150)]
    rows += [(None, rows[0][1]), rows[3], rows[3], (700, None), (701, []), (702, [1.0] * 5), (703, [1.0] * 5 + [None]), (704, [float("nan")] * 6), (705, [float("inf")] * 6), (706, [0.0] * 6), (707, [-0.0004] * 6), (708, [100.0] * 6)]
    rows += [(800 + i, [float(rng.randint(-1, 1)) for _ in range(6)]) for i in range(40)]  # ties
    return spark.createDataFrame([(i, v, "c", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, v int").repartition(3)


@pytest.mark.parametrize("clusters,rounds", [(8, 10), (3, 2), (1, 1), (40, 3), (400, 1)])
def test_clusters(vectors, clusters, rounds):
    got = centroids.clustered(vectors, ["vec_id"], clusters, rounds, dims=6).collect()
    want = plain_clusters([(r.vec_id, r.embedding) for r in vectors.collect()], clusters, rounds, 6)
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)


def test_carried_columns_may_clash(vectors):
    got = centroids.clustered(vectors.withColumnRenamed("cluster", "id"), ["v", "id", "vec_id"], 4, 2, dims=6)
    assert got.columns == ["v", "id", "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert {(r.v, r.id) for r in got.collect()} == {(1, "c")}


def test_walk_finds_the_nearest_and_stops_early():
    rng = np.random.default_rng(2)
    for span, k in ((3, 5), (40, 30), (900, 200)):
        middle = rng.integers(-span, span + 1, (k, 2))
        some = rng.integers(-span, span + 1, (300, 2))
        which, best, compared = centroids.nearest(some, middle)
        exact = ((some[:, None, :] - middle[None]) ** 2).sum(axis=2)
        assert (best == exact.min(axis=1)).all() and (which == exact.argmin(axis=1)).all()
    assert compared.mean() < k / 2  # many centroids in two dimensions: most are never compared


def test_no_vectors_and_too_large_ones(spark, vectors):
    assert centroids.clustered(vectors.limit(0), ["vec_id"], dims=6).count() == 0
    assert centroids.clustered(vectors, ["vec_id"], dims=7).columns[-1] == "centroid"
    huge = spark.createDataFrame([(1, [1e9] * 6)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond 2"):
        centroids.clustered(huge, ["vec_id"], dims=6)


# Divergence -------------------------------------------------------------------

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain_audit(rows, least, top=50):
    lower = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t)
    rows = [(lang or "", source or "", TERM.findall(lower(text or ""))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        df = Counter(t for _, _, w in own for t in set(w))
        kept = {t for t, n in df.items() if n >= least}
        counts = {s: Counter() for _, s, _ in own}
        for _, s, w in own:
            counts[s].update(t for t in w if t in kept)
        whole = sum(counts.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in counts:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, n) for n, (i, v) in enumerate(found, 1) if part == "pair" or n <= top]
    return out


def check_audit(docs, least, top=50):
    got = divergence.audited(docs, least_docs=least, top=top).collect()
    want = plain_audit([(r.lang, r.source, r.text) for r in docs.collect()], least, top)
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)


@pytest.mark.parametrize("least", [1, 3, 30])
def test_audit_on_odd_rows(odd, least):
    check_audit(odd, least)


def random_docs(spark, n, sources, seed=3):
    rng = random.Random(seed)
    vocab = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)] + ["É", "日本", "ß'x"]
    rows = []
    for i in range(n):
        words = [vocab[int(len(vocab) * rng.random() ** 3)] for _ in range(rng.choice([0, 5, 40, 200]))]
        rows.append((i, " ".join(words).title() if i % 3 else "-".join(words), rng.choice(["en", "en", "de", None]), rng.choice(sources)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)


def test_audit_of_many_terms(spark):
    check_audit(random_docs(spark, 150, ["a", "b", "c", None, "", "Z", "é"]), 4, top=20)


def test_audit_in_blocks_of_sources(spark, monkeypatch):
    """More sources than fit a block, runs of few terms, comparisons in small steps."""
    for name, value in (("SOURCES", 3), ("RUN_BITS", 1), ("PAIRS", 64), ("SLICE_BYTES", 500)):
        monkeypatch.setattr(divergence, name, value)
    check_audit(random_docs(spark, 120, [f"s{i}" for i in range(17)], 8), 2)


def test_no_terms_and_no_documents(spark, none):
    assert divergence.audited(none).count() == 0
    rows = [(i, t, "xx", s) for i, (t, s) in enumerate([("", "a"), ("12 34", "b"), (None, "c")])]
    found = divergence.audited(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert {(r.source, r.item, r.value) for r in found.collect()} == {(a, b, 0) for a in "abc" for b in "abc" if a != b}
