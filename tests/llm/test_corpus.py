"""Operators that compare documents with each other, against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from goldleaf.llm import mixing, simhash, substrings, toxicity, vptree
from goldleaf.llm.components import components
from goldleaf.llm.oracle import ORACLE
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def as_set(rows):
    return sorted(map(repr, rows))


# Substrings -------------------------------------------------------------------


def plain_removals(rows, width=13):
    split = [WORD.findall(r.text or "") for r in rows]
    first = {}
    for r, w in zip(rows, split):
        if r.doc_id is not None:
            for i in range(len(w) - width + 1):
                key = tuple(w[i : i + width])
                first[key] = min(first.get(key, r.doc_id), r.doc_id)
    for r, w in zip(rows, split):
        gone = set()
        if r.doc_id is not None:
            for i in range(len(w) - width + 1):
                if first[tuple(w[i : i + width])] < r.doc_id:
                    gone.update(range(i, i + width))
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        yield r.doc_id, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()


def check_removals(docs):
    got = substrings.without_repeats(docs, ["doc_id"])
    rows = docs.select("doc_id", "text").collect()
    found = got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert as_set(map(tuple, found)) == as_set(plain_removals(rows))
    return {r.doc_id: r.longest for r in got.select("doc_id", "longest").collect()}


def test_repeats_on_odd_rows(odd):
    check_removals(odd)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_on_random_rows(spark, seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    passages = [" ".join(rng.choice(vocab) for _ in range(n)) for n in (12, 13, 14, 30, 90)]
    rows = []
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 40))) for _ in range(4)]
        rows.append((rng.choice([i, i, rng.randint(0, 120)]), "  ".join(parts)))
    rows += [(500 + i, passages[4]) for i in range(30)] + [(600, "be " * 500), (601, "be " * 30)]
    longest = check_removals(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    # Runs of 90 words are seen at the level of 52, whole copies in full.
    assert longest[599 - 70] == 90 and max(longest.values()) >= 52


def test_every_start_is_followed(spark):
    """A repeat of just a level's length is seen at that level, wherever it begins."""
    seen = [(25, 13), (26, 26), (51, 26), (52, 52), (104, 104)] * 8
    rows = []
    for n, (length, _) in enumerate(seen):
        passage = " ".join(f"p{n}-{i}" for i in range(length))
        for side in (0, 1):
            before, after = (" ".join(f"{x}{n}-{side}-{i}" for i in range(3 + n)) for x in "ab")
            rows.append((2 * n + side, f"{before} {passage} {after}"))
    got = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), ["doc_id"])
    longest = {r.doc_id: r.longest for r in got.select("doc_id", "longest").collect()}
    assert longest == {2 * n + side: level for n, (_, level) in enumerate(seen) for side in (0, 1)}


def levels_asked(docs, monkeypatch):
    """`longest` of each document, and how many rows were sorted for lengths beyond a window."""
    asked, shared = [], substrings._shared

    def counted(windows, name, **more):
        asked.extend([windows.count()] * (name == "levels"))
        return shared(windows, name, **more)

    monkeypatch.setattr(substrings, "_shared", counted)
    got = substrings.without_repeats(docs, ["doc_id"])
    return {r.doc_id: r.longest for r in got.select("doc_id", "longest").collect()}, sum(asked)


def test_runs_beside_one_document_ask_nothing_more(spark, monkeypatch):
    """Neighbours in one other document already tell how long the run is; only the rest is sorted again."""
    rows = []
    for n, length in enumerate([13, 26, 51, 104, 200] * 4):
        passage = " ".join(f"p{n}-{i}" for i in range(length))
        rows += [(3 * n + side, " ".join(f"x{n}-{side}-{i}" for i in range(5 + n)) + f" {passage} end{n}-{side}") for side in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    longest, asked = levels_asked(docs, monkeypatch)
    assert [longest[3 * n + 1] for n in range(5)] == [13, 26, 26, 104, 104] and longest[0] == 13
    # A hash at either end of a partition may lose its neighbour, which leaves a passage open.
    each = sum(max(length - 26 * 2**k + 1, 0) for length in [13, 26, 51, 104, 200] * 4 for k in range(4)) * 3
    assert asked < each / 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_longest_of_near_copies(spark, monkeypatch, seed):
    """Copies with words changed here and there: what lies beside one document does not tell all."""
    rng = random.Random(seed)
    sources = [[f"s{k}-{i}" for i in range(230)] for k in range(4)] + [["be"] * 120]
    texts = []
    for n in range(50):
        w = list(rng.choice(sources))
        for at in rng.sample(range(len(w)), rng.randint(1, 5)):
            w[at] = f"new{n}-{at}"
        texts.append(w[rng.randint(0, 30) :] + [f"end{n}"])
    rows = [(n, " ".join(w)) for n, w in enumerate(texts)] + [(7, " ".join(texts[9][20:] + ["again"]))]
    longest, asked = levels_asked(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), monkeypatch)
    assert asked
    expected = dict.fromkeys(range(50), 0)
    for length in (13, 26, 52, 104, 208):
        seen = {}
        for n, text in rows:
            w = text.split()
            for i in range(len(w) - length + 1):
                seen.setdefault(tuple(w[i : i + length]), set()).add(n)
        expected |= {n: length for ids in seen.values() if len(ids) > 1 for n in ids if n != 7}
    assert {n: x for n, x in longest.items() if n != 7} == {n: x for n, x in expected.items() if n != 7}


def test_no_repeats(none):
    assert substrings.without_repeats(none, ["doc_id"]).count() == 0


# SimHash ----------------------------------------------------------------------


def plain_fingerprint(text):
    w = [x.encode() for x in WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))]
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable over links of 3 bits, per (id, fingerprint)."""
    distinct = sorted({f for _, f in prints})
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for d, f in prints:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return [(d, f, least.get(find(f))) for d, f in prints]


def test_fingerprints_and_components(spark, odd):
    rng = random.Random(6)
    base = [f"word{i}" for i in range(300)]
    near = []
    for i in range(60):
        own = list(base)
        for _ in range(i % 4):
            own[rng.randrange(300)] = f"other{i}"
        near.append((1000 + i, " ".join(own)))
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(near, "doc_id long, text string"))
    got = simhash.classified(docs, ["doc_id"]).collect()
    want = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()])
    assert as_set((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got) == as_set(want)


def test_no_link_is_missed():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**63, 300, dtype=np.uint64) * np.uint64(2)
    near = [int(f) ^ sum(1 << int(b) for b in rng.choice(64, i % 4, replace=False)) for i, f in enumerate(fps)]
    every = np.unique(np.concatenate([fps, np.array(near, dtype=np.uint64)]))
    key, row, home = simhash.anchors(every)
    at = {}
    for k, r, h in zip(key.tolist(), row.tolist(), home.tolist()):
        at.setdefault(k, []).append((r, h))
    met = {(min(a, b), max(a, b)) for v in at.values() for a, h in v if h for b, _ in v if a != b}
    links = {(i, j) for i in range(len(every)) for j in range(i + 1, len(every)) if int(every[i] ^ every[j]).bit_count() <= 3}
    assert links and links <= met


def test_a_forest_spans_a_crowded_anchor():
    rng = np.random.default_rng(2)
    fps = np.unique(rng.integers(0, 1 << 12, 600, dtype=np.uint64))
    pairs = simhash.spanning(fps, rng.random(len(fps)) < 0.5)
    assert len(pairs) < len(fps) and all(int(fps[a] ^ fps[b]).bit_count() <= 3 for a, b in pairs)


def test_crowded_anchors_are_dealt_to_blocks(spark):
    """Fingerprints around one anchor, in blocks of 16: the same components as by brute force."""
    rng = random.Random(4)
    prints = sorted({rng.getrandbits(32) << 32 | sum(1 << b for b in rng.sample(range(31), rng.choice([0, 1, 2, 2]))) for _ in range(150)})
    prints += [p ^ 1 << 40 for p in prints[:40]] + [p ^ 7 << 50 for p in prints[40:60]]
    rows = [(p - (1 << 64) if p >> 63 else p,) for p in sorted(set(prints))]
    classes = spark.createDataFrame(rows, "fp long").repartition(3)
    want = plain_components([(i, p & (2**64 - 1)) for i, (p,) in enumerate(rows)])
    for crowd in (16, 1 << 14):
        roots = {r.node: r.root for r in components(simhash.links(classes, crowd)).collect()}
        groups = {}
        for i, p, least in want:
            groups.setdefault(least, []).append(roots.get(rows[i][0], rows[i][0]))
        assert all(len(set(g)) == 1 for g in groups.values()) and len({g[0] for g in groups.values()}) == len(groups)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 200 + i) for i in range(30)] + [(500, 229)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star + [(7, 7)], "u long, v long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in (100, 215, 500)} == {100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_of_each_group_stays(odd, none):
    kept = simhash.keep_one(odd)
    rows = kept.collect()
    want = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in odd.collect()])
    assert kept.columns == odd.columns and len(rows) == len({c for _, _, c in want})
    assert {r.doc_id for r in rows} == {c for _, _, c in want}
    assert simhash.keep_one(none).count() == 0


# Nearest neighbours -----------------------------------------------------------


def plain_nearest(rows, k=10):
    best = {}
    for r in rows:
        v = r.embedding
        if r.vec_id is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        best[(r.vec_id, len(v))] = min(best.get((r.vec_id, len(v)), list(v)), list(v))
    for (q, n), v in best.items():
        if q % 100 == 0:
            far = sorted(
                (float(vptree.distances(np.array([v], float), np.array([w], float))[0, 0]), c)
                for (c, m), w in best.items() if m == n and c != q
            )
            yield from ((q, i + 1, c, d) for i, (d, c) in enumerate(far[:k]))


@pytest.mark.parametrize("shard, block", [(8192, 2048), (37, 2)])
def test_nearest_is_exact_at_factor_one(spark, shard, block):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=6).round(1).tolist()) for i in rng.permutation(450)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(60)]
    rows += [(2000, None), (2100, []), (2200, [0.0] * 6), (2300, [float("nan")] + [1.0] * 5), (2400, [None] * 6), (None, [1.0] * 6)]
    rows += [(2500, [1.0, 2.0]), (2501, [1.0, 3.0]), (100, rows[0][1]), (7, [9.0] * 6), (7, [9.0] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = vptree.nearest(table, shard=shard, block=block)
    assert as_set(map(tuple, got.collect())) == as_set(plain_nearest(table.collect()))


def test_relaxed_search_keeps_most(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 8)) * 6
    vectors = np.concatenate([c + rng.normal(size=(60, 8)) for c in centres])
    ids = np.arange(len(vectors))
    tree, asked = vptree.Tree(vectors), np.flatnonzero(ids % 100 == 0)

    def search(relax):
        return vptree.Search(tree, ids, vectors[asked], ids[asked], 10, np.full(len(asked), np.inf), relax)

    exact, relaxed = search(1.0), search(1.5)
    assert relaxed.compared < exact.compared < len(asked) * len(ids) / 2
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(exact.who, relaxed.who)]) >= 0.9


def test_one_tree_per_shard_and_bounds_carried(monkeypatch):
    """Shards pass through a task one by one, queries in small blocks and batches; nothing is built twice."""
    rng, built, offered = np.random.default_rng(8), [], []
    ids = np.arange(900)
    vectors = rng.normal(size=(900, 5)).round(1)
    asked = np.flatnonzero(ids % 100 == 0)
    rows = []
    for shard in range(3):
        rows += [(5, shard, False, int(i), vectors[i].tolist()) for i in ids[ids % 3 == shard]]
        rows += [(5, shard, True, int(i), vectors[i].tolist()) for i in asked]
    table = pa.Table.from_arrays(
        [pa.array(c) for c in zip(*rows)], names=["width", "shard", "asked", "vec_id", "vector"]
    )
    tree = vptree.Tree
    monkeypatch.setattr(vptree, "Tree", lambda v: built.append(len(v)) or tree(v))
    for batch in vptree._search({}, 10, 1.0, 4)(iter(table.to_batches(max_chunksize=37))):
        offered += zip(*[c.to_pylist() for c in batch.columns])
    assert built == [300, 300, 300]
    # Later shards report what is no farther than the bound that the first one left.
    assert len(offered) < 3 * 10 * len(asked)
    for q in asked.tolist():
        far = sorted((float(vptree.distances(vectors[[q]], vectors[[i]])[0, 0]), int(i)) for i in ids if i != q)[:10]
        assert sorted((s, i) for a, i, s in offered if a == q)[:10] == far


def test_vectors_are_shuffled_once_and_not_copied(spark, plan_of):
    rows = [(i, [float(i % 7), float(i % 11), 1.0], 3, "s", 1, True) for i in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, width int, shard string, block int, asked boolean")
    found = vptree.nearest(table.withColumn("vector", F.lit(1)), shard=50, block=2)
    assert found.count() == 30
    physical = plan_of(found).split("== Physical Plan ==")[1]
    below = physical[physical.index("MapInArrow"):]
    held, sent = below[below.index("Union"):].split("Generate", 1)
    assert "Exchange" not in held and below.split("Union")[0].count("Exchange") == 1


def test_no_vectors(spark):
    assert vptree.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# Mixing -----------------------------------------------------------------------


def test_mixing_on_odd_rows(spark, odd, none):
    rows = mixing.mixed(odd, ["doc_id", "source"]).collect()
    total = sum(r.size for r in rows)
    assert len(rows) == odd.count() and total == sum(len(WORD.findall(r.text or "")) for r in odd.collect())
    assert all(r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0 for r in rows)
    assert abs(sum({r.source: r.target for r in rows}.values()) - total) < 1e-6 * total
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mixed(odd.repartition(2), ["doc_id", "source"]).collect()))
    assert mixing.mixed(none, ["doc_id"]).count() == 0 and mixing.mix(none).count() == 0
    mix = mixing.mix(odd)
    assert mix.columns == odd.columns and mix.count() == sum(r.taken // r.size for r in rows if r.size)


def test_mixing_against_sql(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.choice([1, 5, 30, 200])), rng.choice(["b", "a", "é", None, "c"]) if i > 300 else "hot") for i in range(900)]
    rows += [(2000, "x " * 40, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(docs, ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken").collect()
    db = duckdb.connect()
    db.register("documents", docs.toPandas())
    want = db.sql(f"SELECT doc_id, size, source_size, target, taken FROM ({ORACLE['op5_mixing']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    taken = {}
    for r, (_, _, source) in zip(sorted(got), sorted(rows)):
        taken.setdefault((source, r.target), []).append(r.taken)
    assert all(abs(sum(t) - target) <= 0.05 * target + 100 for (_, target), t in taken.items())


# Toxicity ---------------------------------------------------------------------


def test_toxicity_held_out(spark, odd):
    rng = random.Random(9)
    plain, bad = [f"calm{i}" for i in range(80)], ["scum", "moron", "idiot", "wretchone", "wretchtwo", "wretchfour"]
    rows, labels = [], []
    for i in range(1500):
        own = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic = i % 6 == 0
        for _ in range(rng.randint(2, 5) if toxic else 0):
            own.insert(rng.randrange(len(own)), rng.choice(bad) + rng.choice(["", "!", ","]))
        rows.append((i, " ".join(own)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows + [(5000, None), (5001, ""), (None, "calm1"), (3, rows[3][1])], "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1), (9, None), (12, 1)], "doc_id long, toxic int")
    got = toxicity.scored(docs, marks, ["doc_id"]).collect()
    held = [(r.score, r.predicted, labels[r.doc_id][1]) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1500]
    assert len(got) == len(rows) + 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert {r.held_out for r in got if r.doc_id == 3} == {(__import__("zlib").crc32(b"3") % 3) == 1}
    hit = [p for _, p, y in held if y]
    clean = [p for _, p, y in held if not y]
    assert np.mean(hit) > 0.95 and np.mean(clean) < 0.02


def test_toxicity_of_few_labels_and_odd_rows(spark, odd):
    """One row of either kind, very long texts, columns named like the operator's own."""
    marks = spark.createDataFrame([(0, 1), (2, 0), (3, 0), (5, 1)], "doc_id long, toxic int").withColumn("_y", F.lit("x"))
    docs = odd.withColumns({"held_out": F.lit(1), "features": F.lit("f"), "_part": F.lit(7), "_e": F.lit(1)})
    got = toxicity.scored(docs, marks, ["doc_id"])
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == odd.count()
    assert got.where(~F.col("score").between(0, 1)).count() == 0


def test_toxicity_without_labels(spark, odd, none):
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.scored(odd, marks, ["doc_id"])
    assert got.count() == odd.count() and got.where(F.col("score") != 0).count() == 0
    assert toxicity.scored(none, marks, ["doc_id"]).count() == 0


# The pipeline -----------------------------------------------------------------
