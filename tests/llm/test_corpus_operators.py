"""Centroid clustering, source divergence and embedding near-duplicates against plain loops."""
import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql.types import (ArrayType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField,
                               StructType)

from dossier.llm import clustering, divergence, embeddings
from tests.llm.fixtures import awkward_texts

NAN, INF = float("nan"), float("inf")
CLASHING = ("tile", "block", "cluster", "c", "v", "key", "dim", "digest", "cell", "at")
GROUPS = StructType([StructField(c, StringType()) for c in ("text", "lang", "source", "term", "n", "p", "a", "docs")])


def vectors(spark, rows, kind=None):
    schema = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(kind or DoubleType())),
                         StructField("label", IntegerType()), *[StructField(c, StringType()) for c in CLASHING]])
    return spark.createDataFrame([(i, x, 0, *["z"] * len(CLASHING)) for i, x in rows], schema)


def points(rng, n, dim, centres=5):
    at = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(centres)]
    return [[a + rng.gauss(0, .1) for a in rng.choice(at)] for _ in range(n)]


def plain_lloyd(rows, k, rounds, dim, seed):
    kept = [(i, [math.floor(1024 * a) for a in x]) for i, x in rows
            if x is not None and len(x) == dim and all(a is not None and math.isfinite(a) for a in x)]
    digest = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [x for _, x in sorted((digest(i), x) for i, x in kept)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, x in kept:
            members[nearest(x)[1]].append(x)
        for j, xs in members.items():
            centroids[j] = [sum(col) // len(xs) for col in zip(*xs)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    inertia = Counter()
    for _, j, d in found:
        inertia[j] += d
    return Counter((i, j, d, inertia[j], sum(inertia.values()),
                    hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, j, d in found)


@pytest.mark.parametrize("dim,k,n", [(5, 3, 60), (37, 8, 300), (1, 4, 20), (5, 9, 4)])
def test_lloyd(spark, dim, k, n):
    rng = random.Random(dim)
    rows = list(enumerate(points(rng, n, dim)))
    rows += [(None, rows[0][1]), (None, rows[1][1]), (2, rows[2][1]), (2, rows[3][1])]
    rows += [(900, None), (901, []), (902, [1.0] * (dim + 1)), (903, [None] + [0.0] * (dim - 1)),
             (904, [NAN] * dim), (905, [0.0] * (dim - 1) + [-INF])]
    got = clustering.lloyd(vectors(spark, rows).repartition(3), k, 4, dim, "s")
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, got.collect())) == plain_lloyd(rows, k, 4, dim, "s")


def test_lloyd_ties_copies_and_empty_clusters(spark):
    rows = [(i, [0.5, -0.25, 0.0]) for i in range(40)] + [(99, [9.0, 9.0, 9.0]), (98, [-0.5, -0.25, 0.0])]
    got = clustering.lloyd(vectors(spark, rows, FloatType()), 6, 3, 3)
    assert Counter(map(tuple, got.collect())) == plain_lloyd(rows, 6, 3, 3, "3")


def test_lloyd_many_tiles(spark):
    rows = list(enumerate(points(random.Random(3), 150, 8)))
    got = clustering.lloyd(vectors(spark, rows).repartition(5), 4, 5, 8, columns=3, tile_rows=7)
    assert Counter(map(tuple, got.collect())) == plain_lloyd(rows, 4, 5, 8, "3")


def test_lloyd_ends_of_the_range_and_no_rows(spark):
    rows = [(0, [1e30, -1e30]), (1, [1e300, 0.0]), (2, [0.0, 0.0])]
    got = {r.vec_id: r for r in clustering.lloyd(vectors(spark, rows), 2, 2, 2).collect()}
    assert set(got) == {0, 1, 2} and all(0 <= r.distance < 1 << 63 for r in got.values())
    assert clustering.lloyd(vectors(spark, []), 8, 2, 2).collect() == []


def plain_divergence(rows, min_docs, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}
    docs = [(lang or "", source or "", Counter(term.findall((text or "").translate(lower)))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        df, total, sources = Counter(), Counter(), defaultdict(Counter)
        for _, source, terms in (d for d in docs if d[0] == lang):
            df.update(terms.keys())
            sources[source].update(terms)
        kept = [t for t in df if df[t] >= min_docs]
        for s in sources.values():
            total.update({t: s[t] for t in kept if s[t]})

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + math.floor(Fraction(10 ** 9 * (count[t] + 2), n + 2 * len(kept))) for t in kept}
        apart = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: shares(c) for s, c in sources.items()}, shares(total)
        for s in sources:
            parts = {"pair": [(-sum(apart(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s],
                     "term": [(-apart(p[s][t], q[t]), t.encode()) for t in kept if sources[s][t] and p[s][t] > q[t]]}
            for part, found in parts.items():
                for rank, (value, item) in enumerate(sorted(found), 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item.decode(), -value, rank))
    return out


def grouped(spark, rows):
    return spark.createDataFrame([(*r, *["z"] * 5) for r in rows], GROUPS)


@pytest.mark.parametrize("min_docs,small", [(1, False), (3, True), (10 ** 6, False)])
def test_divergence(spark, min_docs, small):
    slice_bytes = 64 if small else divergence.SLICE_BYTES  # many slices, and most texts in pieces
    rng = random.Random(min_docs)
    vocabulary = ["a", "ab", "abc", "Überlänge", "ß", "über", "neunzehnhundert", "neunzehnhunderteins", "日本語", "Z" * 70,
                  "Z" * 70 + "y", "Z" * 70 + "x" * 90, "stop", "STOP", "it's", "e1f2"]
    rows = [(" ".join(rng.choice(vocabulary[: 6 + 3 * (s % 4)]) for _ in range(rng.randrange(60))), lang, f"src{s % 5}")
            for s in range(60) for lang in ("en", "de")]
    rows += [(t, "xx", random.Random(len(t or "")).choice(["one", "two"])) for t in awkward_texts() if len(t or "") < 9000]
    rows += [(None, None, None), ("", "en", "silent"), ("only here " * 30, "zz", None), ("Äpfel\x00äpfel\tA_B", "en", "s\x00")]
    rows += [rows[0]] * 7
    got = divergence.source_divergence(grouped(spark, rows).repartition(3), min_docs, 4, slice_bytes=slice_bytes).collect()
    assert len(got) == len(set(got))
    assert set(map(tuple, got)) == plain_divergence(rows, min_docs, 4)


def test_divergence_of_hot_source_long_text_and_no_rows(spark):
    rows = [("common word " + "rare " * (i % 3), "en", "hot" if i % 3 else f"s{i}") for i in range(90)]
    rows += [("common " * 200_000 + "tail" * 1000, "en", "long")]
    got = divergence.source_divergence(grouped(spark, rows), 2, 10).collect()
    assert set(map(tuple, got)) == plain_divergence(rows, 2, 10)
    assert divergence.source_divergence(grouped(spark, [])).collect() == []


def test_sorted_terms():
    rng = random.Random(1)
    terms = [b"x" * rng.randrange(1, 200) + bytes(rng.choices(b"ab", k=rng.randrange(4))) for _ in range(500)]
    data = np.frombuffer(b" ".join(terms), np.uint8)
    lengths = np.array([len(t) for t in terms])
    starts = np.cumsum(lengths + 1) - lengths - 1
    order, begins = divergence.sorted_terms(data, starts, lengths)
    assert [terms[i] for i in order] == sorted(terms)
    assert begins.sum() == len(set(terms))


def plain_links(rows, linked=.95):
    units = []
    for _, x in rows:
        ok = x is not None and len(x) and all(a is not None and math.isfinite(a) for a in x) and any(x)
        big = max(map(abs, x)) if ok else 0
        norm = math.sqrt(math.fsum((a / big) ** 2 for a in x)) if ok else 0
        units.append([a / big / norm for a in x] if ok else None)
    linked_to = [[j for j, v in enumerate(units) if i != j and u and v and len(u) == len(v)
                  and math.fsum(a * b for a, b in zip(u, v)) >= linked] for i, u in enumerate(units)]
    low = list(range(len(rows)))
    comp = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in low:
            best = min([comp[i], *(comp[j] for j in linked_to[i])])
            changed |= best != comp[i]
            comp[i] = best
    least = defaultdict(list)
    for i, c in enumerate(comp):
        least[c] += [rows[i][0]] * (rows[i][0] is not None)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        component = min(least[comp[i]], default=None)
        out.append((vec_id, len(linked_to[i]), component, vec_id == component))
    return Counter(out)


def turned(rng, x, cosine):
    """A vector at this cosine from ``x``."""
    z = [rng.gauss(0, 1) for _ in x]
    xx, xz = sum(a * a for a in x), sum(a * b for a, b in zip(x, z))
    z = [b - a * xz / xx for a, b in zip(x, z)]
    nx, nz = math.sqrt(xx), math.sqrt(sum(b * b for b in z))
    return [a / nx * cosine + b / nz * math.sqrt(1 - cosine ** 2) for a, b in zip(x, z)]


def test_links_of_awkward_vectors(spark):
    rng = random.Random(5)
    base = [rng.gauss(0, 1) for _ in range(6)]
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(30)]
    rows += [(100, base), (101, base), (102, [2 * a for a in base]), (None, base), (103, turned(rng, base, .96)),
             (104, turned(rng, base, .9)), (105, [-a for a in base]), (106, base[:5]), (107, base[:5] + [0.0])]
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [NAN] + base[1:]), (204, [None] + base[1:]),
             (205, [INF] + base[1:]), (None, None), (206, [1e200 * a for a in base]), (207, [1e-200 * a for a in base])]
    rows += [(100, base), (3, base), (300, [5.0]), (301, [7.0]), (302, [-7.0])]
    got = embeddings.near_duplicate_vectors(vectors(spark, rows).repartition(4))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert Counter(map(tuple, got.collect())) == plain_links(rows)


@pytest.mark.parametrize("rows", [[], [(7, None)], [(7, [1.0, 2.0])], [(7, [1.0, 2.0]), (8, [1.0, 2.01])]])
def test_links_of_hardly_any_vectors(spark, rows):
    assert Counter(map(tuple, embeddings.near_duplicate_vectors(vectors(spark, rows)).collect())) == plain_links(rows)


def test_links_in_crowded_regions(spark, monkeypatch):
    """Balls, long lists cut into blocks, chains that leave a ball, and copies."""
    monkeypatch.setattr(embeddings, "CROWD", 24)
    monkeypatch.setattr(embeddings, "BLOCK", 10)
    rng = random.Random(9)
    hubs = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(3)]
    rows = []
    for hub in hubs:
        rows += [turned(rng, hub, rng.choice([.995, .98, .955, .93])) for _ in range(70)]
    rows += [turned(rng, rng.choice(rows), .951) for _ in range(60)] + [hubs[0]] * 30 + rows[:20]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    got = embeddings.near_duplicate_vectors(vectors(spark, rows).repartition(3)).collect()
    want = plain_links(rows)
    assert sum((Counter(map(tuple, got)) & want).values()) >= .98 * len(rows)
    found, links = sum(r.n_links for r in got), sum(k[1] * n for k, n in want.items())
    assert .98 * links <= found <= links


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold among vectors without any order: nine of ten at least, in fact nearly all."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1500, 64))
    pairs = [turned(random.Random(i), v.tolist(), .9501) for i, v in enumerate(x[:700])]
    rows = list(enumerate([*x.tolist(), *pairs]))
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicate_vectors(vectors(spark, rows)).collect()}
    assert sum(got[1500 + i] > 0 for i in range(700)) >= .985 * 700
    assert sum(got[i] for i in range(700, 1500)) == 0
