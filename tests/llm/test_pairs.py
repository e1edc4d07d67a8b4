"""Exact top-k and near-duplicates against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import neardup, topk


def brute_top_k(rows, k, mod):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ok[i, tuple(int(np.floor(256 * float(x))) for x in v)] = 1
    out = []
    for q, a in ok:
        if q % mod == 0:
            found = {(-sum(x * y for x, y in zip(a, b)), c) for c, b in ok if c != q and len(b) == len(a)}
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("seed", range(2))
def test_top_k_is_exact(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in np.round(rng.normal(0, 1 + i % 3, 7), 1 + seed)]) for i in range(400)]
    rows += [(401, None), (402, [1.0, None] * 3 + [1.0]), (403, [float("nan")] * 7), (404, [float("inf")] * 7), (None, [1.0] * 7), (3, rows[3][1]), (405, [1.0, 2.0]), (450, [2.0, 2.0]), (451, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n2", F.lit("clash"))
    q = topk.quantised(df)
    got = sorted(tuple(r) for r in topk.top_k(q, q.filter(F.col("vec_id") % 50 == 0), 5).collect())
    assert got == brute_top_k(rows, 5, 50)


def test_top_k_in_query_blocks_and_of_nothing(spark, monkeypatch):
    for name, rows in (("TILE_ROWS", 3), ("RANGE_ROWS", 7), ("BLOCK_ROWS", 4), ("QUERY_ROWS", 2), ("SEED_ROWS", 6)):
        monkeypatch.setattr(topk, name, rows)
    rows = [(i, [float(i % 5), 1.0]) for i in range(60)]
    q = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = sorted(tuple(r) for r in topk.top_k(q, q.filter("vec_id % 6 = 0"), 4).collect())
    assert got == brute_top_k(rows, 4, 6)
    assert topk.top_k(q.limit(0), q.limit(0)).collect() == []


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        if w:
            sets.setdefault(i, []).append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))))
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            if any(100 * len(s & u) >= 85 * len(s | u) for s in sets[a] for u in sets[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in root}


def near_copies(seed, groups=12, size=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, 40, 150]))]
        for _ in range(rng.randrange(1, size)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((n, " ".join(own) if rng.random() < 0.5 else "  ".join(own).upper().replace("W", "w") + "\n"))
            n += 1
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_near_duplicates_match_brute_force(spark, seed):
    rows = near_copies(seed) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "One"), (0, near_copies(seed)[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rows", F.lit(1))
    want = brute_components(rows)
    got = neardup.labelled(df).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    left = neardup.deduplicated(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, c in want.items() if i == c)


def test_crowded_regions_lose_no_hub(spark, monkeypatch):
    """A hub whose copies are not linked with one another, in regions cut into small blocks."""
    monkeypatch.setattr(neardup, "BLOCK_DOCS", 200)
    monkeypatch.setattr(neardup, "OVERLAP", 20)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 500):
        own = list(base)
        at = rng.randrange(0, 195)
        own[at] = f"x{i}"
        rows.append((i, " ".join(own)))
    got = neardup.labelled(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}


def test_large_regions_test_every_pair(spark, monkeypatch):
    """Texts of one template, alike below the limit, and a few linked pairs that the order puts anywhere."""
    monkeypatch.setattr(neardup, "BLOCK_DOCS", 16)
    monkeypatch.setattr(neardup, "OVERLAP", 2)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(240)]
    rows = []
    for i in range(300):
        own = list(base)
        for at in rng.sample(range(4, 236, 5), 3):
            own[at] = f"x{i}n{at}"
        rows.append((i, own))
    for i in range(300, 400):
        own = list(rows[i - 300][1])
        for at in rng.sample(range(4, 236, 5), 3):
            own[at] = f"y{i}n{at}"
        rows.append((i, own))
    rows = [(i, " ".join(own)) for i, own in rows]
    sets = neardup.shingle_sets([t.encode() for _, t in rows])
    root = list(range(len(rows)))
    for a, b in neardup.exact_links(sets):
        x, y = root[a], root[b]
        root = [min(x, y) if r in (x, y) else r for r in root]
    assert 250 < len(set(root)) < 400
    got = neardup.labelled(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(root))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "a long, b long")
    got = {r.doc_id: r.component for r in neardup.components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {99: 99, 100: 99}


def test_exact_links_and_signatures():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 200, rng.integers(1, 150)).astype(np.uint64)) for _ in range(60)]
    links = neardup.exact_links(sets, 50)
    root = list(range(60))
    find = lambda i: i if root[i] == i else find(root[i])
    for a, b in links:
        root[find(a)] = find(b)
    want = list(range(60))
    find2 = lambda i: i if want[i] == i else find2(want[i])
    for a in range(60):
        for b in range(a):
            k = len(np.intersect1d(sets[a], sets[b]))
            if 100 * k >= 50 * (len(sets[a]) + len(sets[b]) - k):
                want[find2(a)] = find2(b)
    assert {(find(a) == find(b)) == (find2(a) == find2(b)) for a in range(60) for b in range(60)} == {True}
    x = np.arange(2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    agree = (neardup.signature(x[:1000]) == neardup.signature(x[100:1100])).mean()
    assert abs(agree - 900 / 1100) < 0.15
