from __future__ import annotations

import numpy as np
from xxhash import xxh64_intdigest

from lodewatch.llm import simhash_vptree as v
from lodewatch.llm.components import components

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(points, radius=2):
    parent = list(range(len(points)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if (points[i] ^ points[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


def grouping(labels):
    first = {}
    return [first.setdefault(x, i) for i, x in enumerate(labels)]


def test_forest_equals_brute_force():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    near = base[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    ball = base[0] ^ np.zeros(400, np.uint64)
    for _ in range(4):
        ball = ball ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))
    points = np.unique(np.concatenate([base, near, near ^ np.uint64(6), ball]))
    want = grouping(plain_roots([int(p) for p in points]))
    assert grouping(v.linked(points, leaf=8).tolist()) == want
    assert grouping(v.linked(points).tolist()) == want
    parent = np.arange(len(points))
    v._dense(points, np.arange(len(points)), parent)
    assert grouping([v._root(parent, i) for i in range(len(points))]) == want


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 150)}, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def cases():
    rng = np.random.default_rng(2)
    rows = []
    for i in range(60):
        words = rng.choice(WORDS, 80).tolist()
        rows.append((i * 3, " ".join(words), "x"))
        if i % 3 == 0:  # copies with one word changed, in capitals, or exact
            rows.append((1000 - i, " ".join([*words[:-1], "other"]), "x"))
            rows.append((2000 - i, " ".join(words).upper(), "y"))
    return rows + [(5, None, "n"), (4, "", "n"), (None, "", "n"), (9, "Alpha\tbeta", "n"), (8, "alpha beta ", "n"), (8, "alpha beta ", "n"), (None, "one of a kind, without an id", "n"), (70, "nu " * 30_000, "n")]


def test_classes_equal_brute_force(spark):
    rows = cases()
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    points = [plain_fingerprint(t or "") for _, t, _ in rows]
    roots = plain_roots(points)
    least = {}
    for (i, _, _), r in zip(rows, roots):
        least[r] = i if least.get(r) is None else (least[r] if i is None else min(i, least[r]))
    want = sorted(((i, p if p < 2**63 else p - 2**64, least[r]) for (i, _, _), p, r in zip(rows, points, roots)), key=repr)
    for options in ({}, {"shard": 5, "sample": 80}):
        got = sorted((tuple(r) for r in v.near_classes(df, **options).collect()), key=repr)
        assert got == want
    kept = v.keep_one(df)
    assert kept.columns == df.columns and kept.count() == len(set(roots))
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=repr) == sorted(least.values(), key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert v.near_classes(df).count() == 0 and v.keep_one(df).count() == 0


def test_large_shards_are_divided_on_spark(spark):
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**63, 900, dtype=np.uint64)
    near = base[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    ball = base[0] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))
    pairs = (ball[:, None] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))[None, :]).ravel()[:600]
    points = np.unique(np.concatenate([base, near, ball, pairs]))
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    want = plain_roots([int(p) for p in points])
    at = {int(p): i for i, p in enumerate(points.view(np.int64))}

    small, dense = v.divided(df.selectExpr("0L as shard", "fp").cache(), 2, 200, 150)
    sizes = small.groupBy("round", "shard").count().collect()
    assert len(sizes) > 5 and max(r["count"] for r in sizes) <= 200
    held = {r["fp"] for r in small.collect()} | ({r["fp"] for r in dense.collect()} if dense is not None else set())
    assert held == set(at)
    for radius, shard in [(2, 50), (2, 20_000), (3, 50)]:
        parent = list(range(len(points)))

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for r in v.links(df, radius=radius, shard=shard, sample=200, leaf=16).collect():
            a, b = find(at[r["a"]]), find(at[r["b"]])
            parent[max(a, b)] = min(a, b)
        assert grouping([find(i) for i in range(len(points))]) == grouping(want if radius == 2 else plain_roots([int(p) for p in points], radius))


def test_dense_balls_by_shared_neighbours(spark):
    rng = np.random.default_rng(3)
    points = np.unique(np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 20, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 20, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)))
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    at = {int(p): i for i, p in enumerate(points.view(np.int64))}
    for edges in (v.shared_neighbours(df), v.links(df, shard=10, sample=100)):
        parent = np.arange(len(points))
        for r in edges.collect():
            v._join(parent, np.array([at[r["a"]]]), np.array([at[r["b"]]]))
        assert grouping([v._root(parent, i) for i in range(len(points))]) == grouping(plain_roots([int(p) for p in points]))
