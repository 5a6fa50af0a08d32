"""Nearest neighbours by learned partitions: the exact parts against brute force,
the index by its recall."""

import math

import numpy as np
import pytest
from brute import SF_CHECK

from keelson.llm import learned_partitions as ann

SCHEMA = "vec_id long, embedding array<float>, `a.b` string, part int, vector int, of int"


def plain(rows, k=ann.K, every=100):
    """[(query, rank, id, distance)] by brute force over (id, vector) rows."""
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    good = list(dict.fromkeys((i, tuple(v)) for i, v in good))
    out = []
    for q, x in good:
        if q % every == 0:
            near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(x, v))), i) for i, v in good if i != q)[:k]
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2, 3) for i, v in rows], SCHEMA)


def run(spark, rows, k=ann.K, **fit):
    rows = ann.clean(rows)
    router = ann.fit(spark, rows, **fit)
    index = ann.build(spark, rows, router)
    found = ann.search(spark, index, index.filter("id % 100 = 0").select("id", "vector"), router, k)
    return router, [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()]


def same(got, expect):
    got, expect = sorted(got), sorted(expect)
    assert [g[:3] for g in got] == [e[:3] for e in expect]
    assert all(math.isclose(g[3], e[3], rel_tol=1e-12, abs_tol=1e-12) for g, e in zip(got, expect))


def test_odd_vectors_ties_and_repeated_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 3).astype(float).tolist()) for i in range(1, 260)]
    rows += [(100, [1.0, 2.0, 3.0]), (300, [1.0, 2.0, 3.0]), (301, [1.0, 2.0, 3.0]), (301, [1.0, 2.0, 3.0]), (0, [1e30, 0.0, 0.0]), (302, [1e-30, 0.0, 0.0])]
    rows += [(400 + i, [2.0, 2.0, 2.0]) for i in range(150)]
    odd = [(500, None), (600, []), (700, [0.0, 0.0, 0.0]), (800, [1.0, None, 0.0]), (900, [float("nan"), 1.0, 1.0]), (1000, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (1100, [1.0, 2.0])]
    df = frame(spark, rows + odd).repartition(4)
    _, got = run(spark, df)
    # one id with two vectors is two queries; ranks of the two are told apart by sorting
    stored = [(r["vec_id"], r["embedding"]) for r in df.collect() if r["embedding"] is None or len(r["embedding"]) != 2]
    same(got, plain(stored))
    _, few = run(spark, frame(spark, [(100, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0])]))
    same(few, plain([(100, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0])]))
    assert run(spark, frame(spark, [(100, [1.0, 0.0])]))[1] == []
    assert run(spark, frame(spark, [(100, [0.0, 0.0]), (1, None)]))[1] == []
    assert run(spark, df.limit(0))[1] == []


def clustered(n, seed=3, d=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(24, d)) * 2
    x = centres[rng.integers(0, 24, n)] + rng.normal(size=(n, d))
    x[: n // 3] = x[0]  # a third of all rows hold one vector
    return x.astype(np.float32)


def test_recall_with_a_hot_vector_and_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(ann, "TILE_BYTES", 300 * 16 * 8)
    x = clustered(9000)
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]).repartition(6)
    router, got = run(spark, df, max_sample=4096)
    assert router.n_parts > 4 and router.probes < router.n_parts
    by_query = {}
    for q, r, i, d in got:
        by_query.setdefault(q, []).append((r, i, d))
    x = x.astype(np.float64)
    hits = 0
    for q in range(0, 9000, 100):
        found = sorted(by_query[q])
        assert [r for r, _, _ in found] == list(range(1, 11))
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(d)), d))[:10]
        hits += len(set(best.tolist()) & {i for _, i, _ in found})
        assert all(math.isclose(d[i], s, rel_tol=1e-12, abs_tol=1e-12) for _, i, s in found)
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        if q < 3000:
            assert [i for _, i, _ in found] == best.tolist()  # ties at distance 0 to the smallest ids
    assert hits / (90 * 10) >= 0.9


def test_queries_short_of_neighbours_are_searched_everywhere(spark):
    x = clustered(3000)[1000:]
    df = ann.clean(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]))
    router = ann.fit(spark, df, max_sample=1600)
    router.probes = 1
    index = ann.build(spark, df, router)
    biggest = max(r["count"] for r in index.groupBy("part").count().collect())
    k = biggest + 50
    found = ann.search(spark, index, index.filter("id % 500 = 0").select("id", "vector"), router, k).collect()
    same([(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found], plain([(i, v.tolist()) for i, v in enumerate(x)], k, 500))


def test_balanced_parts_of_a_graph_with_blocks():
    rng = np.random.default_rng(5)
    x = (np.repeat(np.eye(8) * 9, 100, axis=0) + rng.normal(size=(800, 8))).astype(np.float64)
    near = ann.neighbours(x, np.arange(800), 8)
    part = ann.balanced_parts(near, 8)
    sizes = np.bincount(part, minlength=8)
    assert sizes.min() >= 95 and sizes.max() <= 105
    assert (part[near] == part[:, None]).mean() > 0.95


def test_router_gradient_fits_separable_parts():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, 6)) + np.repeat(np.eye(6)[:4] * 6, 500, axis=0)
    part = np.repeat(np.arange(4), 500)
    router = ann.train_router(x, np.eye(4, dtype=np.float32)[part])
    assert (router.best(x) == part).mean() > 0.97
    assert ann.probes_needed(router, x, 10, 0.95) <= 2


@pytest.mark.parametrize("sf", [SF_CHECK, "/root/testdata/sf0.1"])
def test_query_recall_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    got = ann.query(spark, sf).collect()
    queries = ids[ids % 100 == 0]
    assert len(got) == 10 * len(queries)
    found, hits = {(r["query_id"], r["vec_id"]): r["score"] for r in got}, 0
    for q in queries:
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        hits += sum((q, i) in found for i in best.tolist())
    assert hits / len(got) >= 0.9
