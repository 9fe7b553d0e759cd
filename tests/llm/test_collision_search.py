"""Collision counting against brute force, and on awkward vectors."""

import math
import random

import numpy as np
import pytest

from gridloom.llm import collision_search as cs

VECTORS = "vec_id long, embedding array<float>, label int, dim string, norm string, block int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", 1) for i, v in rows], VECTORS).repartition(4)


def brute(rows, nearest=20, every=20):
    """query -> [(vec_id, score)] by exact inner products."""
    held = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        v = np.float32(v).tolist()
        held[i] = min(held.get(i, v), v)
    out = {}
    for q in (i for i in held if i % every == 0):
        scores = [(-math.fsum(a * b for a, b in zip(held[q], v)), i) for i, v in held.items()
                  if i != q and len(v) == len(held[q])]
        out[q] = [(i, -s) for s, i in sorted(scores)[:nearest]]
    return out


def found(df, **kw):
    out = {}
    for r in cs.search(df, **kw).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_awkward_vectors(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(1, 30)]
    rows += [(0, None), (40, []), (60, [0.0] * 6), (80, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (100, [float("nan")] * 6),
             (120, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (140, [1.0, 2.0]), (141, [2.0, 1.0]), (160, [1.0] * 3),
             (180, [1.0] * 6), (181, [1.0] * 6), (182, [1.0] * 6), (200, [-3.0] * 6), (200, [-3.0] * 6), (220, [1e30] * 6),
             (240, [1e-30] * 6)]
    want = brute(rows)
    got = found(frame(spark, rows))
    assert set(got) == {q for q, w in want.items() if w}
    for q, w in got.items():
        assert len(w) == len(want[q])
        assert [s for _, s in w] == pytest.approx([s for _, s in want[q]], rel=1e-12)
    assert [i for i, _ in got[180]][1:3] == [181, 182]  # ties by id, after the largest vector
    assert found(frame(spark, rows).filter("false")) == {}
    assert found(frame(spark, [(20, [1.0, 0.0])])) == {}


@pytest.mark.parametrize("kind", ["random", "clustered", "lengths", "copies"])
def test_recall_over_several_waves(spark, kind, monkeypatch):
    rng = np.random.default_rng(7)
    n, d = 3000, 24
    x = rng.standard_normal((n, d))
    if kind == "clustered":
        x = x * 0.2 + rng.standard_normal((40, d))[rng.integers(0, 40, n)]
    if kind == "lengths":
        x *= rng.lognormal(0, 1, n)[:, None]
    if kind == "copies":
        x[rng.random(n) < 0.4] = x[0]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    monkeypatch.setattr(cs, "BLOCK_ROWS", 300)
    monkeypatch.setattr(cs, "BLOCK_QUERIES", 60)
    want, got = brute(rows), found(frame(spark, rows))
    assert all(len(w) == 20 for w in got.values()) and len(got) == 150
    assert all(s == pytest.approx(float(np.float32(x[q]).astype(float) @ np.float32(x[i]).astype(float)), rel=1e-9, abs=1e-9)
               for q, w in got.items() for i, s in w)
    if kind != "copies":
        assert recall(got, want) >= 0.95
    else:  # equal scores, so the ids of the ties decide
        assert recall(got, want) >= 0.95
        assert got[0] == [w for w in want[0]] or [i for i, _ in got[0]] == [i for i, _ in want[0]]


def test_recall_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    assert recall(found(frame(spark, rows)), brute(rows)) >= 0.9


def test_windows_are_counted_either_way():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((500, 10))
    index = cs.Index(np.arange(500), x, cs.norm(x).max())
    places = np.argsort(index.order, axis=1)
    for radius in (0.2, 0.8, 1.3, np.inf):
        low, high = index.windows(index.project(x[:5], cs.norm(x[:5])), np.full(5, radius))
        for k in range(5):
            hits = ((places >= low[k][:, None]) & (places < high[k][:, None])).sum(axis=0)
            assert np.array_equal(index.colliding(low[k], high[k]), np.flatnonzero(hits >= cs.THRESHOLD))


def test_threshold_bounds_the_miss():
    rng = np.random.default_rng(2)
    hits = rng.binomial(cs.PROJECTIONS, cs.COLLIDE, 200000)
    assert (hits < cs.THRESHOLD).mean() <= cs.MISS + 0.005 and (hits < cs.THRESHOLD + 1).mean() > cs.MISS
