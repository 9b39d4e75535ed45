"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from volspark.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, score string, rank string, list int, vec string, ids string"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], "", "", 0, "", "") for i, v in rows], SCHEMA)


def brute(rows, k, every):
    good = {}
    for i, v in rows:
        if i is None or v is None or len(v) != 8 or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good.setdefault(i, np.array(v, np.float32).astype(float))
    ids = sorted(good)
    data = np.array([good[i] for i in ids])
    out = {}
    for q in (i for i in ids if i % every == 0):
        s = neighbours.cosine(good[q], data)
        out[q] = sorted((-x, i) for x, i in zip(s, ids) if i != q)[:k]
    return out


def clustered(n, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, 8)) * 3
    return [(i, (centres[rng.integers(20)] + rng.normal(size=8)).tolist()) for i in range(n)]


def test_recall_and_scores(spark):
    rows = clustered(4000)
    got = {}
    for r in neighbours.search(table_of(spark, rows), "id % 50 = 0").collect():
        got.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    want = brute(rows, 5, 50)
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == [1, 2, 3, 4, 5]
        assert [f[1:] for f in found] == sorted(f[1:] for f in found)
        hits += len({f[2] for f in found} & {i for _, i in want[q]})
    assert hits / (5 * len(want)) >= 0.9


def test_copies_ties_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_CHUNK", 8)
    rows = clustered(60, 3) + [(i, [1.0, 2, 3, 4, 5, 6, 7, 8]) for i in range(100, 400)]
    rows += [(500, None), (550, [0.0] * 8), (600, [float("nan")] * 8), (650, [1.0, None] * 4), (700, [float("inf")] * 8),
             (None, [1.0] * 8), (750, [1.0, 2.0]), (800, []), (850, [2.0, 4, 6, 8, 10, 12, 14, 16]), (0, rows[0][1])]
    got = {}
    for r in neighbours.search(table_of(spark, rows), "id % 50 = 0").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows, 5, 50)
    assert set(got) == set(want)
    for q in want:
        assert [v for _, v, _ in sorted(got[q])] == [i for _, i in want[q]]
        assert [s for *_, s in sorted(got[q])] == pytest.approx([-s for s, _ in want[q]], abs=0)


def test_small_tables(spark):
    assert neighbours.search(table_of(spark, []), "id % 50 = 0").count() == 0
    assert neighbours.search(table_of(spark, [(50, [1.0, 2.0])]), "id % 50 = 0").count() == 0
    few = neighbours.search(table_of(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]), "id % 50 = 0").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in few] == [(0, 1, 2), (0, 2, 1)]


def test_recall_holds_with_many_lists(spark, monkeypatch):
    """Vectors without clusters in 64 dimensions, in 1,250 lists."""
    monkeypatch.setattr(neighbours, "LIST_LENGTH", 16)
    data = np.random.default_rng(7).normal(size=(20_000, 64)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.search(rows, "id % 50 = 0").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    own, hits = neighbours.unit(data.astype(float)), 0
    for q in range(0, len(data), 50):
        scores = own @ own[q]
        scores[q] = -2
        hits += len(got[q] & set(np.argsort(-scores)[:5].tolist()))
    assert hits / (5 * len(got)) >= 0.95


def test_vectors_of_any_magnitude(spark):
    """Squares of these components leave the range of a double."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 4))
    scales = [10.0 ** rng.choice([-300, -200, 0, 200, 300]) for _ in base]
    rows = [(i, (v * s).tolist()) for i, (v, s) in enumerate(zip(base, scales))]
    rows += [(100, [1e-200, 0.0, 0.0, 0.0]), (101, [1e200, 0.0, 0.0, 0.0]), (102, [1e200, 1e200, 0.0, 0.0]), (150, [5e-324, 0.0, 0.0, 0.0])]
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(table, "id % 50 = 0").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    lengths = {i: np.array(v) / np.abs(v).max() for i, v in rows}
    units = {i: v / np.sqrt((v * v).sum()) for i, v in lengths.items()}
    for q in (0, 50, 100, 150):
        want = sorted((-float(units[q] @ units[i]), i) for i in units if i != q)[:5]
        assert np.allclose([s for _, s in got[q]], [-s for s, _ in want], atol=1e-12)
    assert neighbours.cosine(np.array([1e-200, 0.0]), np.array([[1e200, 1e200]]))[0] == pytest.approx(0.5**0.5, abs=1e-15)
