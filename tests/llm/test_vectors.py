"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gamegrain.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((12, 24))
    x = (centres[rng.integers(0, 12, 3000)] + 0.6 * rng.standard_normal((3000, 24))) * rng.uniform(0.5, 2, (3000, 1))
    x[:300] = x[0]
    rows = [(i, v.astype(np.float32).tolist(), 1, "s") for i, v in enumerate(x)]
    odd = [(5000, None, 1, ""), (5020, [0.0] * 24, 1, ""), (5040, [float("nan")] + [1.0] * 23, 1, ""), (5060, [None] + [1.0] * 23, 1, ""),
           (5080, [float("inf")] + [1.0] * 23, 1, ""), (5100, [1.0], 1, ""), (None, [1.0] * 24, 1, "")]
    return rows + odd + rows[:3]


def brute(rows, k):
    good = {r[0]: r[1] for r in rows if r[0] is not None and r[0] < 5000}
    ids = np.array(list(good))
    x = np.array([good[i] for i in ids], np.float32).astype(np.float64)
    out = {}
    for i in ids[ids % 20 == 0]:
        scores = (x * x[ids == i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
        out[int(i)] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def test_recall_and_order(spark, rows):
    out = vectors.nearest(spark.createDataFrame(rows, SCHEMA).repartition(3), 20, F.col("vec_id") % 20 == 0).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    want = brute(rows, 20)
    assert set(found) == set(want) and all(len(v) == 20 for v in found.values())
    assert all(v == sorted(v, key=lambda p: (-p[1], p[0])) for v in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    assert found[0] == want[0]


def test_few_and_none(spark, rows):
    few = spark.createDataFrame(rows[290:305] + rows[3000:], SCHEMA)
    out = vectors.nearest(few, 20, F.col("vec_id") % 20 == 0).collect()
    want = brute(rows[290:305] + rows[3000:], 20)
    assert {(r.query_id, r.rank, r.vec_id) for r in out} == {(q, n, i) for q, v in want.items() for n, (i, _) in enumerate(v, 1)}
    assert vectors.nearest(spark.createDataFrame(rows[3000:3006], SCHEMA), 20, F.col("vec_id") % 20 == 0).count() == 0


def test_abandons_only_far_rows():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((500, 65))
    distance = ((x - x[0]) ** 2).sum(axis=1)
    reach = np.sort(distance)[20]
    of, kept = vectors.abandon(x, x[[0, 0]], np.array([reach, np.inf]))
    assert set(kept[of == 0]) <= set(np.nonzero(distance <= reach * 1.01)[0]) and (of == 0).sum() >= 19
    assert sorted(kept[of == 1]) == list(range(500))


def test_recall_does_not_fall_with_the_number_of_lists(spark, monkeypatch):
    monkeypatch.setattr(vectors, "ROUNDS", (1, 3))
    rng = np.random.default_rng(9)
    x = rng.standard_normal((10, 48))[rng.integers(0, 10, 6000)] + 1.5 * rng.standard_normal((6000, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    many = [(i, v.astype(np.float32).tolist(), 1, "s") for i, v in enumerate(x)]
    data = {i: v for i, v, *_ in many}
    x = np.array([data[i] for i in range(6000)], np.float32).astype(np.float64)
    out = vectors.nearest(spark.createDataFrame(many, SCHEMA), 20, F.col("vec_id") % 40 == 0).collect()
    hits = 0
    for query in range(0, 6000, 40):
        scores = x @ x[query]
        scores[query] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & {r.vec_id for r in out if r.query_id == query})
    assert hits >= 0.9 * 20 * 150
