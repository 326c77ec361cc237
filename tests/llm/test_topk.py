import math

import numpy as np
import pytest

from marketgrain.llm import op2_pivot_topk as topk


def brute(rows, asked, k=10):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.setdefault(i, []).append([math.floor(1024 * x) for x in v])
    out = []
    for i in asked:
        for v in whole.get(i, [])[:1]:
            found = [(-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, ws in whole.items() if j != i for w in ws if len(w) == len(v)]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block,sample,pivots", [(4096, 2048, 32), (3, 16, 4), (5, 0, 1)])
def test_equals_brute_force(spark, block, sample, pivots):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(400)]
    rows[7] = (7, None)
    rows[8] = (8, [1.0, None, 0.0, 0.0, 0.0, 0.0])
    rows[9] = (9, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0])
    rows[10] = (10, [1.0, float("inf"), 0.0, 0.0, 0.0, 0.0])
    for i in range(100, 260):  # a group of equal vectors
        rows[i] = (i, rows[100][1])
    rows += [(500 + i, rng.normal(size=3).tolist()) for i in range(5)] + [(600, []), (620, []), (None, [1.0] * 6)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<double>, rank int, score string").repartition(5)
    asked = [i for i, _ in rows if i is not None and i % 20 == 0]
    found = topk.top_k(frame, frame.where("vec_id % 20 = 0"), block=block, sample=sample, pivots=pivots)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, asked)


def test_empty(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.top_k(none, none).collect() == []


def test_bounds_skip_far_vectors():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 8)) * 2000
    x = np.floor(np.repeat(centres, 200, axis=0) + rng.normal(size=(4000, 8)) * 30)
    pivots = topk.choose_pivots(x[::10], 20)
    queries = {"id": np.array([0]), "x": x[:1], "norm": topk.norms(x[:1]), "pivots": pivots, "table": topk.distances(x[:1], pivots)}
    best = topk.Best(1, 10, np.array([topk.NO_SCORE]))
    assert topk.visit(best, queries, x, np.arange(len(x))) < len(x) / 2
    scores = (x @ x[0]).astype(np.int64)
    scores[0] = topk.NO_SCORE
    assert best.ids[0].tolist() == np.lexsort((np.arange(len(x)), -scores))[:10].tolist()
