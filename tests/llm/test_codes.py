import hashlib
import math

import numpy as np
import pytest

from marketgrain.llm import op13_gnat_codes as gnat


def nearest(book, v):
    return min((sum((a - b) ** 2 for a, b in zip(v, w, strict=True)), i) for i, w in enumerate(book))


def brute(rows, entries=256, rounds=4):
    """(vec_id, code, error, label_error, sha) of rows (vec_id, vector, label) of one size."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    size = len(kept[0][1])
    cut = gnat.cuts(size)
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[v[p] for _, v, _ in kept[:entries]] for p in cut]
    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(nearest(book, v[cut[p]])[1], []).append(v[cut[p]])
            books[p] = [[sum(c) // len(c) for c in zip(*groups[e], strict=True)] if e in groups else old for e, old in enumerate(book)]
    sha = hashlib.sha256(",".join(str(x) for b in books for w in b for x in w).encode()).hexdigest()
    found, total = [], {}
    for i, v, label in kept:
        near = [nearest(b, v[c]) for b, c in zip(books, cut, strict=True)]
        error = sum(d for d, _ in near)
        total[label] = total.get(label, 0) + error
        found.append((i, "".join(f"{e:02x}" for _, e in near), error, label))
    return sorted(((i, c, e, total[label], sha) for i, c, e, label in found), key=str)


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 1.5) for i, v, lab in rows], "vec_id bigint, embedding array<double>, label int, code string, error double")


@pytest.mark.parametrize("entries,rounds", [(256, 4), (40, 2), (1, 1)])
def test_equals_brute_force(spark, entries, rounds):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=8).round(2).tolist(), int(i) % 5) for i in rng.permutation(500)]
    rows += [(1000 + i, rows[0][1], None) for i in range(100)]  # repeated vectors, null labels
    rows += [(3, [0.5] * 8, 1), (3, [0.25] * 8, 1), (None, [1.0] * 8, None)]
    rows += [(5, None, 1), (6, [1.0, None] + [0.0] * 6, 1), (7, [float("nan")] + [0.0] * 7, 1), (8, [float("-inf")] + [0.0] * 7, None)]
    found = gnat.codes(frame_of(spark, rows).repartition(5), entries, rounds).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, entries, rounds)


def test_ties_go_to_the_lower_entry():
    x = np.array([[0.0, 0.0]] * 40 + [[2.0, 0.0]] * 40 + [[float(i), 9.0] for i in range(40)])
    search = gnat.Search(x, gnat.build(x, np.arange(len(x)), 4, 3))
    entry, near = search(np.array([[0.0, 0.0], [1.0, 0.0], [2.0, 0.0], [7.5, 9.0]]))
    assert entry.tolist() == [0, 0, 40, 87] and near.tolist() == [0, 1, 0, 0.25]


@pytest.mark.parametrize("scale", [3.0, 1000.0, 1e9, 1e14])
def test_search_is_exact_at_any_size(scale):
    rng = np.random.default_rng(8)
    x, q = (np.floor(rng.normal(size=(n, 3)) * scale) for n in (200, 300))
    if not gnat.exact(np.concatenate([x, q]), 3):
        x, q = gnat.as_integers(x), gnat.as_integers(q)
    entry, near = gnat.Search(x, gnat.build(x, np.arange(200), 5, 6))(q)
    for i, v in enumerate(q.tolist()):
        best = min((sum((int(a) - int(b)) ** 2 for a, b in zip(v, w, strict=True)), e) for e, w in enumerate(x.tolist()))
        assert (int(near[i]), entry[i]) == best


def test_subtrees_are_left_out():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(16, 8)) * 5000
    x = np.floor(np.repeat(centres, 16, axis=0) + rng.normal(size=(256, 8)) * 50)
    search = gnat.Search(x, gnat.build(x, np.arange(256)))
    q = np.floor(centres[rng.integers(0, 16, 2000)] + rng.normal(size=(2000, 8)) * 50)
    entry, near = search(q)
    full = gnat.squared(q, x)
    assert (entry == full.argmin(axis=1)).all() and (near == full.min(axis=1)).all()
    assert search.compared < 0.3 * full.size


def test_far_components_and_sizes(spark):
    rows = [(i, [1e12 * i, 1.0, -3.0e5, 0.5 * i], i % 2) for i in range(60)] + [(100 + i, [float(i), -1.0], 7) for i in range(5)]
    rows = [(i, [x / 3e8 for x in v] if len(v) == 4 else v, lab) for i, v, lab in rows] + [(200, [], 9), (201, [], 9)]
    found = {r["vec_id"]: tuple(r) for r in gnat.codes(frame_of(spark, rows), 16, 2).collect()}
    for part in (rows[:60], rows[60:65], rows[65:]):
        for row in brute(part, 16, 2):
            assert found[row[0]] == row


def test_empty(spark):
    assert gnat.codes(frame_of(spark, [])).collect() == []
    assert gnat.codes(frame_of(spark, [(1, None, 1)])).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError, match="256"):
        gnat.codes(frame_of(spark, []), 257)
