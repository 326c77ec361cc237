import collections
import hashlib
import random

import numpy as np
import pytest

from marketgrain.llm import op12_line_cuckoo as cuckoo

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(texts, limit, min_chars=1, over=None):
    texts = [t or "" for t in texts]
    seen = collections.Counter()
    for text in texts if over is None else over:
        seen.update({key(line) for line in (text or "").split("\n")})
    out = []
    for text in texts:
        lines = text.split("\n")
        kept = [x for x in lines if len(key(x)) < max(min_chars, 1) or seen[key(x)] < limit]
        out.append((len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return out


def some_texts(seed, n=300):
    rng = random.Random(seed)
    lines = [f"line {i}" for i in range(200)] + ["", " ", "É", "é", "日本", "\r", "Same line ", " SAME LINE\t", "same line\r", "a\x0bb", "x"]
    texts = ["\n".join(rng.choices(lines, k=rng.randrange(0, 12))) for _ in range(n)]
    return [*texts, None, "", "\n", "\n\n", "long " * 600_000, "a\n" * 50_000, *["copy\nof this"] * 60]


def found_of(index, docs, **more):
    return sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in index.report(docs, **more).collect())


@pytest.mark.parametrize("sent", [cuckoo.SENT_BYTES, -1])
@pytest.mark.parametrize("limit,chars", [(10, 1), (3, 2)])
def test_equals_brute_force(spark, docs, limit, chars, sent):
    texts = some_texts(1)
    frame = docs(texts).repartition(6)
    index = cuckoo.LineIndex.empty(spark, limit, chars).insert(frame)
    wanted = brute(texts, limit, chars)
    assert found_of(index, frame, sent_bytes=sent) == [(i, *w[:3]) for i, w in enumerate(wanted)]
    clean = index.cleaned(frame, sent_bytes=sent)
    assert clean.columns == frame.columns
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == {i: None if t is None else wanted[i][3] for i, t in enumerate(texts)}
    assert {r["length"] for r in clean.select("length").collect()} == {2}


def test_deletion_undoes_insertion(spark, docs):
    first, more = some_texts(2, 150), some_texts(3, 250)
    a, b = docs(first), docs(more, [1000 + i for i in range(len(more))])
    start = cuckoo.LineIndex.empty(spark, 10).insert(a)
    both = start.insert(b)
    back = both.delete(b)
    assert found_of(both, a) == [(i, *w[:3]) for i, w in enumerate(brute(first, 10, over=first + more))]
    assert found_of(back, a) == found_of(start, a) == [(i, *w[:3]) for i, w in enumerate(brute(first, 10))]
    counts = lambda index: sorted(map(tuple, index.counts.collect()))
    assert counts(back) == counts(start)
    assert counts(back.delete(a)) == []
    with pytest.raises(Exception, match="never inserted"):
        start.delete(b)


def test_false_positives_are_listed(spark, docs):
    texts = [f"rare {i}" for i in range(120_000)] + [f"often {i % 30000}" for i in range(60_000)]
    index = cuckoo.LineIndex.empty(spark, 2).insert(docs(["\n".join(texts[i::499]) for i in range(499)]))
    wrong = index.filters.where("slots is null").count()
    assert 0 < wrong < 200
    asked = docs(["\n".join(f"rare {i}" for i in range(120_000)), "often 7\nrare 7"])
    assert [r[2] for r in found_of(index, asked)] == [0, 1]


def test_empty_and_odd(spark, docs, odd):
    none = docs([])
    index = cuckoo.LineIndex.empty(spark)
    assert index.insert(none).report(none).collect() == []
    assert index.report(docs(["a\nb"])).first()["n_dropped"] == 0
    assert index.insert(odd).report(odd).count() == odd.count()
    assert index.insert(odd).report(odd, sent_bytes=-1).count() == odd.count()


def test_filter_inserts_and_deletes():
    rng = np.random.default_rng(1)
    h1, h2 = (rng.integers(0, 2**63, 50_000, dtype=np.uint64) * np.uint64(2) for _ in range(2))
    made = cuckoo.Cuckoo.of(h1[:40_000], h2[:40_000])
    assert made.holds(h1[:40_000], h2[:40_000]).all()
    assert made.holds(h1[40_000:], h2[40_000:]).mean() < 0.001
    size = len(made.slots)
    made.delete(h1[:20_000], h2[:20_000])
    assert made.holds(h1[20_000:40_000], h2[20_000:40_000]).all()
    assert made.holds(h1[:20_000], h2[:20_000]).mean() < 0.001
    assert made.insert(h1[40_000:], h2[40_000:]) and len(made.slots) == size
    assert made.holds(h1[20_000:], h2[20_000:]).all()
    made.delete(h1[20_000:], h2[20_000:])
    assert not made.slots.any()
    small = cuckoo.Cuckoo.of_size(4)
    assert not small.insert(h1[:100], h2[:100])
