import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from marketgrain.llm import graph
from marketgrain.llm import op3_prob_minhash as near

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def brute(rows):
    """class id per (id, text) row."""
    own = {i: sets(t) for i, t in rows}
    parent = {i: i for i in own}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(own)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(own[i] & own[j])
            if both and both >= 0.8 * (len(own[i]) + len(own[j]) - both):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def text(rng, n):
    return " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 300)) for _ in range(n))


def edited(rng, base, times):
    words = base.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = "x" + str(rng.randint(0, 10**6))
    return " ".join(words)


def test_equals_brute_force(docs):
    rng = random.Random(5)
    texts = [text(rng, rng.randint(1, 150)) for _ in range(60)]
    texts += [edited(rng, t, 1) for t in texts[:30]] + [edited(rng, t, 6) for t in texts[:30]] + texts[:10]
    hub = text(rng, 100)  # copies are near the hub, but hardly to one another
    texts += [hub] + [edited(rng, hub, 2) for _ in range(60)]
    texts += [texts[0].upper(), texts[1].replace(" ", "\n\t"), "the same line again " * 40, "the same line again " * 41]
    frame = docs(texts).repartition(4)
    found = near.classes(frame).collect()
    want = brute(list(enumerate(texts)))
    assert {r["doc_id"]: r["class_id"] for r in found} == want
    kept = [r["doc_id"] for r in found if r["kept"]]
    assert sorted(kept) == sorted(set(want.values()))


def templated(rng, pages, pairs):
    """Pages of one template, alike below the threshold, and pairs of them above."""
    template = [text(rng, 33) for _ in range(6)]
    fill = lambda: ["u" + str(rng.randint(0, 10**9)) for _ in template]
    page = lambda own: " ".join(f"{t} {o}" for t, o in zip(template, own, strict=True))
    out = [fill() for _ in range(pages)]
    for own in out[:pairs]:
        other = fill()
        out.append(own[:2] + other[2:])
    return [page(own) for own in out]


def test_pairs_within_a_template(docs, monkeypatch):
    sketched = near.sketched  # all texts in one large bucket
    monkeypatch.setattr(near, "sketched", lambda d: sketched(d).withColumn("bands", F.expr("array(1L)")))
    rng = random.Random(8)
    texts = templated(rng, 80, 40)
    own = [sets(t) for t in texts]
    alike = lambda a, b: len(own[a] & own[b]) / len(own[a] | own[b])
    assert 0.7 < alike(60, 61) < 0.8 <= alike(0, 80)
    found = near.classes(docs(texts).repartition(4)).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == brute(list(enumerate(texts)))


def test_marks_bound_the_difference():
    rng = np.random.default_rng(3)
    base = rng.integers(1, 2**63, 6000).astype(np.uint64)
    groups = [base[:0], base[:1], base[:30], base[:400], base[100:500], base[40:440], base[:410], base[:1500], base]
    owner = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    marks = near.marks_of(owner, np.concatenate(groups), np.array([len(g) for g in groups]))
    apart = {}
    for i, a in enumerate(groups):
        for j, b in enumerate(groups):
            width = min(len(marks[i]), len(marks[j]))
            apart[i, j] = (near.folded(marks[i], width) ^ near.folded(marks[j], width)).bit_count()
            assert apart[i, j] <= len(np.setxor1d(a, b))
    assert apart[3, 3] == 0 and apart[3, 4] > 2 * 400 * 0.2 / 1.8  # 300 of 500 in common


def test_few_sets_are_sent(spark, docs):
    rng = random.Random(12)
    base = text(rng, 300)
    halfway = lambda: " ".join(base.split()[:270]) + " " + text(rng, 60)
    texts = [base] + [halfway() for _ in range(200)] + [edited(rng, base, 3) for _ in range(40)]
    own = [sets(t) for t in texts]
    assert all(0.5 < len(own[0] & s) / len(own[0] | s) < 0.8 for s in own[1:201])
    found = near.shingle_sets(docs(texts).withColumnRenamed("doc_id", "node"))
    pairs = spark.range(1, len(texts)).select(F.lit(0).cast("bigint").alias("a"), F.col("id").alias("b"))
    assert near.sent(found, pairs).count() < 80  # one of the leader, 40 near it, few others
    assert sorted(r["b"] for r in near.verified(found, pairs).collect()) == list(range(201, 241))


def test_texts_by_list_and_without(spark, docs, monkeypatch):
    texts = ["a b c d e f g", "A b c d e f g", "other words stand in here now", None, " ", "a b c d e f g"]
    frame = docs(texts, [0, 1, None, 3, 4, 0])
    prints = near.fingerprinted(frame.select("doc_id", "text")).where("print is not null").groupBy("print").agg(F.min("doc_id").alias("doc_id"))
    asked = prints.withColumn("node", F.when(F.col("doc_id").isNull(), 7).otherwise(5).cast("bigint"))
    want = [(5, texts[0]), (7, texts[2])]
    lower = lambda d: sorted((r["node"], r["text"].lower()) for r in d.collect())
    assert lower(near.texts_of(frame, asked)) == want
    assert lower(near.texts_of(frame, asked.where("node = 7"))) == want[1:]
    assert lower(near.texts_of(frame, asked.limit(0))) == []
    monkeypatch.setattr(near.common, "SMALL_BYTES", 0)
    assert lower(near.texts_of(frame, asked)) == want


def test_same_classes_when_no_list_is_small(docs, monkeypatch):
    monkeypatch.setattr(near.common, "SMALL_BYTES", 0)
    rng = random.Random(6)
    texts = [text(rng, 80) for _ in range(20)]
    texts += [edited(rng, t, 1) for t in texts[:10]] + texts[:4] + templated(rng, 20, 5)
    found = near.classes(docs(texts).repartition(3)).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == brute(list(enumerate(texts)))


def test_odd_rows(odd, docs):
    found = near.classes(odd).collect()
    assert len(found) == odd.count()
    by_id = defaultdict(list)
    for r in found:
        by_id[r["doc_id"]].append(r)
    assert all(r["kept"] for i in (0, 1, 2, 100) for r in by_id[i])
    assert [r["class_id"] for r in by_id[102]] == [102, 102]
    assert near.classes(docs([])).collect() == []


def test_registers_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    keys = rng.integers(1, 2**63, 600).astype(np.uint64)
    repeats = rng.integers(1, 4, 600)
    a = np.repeat(keys[:500], repeats[:500])
    b = np.repeat(keys[100:], repeats[100:])
    owner = np.r_[np.zeros(len(a), np.int64), np.ones(len(b), np.int64)]
    registers = near.sketch(owner, np.r_[a, b], 2, registers=4096)
    wa, wb = np.zeros(600), np.zeros(600)
    wa[:500], wb[100:] = 1 + np.log2(repeats[:500]), 1 + np.log2(repeats[100:])
    p, q = wa / wa.sum(), wb / wb.sum()
    want = sum(1 / np.maximum(p / p[i], q / q[i]).sum() for i in range(100, 500))
    assert abs((registers[0] == registers[1]).mean() - want) < 0.04
    one = near.sketch(np.zeros(1, np.int64), keys[:1], 3)
    assert (one[0] == keys[0]).all() and (one[1:] == 0).all()


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(40)] + [(500, 501 + i) for i in range(50)]
    found = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    assert found == {x: top(x) for x in parent}


def test_columns_of_the_caller_stay(docs):
    frame = docs(["a b c d e f", "A b c d e f", "other words stand in here", None, None]).withColumnsRenamed({"lang": "print", "source": "_id", "row": "_print", "length": "root"})
    left = near.deduplicated(frame)
    assert left.columns == frame.columns
    assert sorted(map(tuple, left.collect())) == sorted(map(tuple, frame.where("doc_id <> 1").collect()))
