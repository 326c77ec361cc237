import random

import numpy as np
import pyarrow as pa
import pytest

from marketgrain.llm import op9_latent_semantic as lsa


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("seed", range(30))
def test_common_subsequence(seed):
    rng = random.Random(seed)
    a = [rng.randint(0, 8) for _ in range(rng.randint(0, 40))]
    b = [rng.randint(0, 8) for _ in range(rng.randint(0, 30))]
    used = lsa.common_length(np.array(a, np.uint64), np.array(b, np.uint64))
    assert used.sum() == longest(a, b)
    kept = [y for y, u in zip(b, used, strict=True) if u]
    it = iter(a)
    assert all(x in it for x in kept)  # a subsequence of a too


def test_windows_cover_all_words():
    for n in (1, 40, 64, 65, 96, 97, 200, 1000):
        row = np.zeros(n, np.int64)
        window, term, times, count, _ = lsa.entries(row, np.arange(n), 1)
        assert set(term.tolist()) == set(range(n)) and times.max() == 1
        assert set(window.tolist()) == set(range(count[0]))
        for w in range(count[0]):
            own = term[window == w]
            assert own.min() == w * lsa.STEP and len(own) <= lsa.WINDOW
            assert own.max() == min(n, w * lsa.STEP + lsa.WINDOW) - 1


def words(rng, n):
    return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(n))


def test_finds_copies_and_paraphrases(docs, spark):
    rng = random.Random(9)
    items = [words(rng, rng.randint(15, 60)) for _ in range(30)] + [words(rng, 150)]
    plain = [words(rng, rng.randint(0, 400)) for _ in range(150)]
    texts, want = list(plain), set()
    for i, item in enumerate(items):
        own = item.split()
        variants = [item, item.upper().replace(" ", "*** "), " ".join(w for j, w in enumerate(own) if j % 7)]
        swapped = list(own)
        for j in range(2, len(own) - 2, 9):
            swapped[j] = "other"
        variants.append(" ".join(swapped))
        for v in variants:
            want.add((len(texts), i))
            texts.append(plain[i] + " " + v + " " + plain[i + 1])
    shuffled = items[3].split()
    rng.shuffle(shuffled)
    texts.append(" ".join(shuffled))
    texts += [None, "", "  ", "%%% 123"]
    benchmark = spark.createDataFrame([(i, t, 0.1) for i, t in enumerate([*items, None, "", "12 %"])], "item_id bigint, text string, cosine double")
    for block in (2000, 11):
        found = lsa.leaks(docs(texts).repartition(3), benchmark, block=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want
        assert len(found) == len(want)
        assert all(r["cover"] >= lsa.COVER for r in found)


def test_space_holds_the_items(docs, spark):
    rng = random.Random(2)
    items = lsa.Items(list(range(20)), [words(rng, 30) for _ in range(20)])
    items.keep(items.terms, np.ones(len(items.terms)))
    space = lsa.latent_space(docs([words(rng, 100) for _ in range(40)]), items, rank=32)
    assert np.allclose(space.T @ space, np.eye(space.shape[1]), atol=1e-6)
    assert (np.linalg.norm(items.matrix @ space, axis=1) > 0.85).all()


def test_finds_every_copy_of_a_large_benchmark(docs, spark):
    rng = random.Random(4)
    items = [words(rng, rng.randint(15, 60)) for _ in range(2000)]
    plain = [words(rng, 60) for _ in range(50)]
    texts = [plain[i % 50] + " " + item + " " + plain[(i + 7) % 50] for i, item in enumerate(items)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = lsa.leaks(docs(texts).repartition(4), benchmark).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, found)) == [(i, i) for i in range(2000)]


def test_a_passage_in_many_documents_does_not_hide_itself(docs, spark):
    rng = random.Random(6)
    items = [words(rng, rng.randint(15, 60)) for _ in range(20)]
    texts, want = [words(rng, 120) for _ in range(1000)], set()
    for item, share in ((0, 0.05), (1, 0.3), (2, 0.001)):
        for d in rng.sample(range(len(texts)), int(share * len(texts))):
            texts[d] += " " + items[item] + " " + words(rng, 40)
            want.add((d, item))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = lsa.leaks(docs(texts).repartition(4), benchmark).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, found)) == sorted(want)


def test_space_grows_with_the_items():
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(300, 900))
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    narrow = np.linalg.svd(matrix, full_matrices=False)[2][:40].T
    space = lsa.holding(narrow, matrix)
    assert np.allclose(space.T @ space, np.eye(space.shape[1]), atol=1e-6)
    assert (np.linalg.norm(matrix @ space, axis=1) >= lsa.RETAINED - 1e-6).all()
    assert (np.linalg.norm(matrix @ narrow, axis=1) < lsa.RETAINED).any()


def test_empty(docs, spark, odd):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "one two three four five six"), (1, "one two three four five six")], "item_id bigint, text string")
    assert lsa.leaks(odd, none).collect() == []
    assert lsa.leaks(docs([]), some).collect() == []
    twice = lsa.leaks(docs(["x one two three four five six y"] * 2, [4, 4]), some).collect()
    assert [(r["doc_id"], r["item_id"]) for r in twice] == [(4, 1)] * 4
    assert lsa.leaks(odd, some).collect() == []


def test_capitals_beyond_ascii():
    row, key = lsa.words_of(pa.array(["ÊTRE Élan ÷ ß", "être élan ß"]))
    assert key[row == 0].tolist() == key[row == 1].tolist() or (row == 0).sum() == 4


def test_long_items_are_divided(docs, spark):
    rng = random.Random(4)
    long, short = words(rng, 3000), words(rng, 30)
    texts = [words(rng, 50), words(rng, 20) + " " + long + " x", short, words(rng, 200)]
    benchmark = spark.createDataFrame([(1, long), (2, short)], "item_id bigint, text string")
    found = lsa.leaks(docs(texts), benchmark, block=25).collect()
    assert [(r["doc_id"], r["item_id"]) for r in sorted(found)] == [(1, 1), (2, 2)]
    whole = lsa.Items([1, 2], [long, short])
    blocks = list(whole.blocks(25))
    assert [p for b in blocks for p in b.probes] == whole.probes and all(len(b.probes) <= 25 for b in blocks)
    assert all(len(b.terms) <= 25 * lsa.PROBE for b in blocks)


def test_products_by_pair_are_the_wide_sums(docs, spark):
    rng = random.Random(6)
    pool = words(rng, 60).split()
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 90))) for _ in range(40)]
    items = lsa.Items([0, 1], [" ".join(pool[:20]), " ".join(pool[15:30])])
    items.keep(items.terms, np.linspace(1, 2, len(items.terms)))
    space = lsa.latent_space(docs(texts).repartition(3), items, rank=4)
    _, _, window, term, value, _, _, _ = lsa.window_vectors(pa.array(texts), items)
    full = np.zeros((window.max() + 1, len(items.terms)))
    full[window, term] = value
    kept = full[full.any(axis=1)]
    gram = kept.T @ kept + len(kept) / len(items.probes) * items.matrix.T @ items.matrix
    best = np.linalg.eigvalsh(gram)[::-1][:4].sum()
    assert np.trace(space[:, :4].T @ gram @ space[:, :4]) > 0.99 * best


def test_columns_of_the_caller_stay(docs, spark):
    some = spark.createDataFrame([(1, "one two three four five six")], "item_id bigint, text string")
    frame = docs(["clean text", "one two three four five six", None], [1, 2, None])
    frame = frame.withColumnsRenamed({"lang": "_row", "source": "key", "row": "_key"})
    left = lsa.without_leaks(frame, some)
    assert left.columns == frame.columns
    assert sorted(map(tuple, left.collect()), key=str) == sorted(map(tuple, frame.where("doc_id is null or doc_id = 1").collect()), key=str)
