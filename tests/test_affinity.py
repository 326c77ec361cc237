import itertools
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from marketgrain.errors import AnalyticsError
from marketgrain.operators import pairs as operators
from marketgrain.plans import affinity, segments
from tests.conftest import rows


def links(spark, pairs):
    return spark.createDataFrame(pairs, "customer_id int, product_id int")


def catalogue(spark, names):
    return spark.createDataFrame(list(names.items()), "product_id int, product_name string")


def brute(pairs):
    buyers = {}
    for c, p in pairs:
        buyers.setdefault(p, set()).add(c)
    found = {}
    for a, b in itertools.combinations(sorted(buyers), 2):
        common = len(buyers[a] & buyers[b])
        if common:
            found[a, b] = (common, common / math.sqrt(len(buyers[a]) * len(buyers[b])))
    return found


def test_repeated_purchases_count_once(spark):
    items = spark.createDataFrame([(1, 10), (1, 10), (1, 20)], "order_id int, product_id int")
    orders = spark.createDataFrame([(1, 7)], "order_id int, customer_id int")
    assert sorted(rows(affinity.interactions(items, orders))) == [(7, 10), (7, 20)]


def test_items_without_an_order_are_an_error(spark):
    items = spark.createDataFrame([(1, 10), (2, 10)], "order_id int, product_id int")
    orders = spark.createDataFrame([(1, 7)], "order_id int, customer_id int")
    with pytest.raises(Exception, match="no orders row"):
        affinity.interactions(items, orders).collect()
    assert affinity.interactions(items, orders, unmatched="drop").count() == 1


def test_cosine_of_binary_vectors(spark):
    found = affinity.pair_cosine(links(spark, [(10, 1), (20, 1), (10, 2), (30, 2)]))
    assert rows(found) == [(1, 2, 1, 0.5)]


def test_absent_pairs_and_the_diagonal(spark):
    bought = links(spark, [(10, 1), (20, 1), (10, 2), (30, 2), (40, 5)])
    full = affinity.mirrored(affinity.pair_cosine(bought), bought)
    assert sorted((r[0], r[1], r[3]) for r in rows(full)) == [(1, 1, 1.0), (1, 2, 0.5), (2, 1, 0.5), (2, 2, 1.0), (5, 5, 1.0)]


@pytest.mark.parametrize(("block", "minimum"), [(1024, 1), (4, 1), (1, 1), (3, 2)])
def test_pairs_match_brute_force_with_large_baskets(spark, block, minimum):
    """Customer 0 bought a third of everything and is cut into blocks."""
    draw = random.Random(block)
    pairs = {(0, p) for p in range(30)} | {(draw.randint(1, 12), draw.randint(0, 29)) for _ in range(60)}
    found = affinity.pair_cosine(links(spark, sorted(pairs)), min_common=minimum, block=block)
    got = {(r["product_a"], r["product_b"]): (r["common"], r["similarity"]) for r in found.collect()}
    assert len(got) == found.count()
    assert got == {k: v for k, v in brute(pairs).items() if v[0] >= minimum}


def test_ranking_excludes_the_target_and_breaks_ties_by_id(spark):
    bought = links(spark, [(1, 1), (1, 2), (1, 3)])
    names = catalogue(spark, {1: "a", 2: "b", 3: "c", 4: "never sold"})
    found = affinity.similar_products(bought, names, 1, 2).collect()
    assert [(r["rank"], r["product_id"], r["similarity"], r["target_customers"]) for r in found] == [(1, 2, 1.0, 1), (2, 3, 1.0, 1)]
    everything = affinity.similarity_to(bought, names, 1)
    assert {r["product_id"]: r["similarity"] for r in everything.collect()} == {2: 1.0, 3: 1.0, 4: 0.0}


def test_target_must_be_one_product_with_buyers(spark):
    names = catalogue(spark, {1: "a", 2: "a", 3: "c"})
    assert affinity.target_id(names, "c") == 3
    for name in ("a", "x"):
        with pytest.raises(AnalyticsError):
            affinity.target_id(names, name)
    with pytest.raises(Exception, match="no buyers"):
        affinity.similar_products(links(spark, [(1, 1)]), names, 3).collect()


def test_anchored_similarity_equals_the_pair_table(spark):
    draw = random.Random(5)
    pairs = sorted({(draw.randint(1, 20), draw.randint(0, 15)) for _ in range(150)})
    bought = links(spark, pairs)
    names = catalogue(spark, {p: str(p) for p in range(16)})
    anchored = {r["product_id"]: r["similarity"] for r in affinity.similarity_to(bought, names, 3).collect()}
    table = {}
    for (a, b), (_, similarity) in brute(pairs).items():
        if 3 in (a, b):
            table[a + b - 3] = similarity
    assert {p: s for p, s in anchored.items() if s} == table


def test_position_of_a_class(spark):
    bought = links(spark, [(1, 1), (2, 1), (1, 2), (2, 2), (1, 3), (9, 4)])
    names = catalogue(spark, {1: "t", 2: "rope", 3: "sail x", 4: "sail y"})
    r = affinity.class_position(bought, names, 1, F.col("product_name").startswith("sail")).first()
    assert (r["product_id"], r["position"]) == (3, 2)
    none = affinity.class_position(bought, names, 1, F.lit(False)).first()
    assert none["position"] is None


def test_wide_form_is_limited(spark):
    bought = links(spark, [(1, 1), (1, 2), (2, 2)])
    matrix = affinity.wide(bought, "customer_id", "product_id", F.count(F.lit(1)))
    assert rows(matrix) == [(1, 1, 1), (2, 0, 1)]
    with pytest.raises(AnalyticsError, match="more than 1"):
        affinity.wide(bought, "customer_id", "product_id", F.count(F.lit(1)), limit=1)


def test_context_goes_through_variants(spark):
    items = spark.createDataFrame([(1, 100), (1, 101)], "order_id int, variant_id int")
    variants = spark.createDataFrame([(100, 5), (101, 5)], "variant_id int, product_id int")
    orders = spark.createDataFrame([(1, 9)], "order_id int, customer_id int")
    context = segments.item_context(items, catalogue(spark, {5: "x"}), variants)
    assert rows(affinity.interactions(context, orders)) == [(9, 5)]


def test_pruning_by_support_loses_no_pair(spark):
    """One customer holds a third of all links; blocks are small."""

    rng = random.Random(3)
    links = {(0, p) for p in range(120)} | {(rng.randint(1, 60), int(rng.paretovariate(1)) % 150) for _ in range(400)}
    frame = spark.createDataFrame(sorted(links), "customer_id int, product_id int")
    every = {tuple(r) for r in affinity.pair_cosine(frame).collect()}
    for least in (0.2, 0.5, 1.0):
        found = {tuple(r) for r in affinity.pair_cosine(frame, min_cosine=least, block=16).collect()}
        assert found == {r for r in every if r[3] >= least}
    best = {}
    for a, b, _, s in every:
        for x, y in ((a, b), (b, a)):
            best.setdefault(x, []).append((-s, y))
    want = {(x, n + 1, y) for x, found in best.items() for n, (_, y) in enumerate(sorted(found)[:3])}
    assert {(r["product_id"], r["rank"], r["other_id"]) for r in affinity.most_similar(frame, 3, block=16).collect()} == want


def _best(pairs, n):
    best = {}
    for (a, b), (common, s) in brute(pairs).items():
        for x, y in ((a, b), (b, a)):
            best.setdefault(x, []).append((-s, y, common))
    return {(x, i + 1, y, c, -s) for x, found in best.items() for i, (s, y, c) in enumerate(sorted(found)[:n])}


@pytest.mark.parametrize(("n", "block", "least"), [(1, 1024, 0.0), (3, 8, 0.0), (5, 50, 0.3), (2, 1024, 1.0)])
def test_most_similar_equals_brute_force(spark, n, block, least):
    draw = random.Random(n)
    pairs = {(0, p) for p in range(90)} | {(draw.randint(1, 80), int(draw.paretovariate(0.7)) % 120) for _ in range(700)}
    found = affinity.most_similar(links(spark, sorted(pairs)), n, block=block, min_cosine=least)
    got = {tuple(r) for r in found.select("product_id", "rank", "other_id", "common", "similarity").collect()}
    wanted = {r for r in _best(pairs, 10**9) if r[4] >= least}
    assert got == {r for r in wanted if r[1] <= n}
    assert found.count() == len(got)


def test_few_pairs_are_counted_where_supports_differ(spark, monkeypatch):
    """Rare products are bought by the same few customers, each of whom also has most
    best sellers of one kind. A customer with a third of all links changes no answer."""
    draw = random.Random(11)
    pairs = set()
    for c in range(1, 400):
        pairs |= {(c, 100_000 + 2 * (c // 2) + k) for k in range(2)}  # two buyers each
        pairs |= {(c, c % 6 * 20 + k) for k in draw.sample(range(20), 18)}
    pairs |= {(0, 200_000 + p) for p in range(len(pairs) // 2)}  # bought by nobody else
    counted = []
    real = affinity.pairs.Baskets.met

    def met(self, apart, open_items=None):
        out = real(self, apart, open_items)
        counted.append(out.count())
        return out

    monkeypatch.setattr(affinity.pairs.Baskets, "met", met)
    rare = sorted(p for p in pairs if p[0] != 0)
    frame = links(spark, rare)
    found = affinity.most_similar(frame, 1).count()
    every = len(brute(rare))
    assert found and sum(counted) < every / 5
    monkeypatch.undo()
    hot = affinity.most_similar(links(spark, [p for p in sorted(pairs) if p[0] in (0, 1, 2) and p[1] < 200_300]), 2, block=64)
    assert {tuple(r) for r in hot.select("product_id", "rank", "other_id", "common", "similarity").collect()} == _best([p for p in pairs if p[0] in (0, 1, 2) and p[1] < 200_300], 2)


def test_share_of_pairs_far_apart(spark):
    # supports: three products of 8 buyers, one of 2, three of 1
    pairs = [(c, p) for c in range(8) for p in range(3)] + [(0, 3), (1, 3), (0, 4), (1, 5), (2, 6)]
    baskets = affinity.pairs.Baskets.of(links(spark, pairs), "customer_id", "product_id")
    level = {0: 3, 1: 3, 2: 3, 3: 1, 4: 0, 5: 0, 6: 0}
    met = [abs(level[p] - level[q]) for c, p in pairs for d, q in pairs if c == d]
    for least in (1, 2, 3, 4):
        assert baskets.share_apart(least) == pytest.approx(sum(x >= least for x in met) / len(met))


def test_most_similar_of_nothing(spark):
    assert affinity.most_similar(links(spark, []), 3).collect() == []
    assert affinity.most_similar(links(spark, [(1, 1), (2, 2)]), 3).collect() == []


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


@pytest.mark.parametrize("arrays", [0, 1 << 40])
def test_most_similar_leaves_nothing_shuffled_and_goes_in_rounds(spark, monkeypatch, arrays):
    monkeypatch.setattr(operators, "SENT_AT_ONCE", 1)
    monkeypatch.setattr(operators, "PARTNERS_FOR_ARRAYS", arrays)
    rng = random.Random(5)
    pairs = sorted({(rng.randrange(60), 1000 - rng.randrange(90) ** 2 // 90) for _ in range(2400)})
    frame = links(spark, pairs).localCheckpoint()
    assert operators.Load.of(frame, "customer_id").rounds() > 1
    before = shuffle_files(spark)
    found = affinity.most_similar(frame, 3)
    time.sleep(1)  # files go in the background
    assert not shuffle_files(spark) - before
    want = {(p, r, o, c) for p, rows in brute_best(pairs, 3).items() for r, (o, c) in enumerate(rows, 1)}
    assert {(r["product_id"], r["rank"], r["other_id"], r["common"]) for r in found.collect()} == want


def brute_best(pairs, n):
    owners = {}
    for owner, item in pairs:
        owners.setdefault(item, set()).add(owner)
    best = {}
    for a, of_a in owners.items():
        common = [(b, len(of_a & of_b), len(of_a & of_b) / math.sqrt(float(len(of_a)) * float(len(of_b)))) for b, of_b in owners.items() if b != a]
        best[a] = [(b, c) for b, c, s in sorted(common, key=lambda x: (-x[2], x[0])) if c][:n]
    return best


def test_pairs_are_sent_as_one_number_and_counted_in_arrays(spark, monkeypatch):
    monkeypatch.setattr(operators, "PARTNERS_FOR_ARRAYS", 0)
    pairs = sorted({(i % 40, -5 + (i * 7) % 50) for i in range(1500)})
    found = affinity.pair_cosine(links(spark, pairs))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(item_a") == 1 and plan.count("Exchange") == 1
    assert "item_b" not in "".join(line for line in plan.splitlines() if "Aggregate" in line)
    want = {(*pair, common) for pair, (common, _) in brute(pairs).items()}
    assert {tuple(r)[:3] for r in found.collect()} == want


def test_wide_ids_and_large_baskets_count_alike(spark, monkeypatch):
    monkeypatch.setattr(operators, "PARTNERS_FOR_ARRAYS", 0)
    pairs = sorted({(i % 30, (i * 11) % 37) for i in range(900)})
    far = [(o, i * 2**50 - 2**54) for o, i in pairs]  # codes beyond what a double tells apart
    want = {(*pair, common) for pair, (common, _) in brute(pairs).items()}
    told = {((r["product_a"] + 2**54) >> 50, (r["product_b"] + 2**54) >> 50, r["common"]) for r in affinity.pair_cosine(spark.createDataFrame(far, "customer_id int, product_id bigint")).collect()}
    assert told == want
    monkeypatch.setattr(operators, "PARTNERS_IN_ARRAY", 1)
    assert {(r["product_a"], r["product_b"], r["common"]) for r in affinity.pair_cosine(links(spark, pairs)).collect()} == want
