import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from marketgrain.llm import common
from marketgrain.llm import op5_kneser_ney_lid as lid


def brute_model(words, order=3):
    """Interpolated Kneser-Ney over marked words, by dictionaries."""
    grams = [Counter() for _ in range(order + 1)]
    for w in words:
        s = "^" + w + "$"
        for i in range(1, len(s)):
            for k in range(1, min(order, i + 1) + 1):
                grams[k][s[i - k + 1 : i + 1]] += 1
    counts = [None] * (order + 1)
    counts[order] = dict(grams[order])
    for k in range(order - 1, 0, -1):
        left = defaultdict(set)
        for g in grams[k + 1]:
            left[g[1:]].add(g[0])
        counts[k] = {g: (n if g[0] == "^" else 0) + len(left[g]) for g, n in grams[k].items()}
    stats = []
    for k in range(1, order + 1):
        total, kinds = Counter(), Counter()
        for g, n in counts[k].items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        ones, twos = (sum(n == x for n in counts[k].values()) for x in (1, 2))
        stats.append((counts[k], total, kinds, min(0.95, max(0.1, ones / (ones + 2 * twos) if ones else 0.5))))

    def score(word):
        s, out = "^" + word + "$", 0.0
        for i in range(1, len(s)):
            p = lid.UNIFORM
            for k in range(1, min(order, i + 1) + 1):
                count, total, kinds, d = stats[k - 1]
                g = s[i - k + 1 : i + 1]
                if total[g[:-1]]:
                    p = max(count.get(g, 0) - d, 0) / total[g[:-1]] + d * kinds[g[:-1]] / total[g[:-1]] * p
            out += math.log10(p)
        return out

    return score


def test_model_equals_dictionaries():
    text = "banana bandana an ana cabana banal a nab band an an"
    tables = lid.joined([lid.kneser_ney([text], 3)])
    score = brute_model(text.split())
    words = ["banana", "an", "x", "bandits", "a", "nabob"]
    entropy, sizes = lid.entropies(tables, pa.array(words))
    want = [-score(w) / (len(w) + 1) for w in words]
    assert np.allclose(entropy[:, 0], want)
    assert sizes.tolist() == [len(w) + 1 for w in words]


def test_odd_texts(odd):
    found = {r["doc_id"]: r for r in lid.identify(odd, F.lit(True), F.lit(False)).collect()}
    assert len(found) == odd.select("doc_id").distinct().count()
    assert all(r["lang_pred"] in ("en", "und") and 0 <= r["score"] <= 1 for r in found.values())
    assert [found[i]["lang_pred"] for i in (0, 1, 100)] == ["und"] * 3
    assert found[101]["lang_pred"] == "en"


def test_nothing_to_learn(docs, odd):
    assert lid.identify(docs([]), F.lit(True), F.lit(False)).collect() == []
    none = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in lid.identify(none, F.lit(True), F.lit(False)).collect()} == {"und"}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = lid.query(spark, folder).join(common.table(spark, folder, "documents").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
