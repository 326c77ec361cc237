import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketgrain.llm import common
from marketgrain.llm import op4_co_training as quality


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, quality int, toxic int, n_chars int")


def test_held_out_accuracy(spark):
    """Rows whose labels were not given are judged right."""
    folder = "/root/testdata/sf0.1"
    docs, labels = common.table(spark, folder, "documents"), common.table(spark, folder, "labels")
    found = quality.judge(docs, labels.where("doc_id % 3 <> 0"))
    rows = found.join(labels.where("doc_id % 3 = 0"), "doc_id").select("p_low", "p_toxic", "quality", "toxic", "rejected").toPandas()
    low, toxic = rows.quality == 0, rows.toxic == 1
    assert ((rows.p_low >= 0.5) == low).mean() > 0.98
    assert rows.rejected[toxic].mean() > 0.9
    assert rows.rejected[~low & ~toxic].mean() < 0.01
    assert rows.rejected[low].mean() > 0.97


def test_odd_rows(docs, odd, labels):
    given = labels([(0, 1, 0), (4, 0, 1), (4, 1, 0), (5, None, 1), (6, 1, 0), (7, 1, 0), (8, 0, 0), (None, 1, 1), (10, 0, 1), (11, 1, 0)])
    odd = odd.withColumn("n_chars", F.when(F.col("doc_id") != 7, F.length("text")))
    odd = odd.withColumn("source", F.when(F.col("doc_id") != 8, F.col("source")))
    found = quality.judge(odd, given).collect()
    assert len(found) == odd.count()
    assert all(0 <= r[c] <= 1 and math.isfinite(r[c]) for r in found for c in found[0].asDict() if c.startswith("p_"))
    assert {r["rejected"] for r in quality.judge(odd, labels([])).collect()} == {False}
    assert quality.judge(docs([]).withColumn("n_chars", F.lit(1)), given).collect() == []


def test_words_of_one_class_become_evidence():
    rng = np.random.default_rng(0)
    import pyarrow as pa

    y = np.array([1, 0] * 100)
    texts = [" ".join(["plain", "text", f"w{rng.integers(50)}x"] + (["bad"] if c and i % 3 else [])) for i, c in enumerate(y)]
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    holders = quality.Holders([batch])
    lexicon = holders.lexicon(np.arange(200), y.astype(float), 200)
    assert len(lexicon["words"]) == 1
    view = quality.text_view(pa.array(["a bad text", "a good text", ""]), lexicon)
    assert view[0, 0] > 2 and view[1, 0] == view[2, 0] == 0


def test_regression_is_the_maximum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3))
    y = (rng.random(500) < quality.chance(x @ [1.0, -2.0, 0.5] + 0.3)).astype(float)
    w = quality.regression(x, y, 0.5)
    p = quality.chance(quality.apply(x, w))
    assert np.allclose(x.T @ (p - y) + 0.5 * w[:3], 0, atol=1e-4)


def test_a_round_draws_the_surest_of_all_rows(spark):
    """``surest`` against the same scores over the whole table at once."""
    import pyarrow as pa

    folder = "/root/testdata/sf0.01"
    docs = common.table(spark, folder, "documents")
    docs = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1_000_000))  # copies score alike
    table = docs.select(*quality.COLUMNS).toArrow().sort_by("doc_id").combine_chunks()
    labels = common.table(spark, folder, "labels").toPandas().set_index("doc_id")
    ids = table["doc_id"].to_numpy()
    known = np.flatnonzero(np.isin(ids, labels.index))[:400]
    sample = quality.Sample(table.take(pa.array(known)))
    none = {v: np.full(len(known), -1) for v in ("text", "page")}
    truths = {"low": (labels.quality.loc[ids[known]] == 0).to_numpy().astype(int), "toxic": labels.toxic.loc[ids[known]].to_numpy()}
    views = {t: quality.fitted(sample, truths[t], np.zeros(len(known), bool), none) for t in quality.TARGETS}
    gain = 15
    found = quality.surest(docs.repartition(7), views, sample.bins, np.unique(ids[known]), gain).collect()
    (batch,) = table.to_batches()
    free = ~np.isin(ids, ids[known])
    for kind, (target, view, label) in enumerate(quality.KINDS):
        model = views[target]
        x = quality.text_view(table["text"].chunk(0), model["lexicon"]) if view == "text" else sample.bins(quality.page_view(batch))
        z = np.round(quality.apply(x, model["weights"][view]), 6)
        p = quality.chance(z)
        sure = p >= quality.SURE if label else p <= (1 - quality.SURE) * model["share"]
        want, scores = [], set()
        for i in sorted(np.flatnonzero(free & sure), key=lambda i: (-z[i] if label else z[i], ids[i])):
            if z[i] not in scores and len(want) < gain:
                scores.add(z[i])
                want.append(int(ids[i]))
        got = sorted((r for r in found if r["kind"] == kind), key=lambda r: -r["score"])
        assert [r["doc_id"] for r in got] == want
    # a copy is drawn only where its original was in the sample already
    assert found and all(r["doc_id"] < 1_000_000 or r["doc_id"] - 1_000_000 in ids[known] for r in found)


def test_rows_of_repeated_ids_are_drawn_once(docs):
    some = docs(["a", "b", "b", None], [5, 6, 6, 7])
    found = quality.rows_with(some, [5, 6, 7])
    assert found["doc_id"].to_pylist() == [5, 6, 7]
    assert found["text"].to_pylist() == ["a", "b", None]
