import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from marketgrain.llm import common
from marketgrain.llm import op3_prob_minhash as near
from marketgrain.llm import op6_pseudonyms as privacy
from marketgrain.llm import op9_latent_semantic as lsa


def words(rng, n):
    return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Tables with planted cases; which rows must go, and why."""
    rng = random.Random(4)
    rows, labels, benchmark = [], [], [(i, words(rng, 25)) for i in range(6)]
    rows = [[i, words(rng, rng.randint(30, 300))] for i in range(400)]
    for i in range(0, 400, 4):
        rows[i][1] += " awful nasty " + words(rng, 3)  # toxic
    for i in range(1, 400, 9):
        rows[i][1] = " ".join(w + "###" for w in rows[i][1].split())  # low
    gone = {r[0] for r in rows if "nasty" in r[1] or "###" in r[1]}
    labels = [(r[0], int("###" not in r[1]), int("nasty" in r[1])) for r in rows if r[0] % 3]
    clean = [r for r in rows if r[0] not in gone]
    copies, edited = {}, {}
    for n, r in enumerate(clean[:40]):
        copies[1000 + n] = r[0]
        rows.append([1000 + n, r[1].upper()])
    for n, r in enumerate([r for r in clean if len(r[1].split()) > 150][:20]):
        own = r[1].split()
        own[len(own) // 2] = "other"
        edited[2000 + n] = r[0]
        rows.append([2000 + n, " ".join(own)])
    leaked = {3000 + i for i in range(6)}
    rows += [[3000 + i, f"{words(rng, 80)} {t} {words(rng, 50)}"] for i, t in benchmark]
    rows += [[4000, f"{words(rng, 60)} write to a.b1@x.org"], [4001, None], [4002, ""], [None, words(rng, 40)]]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, {"quality": gone, "near_dedup": {*copies, *edited}, "decontamination": leaked}, {r[0]: r[1] for r in rows}


def test_each_stage_takes_its_own(spark, corpus):
    folder, gone, texts = corpus
    docs, left = common.table(spark, folder, "documents"), set(texts)
    for name, stage in pipeline.STAGES:
        out = common.stored(stage(spark, docs, folder), name)
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        left -= gone.get(name, set())
        assert ids == left, name
        if name != "packing":
            assert out.columns == pipeline.COLUMNS
            assert out.count() == len(left)
        docs, before = out, docs
    clean = {r["doc_id"]: r["text"] for r in before.collect()}
    assert clean[4000] != texts[4000] and len(clean[4000]) == len(texts[4000])
    assert clean[4001] is None and clean[4002] == ""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    assert sizes == {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in clean.items()}


def test_run_and_empty_tables(spark, corpus, tmp_path):
    folder, gone, texts = corpus
    out = pipeline.run(spark, folder)
    assert out.select("doc_id").distinct().count() == len(texts) - sum(map(len, gone.values()))
    for name in ("documents", "labels", "benchmark"):
        common.table(spark, folder, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_keep_columns_and_repeated_rows(docs, odd):
    assert near.deduplicated(odd).columns == odd.columns
    found = near.deduplicated(odd).collect()
    assert len([r for r in found if r["doc_id"] == 102]) == 1
    assert len([r for r in found if not (r["text"] or "").strip()]) == sum(not (r["text"] or "").strip() for r in odd.collect())
    assert privacy.with_pseudonyms(odd).columns == odd.columns
    assert lsa.without_leaks(odd, docs([]).selectExpr("doc_id as item_id", "text")).count() == odd.count()
