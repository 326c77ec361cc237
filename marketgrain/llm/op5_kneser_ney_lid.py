"""Language identification by interpolated Kneser-Ney character models.

A word is a run of letters, in lower case. For each language, character n-grams of
its words give an interpolated Kneser-Ney model (absolute discounting, continuation
counts below the highest order); all models share sorted hash arrays, one row per
n-gram and one column per language. A text gets the language with the lowest cross
entropy per symbol. A temperature fitted on learning rows that were kept out of
the counts turns the entropies into a score, and a score below the calibrated
threshold is marked as rejected.

The models are fitted on a bounded sample of the learning rows (``SAMPLE_BYTES`` a
language); every row is scored on its whole text. Scoring is one scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketgrain.llm import bpe, charlm, common
from marketgrain.llm import textarrays as ta

ORDER = 5
SAMPLE_BYTES = 1_500_000  # of learning text a language
CHECK_SHARE = 0.2  # of the sample, kept out of the counts for calibration
UNIFORM = 1 / 5000
UNDETERMINED = "und"
ACCEPTED = 0.995  # of right calibration answers that the threshold keeps
_lower: dict = {}


def lower_codes() -> np.ndarray:
    """Code points in lower case, where that is one code point."""
    if "table" not in _lower:
        table = np.arange(0x110000, dtype=np.uint32)
        for c in np.flatnonzero(bpe.classes() == bpe.LETTER).tolist():
            low = chr(c).lower()
            if len(low) == 1:
                table[c] = ord(low)
        _lower["table"] = table
    return _lower["table"]


def letter_words(column):
    """(code points, row, number, starts, ends): every run of letters, by the text
    that holds it and by its number among the different runs; then the places of
    the different runs."""
    data, offsets = ta.flat(column)
    _, code, offsets = bpe.codes_of(data, offsets)
    n = len(code)
    letter = bpe.classes()[code] == bpe.LETTER
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1] | edge[1:n]
    last[:-1] &= ~letter[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    code = lower_codes()[code]
    hashes = ta.spans(code, starts, ends, bpe._state["values"]) if len(starts) else np.zeros(0, np.uint64)
    numbers, distinct = pd.factorize(hashes)
    at = ta.firsts(numbers, len(distinct)) if len(starts) else np.zeros(0, np.int64)
    row = np.searchsorted(offsets, starts, "right") - 1
    return code, row, numbers, starts[at], ends[at]


def kneser_ney(texts: list[str], order: int = ORDER) -> list[dict]:
    """For k = 1..order: keys of n-grams with ``own`` and ``rest`` as in charlm."""
    code, _, numbers, starts, ends = letter_words(pa.array(texts, pa.string()))
    times = np.bincount(numbers, minlength=len(starts)).astype(np.float64)
    symbols, place, word, _ = charlm.padded(code, starts, ends)
    levels = charlm.grams(symbols, place, order)
    unique, codes = [], []
    for keys, there in levels:
        number, distinct = pd.factorize(np.where(there, keys, 0))
        codes.append(number)
        unique.append(distinct)
    out: list[dict] = []
    weight = times[word] if len(word) else np.zeros(0)
    for k in range(order):
        there, n = levels[k][1] & (place >= 1), len(unique[k])
        raw = np.bincount(codes[k][there], weights=weight[there], minlength=n)
        if k + 1 < order:
            # continuations: different symbols before; those at a word's start keep their counts
            longer = levels[k + 1][1]
            where = ta.firsts(codes[k + 1], len(unique[k + 1]))
            where = where[longer[where]]
            count = np.bincount(codes[k][where], minlength=n).astype(np.float64)
            at_start = there & (place == k)
            count += np.bincount(codes[k][at_start], weights=weight[at_start], minlength=n)
        else:
            count = raw
        count = np.where(raw > 0, count, 0)
        ones, twos = (count == 1).sum(), (count == 2).sum()
        discount = min(0.95, max(0.1, ones / (ones + 2 * twos) if ones else 0.5))
        seen = np.flatnonzero(count > 0)
        at = ta.firsts(codes[k], n)
        own = np.zeros(n)
        if k == 0:
            total = count.sum()
            own[seen] = (count[seen] - discount) / max(total, 1)
            rest0 = discount * len(seen) / total if total else 1.0
        else:
            context = codes[k - 1][at[seen] - 1]
            total = np.bincount(context, weights=count[seen], minlength=len(unique[k - 1]))
            kinds = np.bincount(context, minlength=len(unique[k - 1]))
            own[seen] = (count[seen] - discount) / total[context]
            out[k - 1]["rest"] = np.where(total > 0, discount * kinds / np.maximum(total, 1e-9), 1.0)
        out.append({"keys": unique[k], "own": own, "rest": np.ones(n)})
        if k == 0:
            out[0]["rest0"] = rest0
    return out


def joined(models: list[list[dict]]) -> list[dict]:
    """Models of several languages as one sorted table per order."""
    tables = []
    for k in range(len(models[0])):
        keys = np.unique(np.concatenate([m[k]["keys"] for m in models]))
        keys = keys[keys != 0]
        own, rest = np.zeros((len(keys), len(models))), np.ones((len(keys), len(models)))
        for j, m in enumerate(models):
            at = charlm.find(keys, m[k]["keys"])
            own[at[at >= 0], j], rest[at[at >= 0], j] = m[k]["own"][at >= 0], m[k]["rest"][at >= 0]
        table = {"keys": keys, "own": own, "rest": rest}
        if k == 0:
            table["rest0"] = np.array([m[0]["rest0"] for m in models])
        tables.append(table)
    return tables


def entropies(tables: list[dict], column) -> tuple[np.ndarray, np.ndarray]:
    """(cross entropy per symbol of each text under each model, symbols)."""
    code, row, numbers, starts, ends = letter_words(column)
    n = len(column)
    scores = charlm.word_scores(tables, *charlm.padded(code, starts, ends), base=UNIFORM)
    sizes = np.bincount(row, weights=(ends - starts + 1)[numbers], minlength=n) if len(row) else np.zeros(n)
    total = np.stack([np.bincount(row, weights=scores[numbers, j], minlength=n) if len(row) else np.zeros(n) for j in range(scores.shape[1])], axis=1)
    return -total / np.maximum(sizes, 1)[:, None], sizes


def confidence(entropy: np.ndarray, sizes: np.ndarray, heat: float) -> np.ndarray:
    """Softmax over languages; evidence grows with the root of the length."""
    z = -entropy * np.sqrt(np.maximum(sizes, 1))[:, None] * heat
    z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def calibrate(tables: list[dict], texts: list[str], truth: np.ndarray) -> tuple[float, float]:
    """(temperature, threshold) from labelled texts that gave no counts."""
    entropy, sizes = entropies(tables, pa.array(texts, pa.string()))
    use = sizes > 0
    entropy, sizes, truth = entropy[use], sizes[use], truth[use]
    if not len(truth):
        return 1.0, 0.0
    best = min(
        (float(-np.log(np.maximum(confidence(entropy, sizes, h)[np.arange(len(truth)), truth], 1e-12)).mean()), h)
        for h in (0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0)
    )[1]
    p = confidence(entropy, sizes, best)
    right = p.argmax(axis=1) == truth
    return best, float(np.quantile(p.max(axis=1)[right], 1 - ACCEPTED)) if right.any() else 0.0


def fit(docs: DataFrame, learning: Column, sample_bytes: int = SAMPLE_BYTES) -> dict | None:
    """Models of every language of the learning rows, from about ``sample_bytes``
    of text each, chosen by a hash of the row. None if there is nothing to learn."""
    rows = docs.where(learning & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample_bytes / max(n, 1)))])
    sample = rows.where(draw < share[F.col("lang")]).withColumn("check", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1000)) < 1000 * CHECK_SHARE)
    held = sample.select("lang", "check", "text").toPandas()
    languages = sorted(sizes)
    counts = [kneser_ney(held.text[(held.lang == lang) & ~held.check].tolist()) for lang in languages]
    tables = joined(counts)
    checks = held[held.check]
    heat, least = calibrate(tables, checks.text.tolist(), np.array([languages.index(x) for x in checks.lang], dtype=np.int64))
    return {"languages": languages, "tables": tables, "heat": heat, "least": least}


def identify(docs: DataFrame, learning: Column, held_out: Column, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: the language of every row.

    Learns from the rows where ``learning`` holds and lang is not null; lang,
    source and doc_id are no inputs of a prediction. A null text, one without a
    letter, and every text if there is nothing to learn from, gets ``und`` with
    score 0, rejected. Equal entropies go to the smaller language name. Equal
    texts get equal answers. Null and repeated ids keep their rows. Texts are
    read whole. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    common.ship(spark)
    model = fit(docs, learning, sample_bytes)
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = spark.sparkContext.broadcast(model)  # bounded by the sample

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in ta.slices(batches):
            n = batch.num_rows
            best, score, sizes = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            if model:
                entropy, sizes = entropies(model["tables"], batch.column(2))
                best = entropy.argmin(axis=1)
                score = confidence(entropy, sizes, model["heat"])[np.arange(n), best]
            names = [model["languages"][j] if s else UNDETERMINED for j, s in zip(best.tolist(), sizes.tolist(), strict=True)]
            score = np.where(sizes > 0, score, 0.0)
            rejected = (sizes == 0) | (score < (model["least"] if model else 0))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return rows.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents")
    left_out = common.id_remainder(F.col("doc_id"), 4) == 2
    return identify(docs, ~left_out, left_out)
