"""Quality and toxicity by co-training two views of a document.

The text view sees the content: words and byte trigrams that a likelihood-ratio
test finds tied to the class, and words said again at once. The metadata view sees
the page: language, source, length, lines and the kinds of signs. For each target
(low quality, toxic) both start from the labelled rows; in each round all other
documents are judged by both views in a scan, and each view labels the ``GAIN`` rows
of each class that it is surest of, if it is sure of them, for the other. At the end
each view is calibrated on labelled rows kept apart, and a regression on both
calibrated views scores all documents.

The fit starts from at most about ``LABELLED`` labelled rows, drawn by a hash of the
id, and gains at most 8 * ``GAIN`` rows a round; that bounds what the driver holds.
The rows gained are the surest of the whole table at any size: a task keeps the best
of its rows, and of rows with equal scores, as copies are, one. Scoring is one scan
of whole texts, the fit one scan a round and one for the rows drawn in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketgrain.llm import charlm, common
from marketgrain.llm import textarrays as ta

LABELLED = 6000
ROUNDS = 3
APART = 0.25  # of the labelled rows, for calibration
SURE = 0.98  # a view passes on labels with at least this probability
GAIN = 200  # labels passed on by a view in a round, of each class: co-training's growth
EVIDENCE = 14.0  # likelihood-ratio statistic of a kept word or trigram
PURITY = 0.7  # share of the class among the rows that hold it
LIMIT = 0.7  # probability from which a document is rejected
TARGETS = ("low", "toxic")
BINS = 8


def streams(column):
    """Words, trigrams and repeats of a slice: (row, key) of each, and per text the
    numbers of words and of words equal to the one before."""
    data, offsets = ta.flat(column)
    n = len(offsets) - 1
    _, _, row, key = ta.words(data, offsets, breaks=ta.NO_LETTER)
    again = np.zeros(len(key), dtype=bool)
    again[1:] = (key[1:] == key[:-1]) & (row[1:] == row[:-1])
    total = np.bincount(row, minlength=n) if len(row) else np.zeros(n, np.int64)
    same = np.bincount(row[again], minlength=n) if len(row) else np.zeros(n, np.int64)
    wide = data.astype(np.int32)
    three = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:] if len(wide) > 2 else np.zeros(0, np.int32)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    whole = owner[:-2] == owner[2:] if len(three) else np.zeros(0, bool)
    return row, key, owner[:-2][whole] if len(three) else owner[:0], three[whole], total, same


def text_view(column, lexicon: dict, seen: tuple | None = None) -> np.ndarray:
    """Content features of each text, given a target's words and trigrams; ``seen``
    are its streams where they are known."""
    row, key, owner, three, total, same = seen or streams(column)
    n = len(total)
    at = charlm.find(lexicon["words"], key)
    hit = at >= 0
    strength = np.zeros(n)
    np.maximum.at(strength, row[hit], lexicon["strength"][at[hit]])
    found = np.bincount(row[hit], minlength=n)
    different = pd.DataFrame({"r": row[hit], "k": at[hit]}).drop_duplicates().r.to_numpy()
    different = np.bincount(different, minlength=n)
    signs = np.bincount(owner[lexicon["signs"][three]], minlength=n) if len(three) else np.zeros(n)
    size = np.maximum(np.bincount(owner, minlength=n) if len(owner) else np.zeros(n), 1)
    words = np.maximum(total, 1)
    return np.stack([strength, np.log1p(different), np.sqrt(found / words), np.sqrt(signs / size), np.sqrt(same / words), (total == 0) * 1.0], axis=1)


def page_view(batch: pa.RecordBatch) -> np.ndarray:
    """Page features: sizes, lines, kinds of signs, and hashes of lang and source."""
    get = lambda name: batch.column(batch.schema.get_field_index(name))
    data, offsets = ta.flat(get("text"))
    n, size = len(offsets) - 1, np.diff(offsets)
    marks = np.zeros((len(data) + 1, 5), dtype=np.int32)
    kinds = (data == 10, (data >= 65) & (data <= 90), (data >= 48) & (data <= 57), ta.NO_LETTER[data] & ~ta.SPACE[data], ta.SPACE[data])
    for j, kind in enumerate(kinds):
        np.cumsum(kind, out=marks[1:, j])
    sums = (marks[offsets[1:]] - marks[offsets[:-1]]).astype(np.float64)
    full = np.maximum(size, 1)
    coded = lambda name, m: np.array([hash_text(x) % m for x in get(name).to_pylist()], dtype=np.float64)
    claimed = np.asarray(get("n_chars").to_numpy(zero_copy_only=False), dtype=np.float64)
    columns = [
        np.log1p(size), np.log1p(np.nan_to_num(claimed, nan=0.0)), np.log1p(sums[:, 0]), np.log1p(size / (1 + sums[:, 0])),
        *(sums[:, j] / full for j in range(1, 5)), coded("lang", 16), coded("source", 32),
    ]
    return np.stack(columns, axis=1) if n else np.zeros((0, len(columns)))


def hash_text(value: str | None) -> int:
    import zlib

    return 0 if value is None else 1 + zlib.crc32(value.encode())


class Bins:
    """One-hot features of a page view: quantile bins of sizes and shares, values
    of hashes."""

    def __init__(self, x: np.ndarray):
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1] - 2)]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        parts = [np.eye(len(e) + 1)[np.searchsorted(e, x[:, j], "left")] for j, e in enumerate(self.edges)]
        parts += [np.eye(m)[x[:, -k].astype(np.int64) % m] for k, m in ((2, 16), (1, 32))]
        return np.concatenate(parts, axis=1)


def regression(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic regression with intercept by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(30):
        p = chance(x @ w)
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), grad)
        size = np.abs(step).max()
        w -= step * min(1.0, 5.0 / max(size, 1e-9))
        if size < 1e-6:
            break
    return w


def chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def apply(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


class Holders:
    """Which rows of the sample hold which words and trigrams, for those that
    enough rows hold to be evidence. Two passes over the sample: the first counts
    rows in fixed tables, so that pairs of rare keys are never held."""

    LEAST = 4  # rows that hold a key

    def __init__(self, slices: list[pa.RecordBatch]):
        words, threes, total = np.zeros(1 << 22, dtype=np.int32), np.zeros(1 << 24, dtype=np.int32), 0
        for batch in slices:
            (_, key), (_, three) = self.pairs(batch)
            np.add.at(words, self.slot(key), 1)
            np.add.at(threes, three, 1)
            total += batch.num_rows
        # a key that most rows hold is tied to no class
        often_word, often_three = (((c >= self.LEAST) & (c <= 0.6 * total + self.LEAST)) for c in (words, threes))
        parts, base = ([], []), 0
        for batch in slices:
            (row, key), (owner, three) = self.pairs(batch)
            good, fit = often_word[self.slot(key)], often_three[three]
            parts[0].append((row[good] + np.int32(base), key[good]))
            parts[1].append((owner[fit] + np.int32(base), three[fit]))
            base += batch.num_rows
        del words, threes, often_word, often_three
        self.words = self.numbered(parts[0])
        parts[0].clear()
        self.threes = self.numbered(parts[1])

    @staticmethod
    def slot(key: np.ndarray) -> np.ndarray:
        return (key >> ta.U(42)).astype(np.int64)

    @staticmethod
    def pairs(batch: pa.RecordBatch) -> tuple:
        """Distinct (row, word) and (row, trigram) of a slice."""
        row, key, owner, three, _, _ = streams(batch.column(batch.schema.get_field_index("text")))
        codes, keys = pd.factorize(key)
        pair = np.unique((row << 32) | codes) if len(row) else np.zeros(0, np.int64)
        other = np.unique((owner.astype(np.int64) << 24) | three)
        return (
            ((pair >> 32).astype(np.int32), np.asarray(keys)[pair & 0xFFFFFFFF]),
            ((other >> 24).astype(np.int32), (other & 0xFFFFFF).astype(np.int32)),
        )

    @staticmethod
    def numbered(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, keys = pd.factorize(np.concatenate([p[1] for p in parts]))
        return np.concatenate([p[0] for p in parts]), codes.astype(np.int32), np.asarray(keys)

    @staticmethod
    def tied(part: tuple, rows: np.ndarray, y: np.ndarray, size: int):
        """Keys tied to class 1 among the given rows, with their log odds."""
        row, code, keys = part
        given, hit = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        given[rows], hit[rows] = True, y > 0
        every, yes = (np.bincount(code[x[row]], minlength=len(keys)).astype(np.float64) for x in (given, hit))
        n, k = len(rows), y.sum()
        if not 0 < k < n:
            return keys[:0], np.zeros(0)
        with np.errstate(divide="ignore", invalid="ignore"):
            term = lambda a, e: np.where(a > 0, a * np.log(a / e), 0.0)
            no, share = every - yes, k / n
            statistic = 2 * (
                term(yes, every * share) + term(no, every * (1 - share)) + term(k - yes, (n - every) * share) + term(n - k - no, (n - every) * (1 - share))
            )
        good = (statistic >= EVIDENCE) & (yes >= PURITY * every)
        odds = np.log((yes + 0.5) / (every - yes + 0.5)) - np.log(k / (n - k))
        return keys[good], odds[good]

    def lexicon(self, rows: np.ndarray, y: np.ndarray, size: int) -> dict:
        words, odds = self.tied(self.words, rows, y, size)
        threes, _ = self.tied(self.threes, rows, y, size)
        order = np.argsort(words)
        signs = np.zeros(1 << 24, dtype=bool)
        signs[threes.astype(np.int64)] = True
        return {"words": words[order], "strength": odds[order], "signs": signs}


class Sample:
    """The rows that both targets' views are fitted on: labelled ones first, then
    those drawn so far."""

    def __init__(self, rows: pa.Table, bins: Bins | None = None):
        self.slices = list(ta.slices(iter(rows.combine_chunks().to_batches()), limit=1 << 19))  # small, as this runs in the driver
        self.size, self.holders = rows.num_rows, Holders(self.slices)
        pages = np.concatenate([page_view(s) for s in self.slices])
        self.bins = bins or Bins(pages)
        self.page = self.bins(pages)

    def text(self, lexicon: dict) -> np.ndarray:
        return np.concatenate([text_view(s.column(s.schema.get_field_index("text")), lexicon) for s in self.slices])


def fitted(sample: Sample, truth: np.ndarray, apart: np.ndarray, given: dict[str, np.ndarray]) -> dict:
    """Both views of a target. ``truth`` is 0, 1 or -1 (unlabelled); rows ``apart``
    are for calibration only; ``given`` has the labels that each view was given."""
    known = np.flatnonzero((truth >= 0) & ~apart)

    def rows_of(view: str) -> tuple[np.ndarray, np.ndarray]:
        more = np.flatnonzero(given[view] >= 0)
        return np.concatenate([known, more]), np.concatenate([truth[known], given[view][more]]).astype(float)

    rows, y = rows_of("text")
    lexicon = sample.holders.lexicon(rows, y, sample.size)
    text = sample.text(lexicon)
    weights = {"text": regression(text[rows], y)}
    rows, y = rows_of("page")
    weights["page"] = regression(sample.page[rows], y)
    share = float(truth[known].mean()) if len(known) else 0.0
    return {"lexicon": lexicon, "text": text, "weights": weights, "share": share}


def calibrated(sample: Sample, views: dict, truth: np.ndarray, apart: np.ndarray) -> dict:
    """A target's model for scoring: both views calibrated, and their combination."""
    held = np.flatnonzero(apart & (truth >= 0))
    both_x, made = (views["text"], sample.page), []
    for x, w in zip(both_x, views["weights"].values(), strict=True):
        z = apply(x, w)
        made.append((w, regression(z[held][:, None] / 5, truth[held].astype(float), 0.1)))
    both = np.stack([apply(apply(x, w)[:, None] / 5, c) for x, (w, c) in zip(both_x, made, strict=True)], axis=1)
    merged = regression(both[held] / 5, truth[held].astype(float), 0.1)
    return {"lexicon": packed(views["lexicon"]), "bins": sample.bins, "views": made, "both": merged}


def packed(lexicon: dict) -> dict:
    return {**lexicon, "signs": np.flatnonzero(lexicon["signs"])}


KINDS = [(target, view, label) for target in TARGETS for view in ("text", "page") for label in (1, 0)]


def surest(docs: DataFrame, views: dict[str, dict], bins: Bins, taken: np.ndarray, gain: int = GAIN) -> DataFrame:
    """kind (a place in ``KINDS``), doc_id, score: of all rows whose id is not null and
    not among ``taken`` (sorted), the ``gain`` that each view is surest of for each
    label, if it is sure. Of rows with equal scores the one with the least id counts."""
    spark = docs.sparkSession
    edges = {}
    for target, model in views.items():
        low = max((1 - SURE) * model["share"], 1e-9)
        edges[target] = {1: np.log(SURE / (1 - SURE)), 0: -np.log(low / (1 - low))}
    slim = {t: {"lexicon": packed(m["lexicon"]), "weights": m["weights"]} for t, m in views.items()}
    sent = spark.sparkContext.broadcast((slim, bins, taken))

    def best(score: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((ids, -score))
        score, ids = score[order], ids[order]
        first = np.r_[True, score[1:] != score[:-1]][: len(score)]
        return score[first][:gain], ids[first][:gain]

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slim, bins, taken = sent.value
        models = {t: unpacked(m) for t, m in slim.items()}
        held = [(np.zeros(0), np.zeros(0, np.int64)) for _ in KINDS]
        for batch in ta.slices(batches, limit=ta.SLICE // 2):
            ids = batch.column(0).to_numpy().astype(np.int64)
            free = charlm.find(taken, ids) < 0
            column = batch.column(batch.schema.get_field_index("text"))
            seen, page = streams(column), bins(page_view(batch))
            for j, (target, view, label) in enumerate(KINDS):
                if label:
                    x = text_view(column, models[target]["lexicon"], seen) if view == "text" else page
                    # rounded: copies are equal wherever they stand
                    z = np.round(apply(x, models[target]["weights"][view]), 6)
                score = z if label else -z
                good = free & (score >= edges[target][label])
                held[j] = best(np.concatenate([held[j][0], score[good]]), np.concatenate([held[j][1], ids[good]]))
        for j, (score, ids) in enumerate(held):
            if len(ids):
                yield pa.record_batch([pa.array(np.full(len(ids), j, np.int32)), pa.array(ids), pa.array(score)], names=["kind", "doc_id", "score"])

    found = docs.select(*COLUMNS).where(F.col("doc_id").isNotNull()).mapInArrow(ta.freed(draw), "kind int, doc_id bigint, score double")
    found = found.groupBy("kind", "score").agg(F.min("doc_id").alias("doc_id"))
    first = F.row_number().over(Window.partitionBy("kind").orderBy(F.col("score").desc()))
    return found.withColumn("_place", first).where(F.col("_place") <= gain).drop("_place")


def rows_with(docs: DataFrame, ids: list[int]) -> pa.Table:
    """The rows of some ids, in their order; of rows that share an id the one whose
    text has the least hash."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = docs.sparkSession.createDataFrame([(i,) for i in ids], f"doc_id {kind}")
    rows = docs.select(*COLUMNS).join(F.broadcast(wanted), "doc_id")  # at most 8 * GAIN ids
    one = rows.groupBy("doc_id").agg(F.min_by(F.struct(*COLUMNS[1:]), F.xxhash64("text", "lang", "source", "n_chars")).alias("row"))
    return one.select("doc_id", *[F.col(f"row.{c}").alias(c) for c in COLUMNS[1:]]).toArrow().sort_by("doc_id")


def unpacked(model: dict) -> dict:
    signs = np.zeros(1 << 24, dtype=bool)
    signs[model["lexicon"]["signs"]] = True
    return {**model, "lexicon": {**model["lexicon"], "signs": signs}}


def rates(models: dict, batch: pa.RecordBatch) -> list[np.ndarray]:
    """Per target the chance by the text view, the page view and both."""
    column = batch.column(batch.schema.get_field_index("text"))
    seen, page = streams(column), page_view(batch)
    return [combined(m, text_view(column, m["lexicon"], seen), m["bins"](page)) for m in models.values()]


def combined(model: dict, *parts: np.ndarray) -> np.ndarray:
    z = [apply(apply(x, w)[:, None] / 5, c) for x, (w, c) in zip(parts, model["views"], strict=True)]
    return np.stack([chance(z[0]), chance(z[1]), chance(apply(np.stack(z, axis=1) / 5, model["both"]))], axis=1)


COLUMNS = ("doc_id", "lang", "source", "n_chars", "text")


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS, gain: int = GAIN) -> dict | None:
    """One model per target; None without labels."""
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    labels = labels.groupBy("doc_id").agg(F.min("quality").alias("_quality"), F.max("toxic").alias("_toxic"))
    n_labels = labels.count()
    if not n_labels:
        return None
    draw = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    # about ``labelled`` rows: a bounded broadcast
    some = F.broadcast(labels.where(draw < labelled / n_labels))
    rows = docs.select(*COLUMNS).where(F.col("doc_id").isNotNull())
    sample = rows.join(some, "doc_id").select(*COLUMNS, "_quality", "_toxic").toArrow()
    if not sample.num_rows:
        return None
    order = np.argsort(sample["doc_id"].to_numpy(), kind="stable")
    sample = sample.take(pa.array(order))
    ids = sample["doc_id"].to_numpy().astype(np.int64)
    apart = (ta.mix(ids.astype(np.uint64) + ta.U(99)) >> ta.U(11)).astype(np.float64) * 2.0**-53 < APART
    truths = {"low": (sample["_quality"].to_numpy() == 0).astype(int), "toxic": (sample["_toxic"].to_numpy() > 0).astype(int)}
    sample, bins = sample.select(list(COLUMNS)), None
    given = {t: {v: np.full(len(ids), -1) for v in ("text", "page")} for t in TARGETS}
    for step in range(rounds + 1):
        held = Sample(sample, bins)
        bins = held.bins
        views = {t: fitted(held, truths[t], apart, given[t]) for t in TARGETS}
        if step == rounds:
            break
        del held
        ta.give_back()
        drawn = surest(docs, views, bins, np.unique(ids), gain).collect()  # at most 8 * gain small rows
        if not drawn:
            held = Sample(sample, bins)
            break
        more = rows_with(docs, sorted({r["doc_id"] for r in drawn}))
        fresh = more["doc_id"].to_numpy().astype(np.int64)
        ids, apart = np.concatenate([ids, fresh]), np.concatenate([apart, np.zeros(len(fresh), bool)])
        for t in TARGETS:
            truths[t] = np.concatenate([truths[t], np.full(len(fresh), -1)])
            given[t] = {v: np.concatenate([g, np.full(len(fresh), -1)]) for v, g in given[t].items()}
        for r in drawn:
            target, view, label = KINDS[r["kind"]]
            given[target]["page" if view == "text" else "text"][len(ids) - len(fresh) + int(np.searchsorted(fresh, r["doc_id"]))] = label
        sample = pa.concat_tables([sample, more.select(list(COLUMNS)).cast(sample.schema)])
    models = {t: calibrated(held, views[t], truths[t], apart) for t in TARGETS}
    del sample, held, views
    ta.give_back()
    return models


def judge(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """doc_id, p_low, p_toxic, p_low_text, p_low_page, p_toxic_text, p_toxic_page,
    rejected for every row; rejected from a probability of ``LIMIT`` on. ``doc_id`` is a
    whole number.

    Reads doc_id, lang, source, n_chars and text of ``docs`` and doc_id, quality,
    toxic of ``labels``. Labels with a null count as none; of repeated labels the
    worse holds. A null text is empty and has no words; null lang, source or n_chars
    are a value of their own. Null ids are scored, but never learned from. Repeated
    rows get equal answers. Without labels all probabilities are 0 and nothing is
    rejected; an empty table gives no rows.
    """
    spark = docs.sparkSession
    common.ship(spark)
    model = fit(docs, labels, labelled)
    sent = spark.sparkContext.broadcast(model)  # bounded by the sample
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["p_low", "p_toxic", "p_low_text", "p_low_page", "p_toxic_text", "p_toxic_page"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = {name: unpacked(m) for name, m in sent.value.items()} if sent.value else None
        for batch in ta.slices(batches, limit=ta.SLICE // 2):
            low, toxic = rates(model, batch) if model else [np.zeros((batch.num_rows, 3))] * 2
            p = [low[:, 2], toxic[:, 2], low[:, 0], low[:, 1], toxic[:, 0], toxic[:, 1]]
            rejected = (p[0] >= LIMIT) | (p[1] >= LIMIT)
            yield pa.record_batch([batch.column(0), *map(pa.array, p), pa.array(rejected)], names=["doc_id", *names, "rejected"])

    return docs.select(*COLUMNS).mapInArrow(ta.freed(score), f"doc_id {kind}, " + ", ".join(f"{n} double" for n in names) + ", rejected boolean")


def kept(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """The rows of ``docs``, all columns, that are not rejected. Scoring and choice
    are one scan; a column named rejected may be among the others."""
    spark = docs.sparkSession
    common.ship(spark)
    model = fit(docs, labels, labelled)
    if model is None:
        return docs
    sent = spark.sparkContext.broadcast(model)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = {name: unpacked(m) for name, m in sent.value.items()}
        for batch in ta.slices(batches, limit=ta.SLICE // 2):
            worst = np.maximum(*(p[:, 2] for p in rates(model, batch)))
            yield batch.filter(pa.array(worst < LIMIT))

    return docs.mapInArrow(ta.freed(choose), docs.schema)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return judge(common.table(spark, folder, "documents"), common.table(spark, folder, "labels"))
