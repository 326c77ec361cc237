"""Benchmark passages in documents, by latent semantic retrieval.

Documents are read in overlapping windows of words. A window and a benchmark item
are TF-IDF vectors over the item terms that few windows hold, and the ``RAREST``
terms of each item however many hold them: a passage that leaked into many documents
makes its own words common. A randomised SVD of
all windows' vectors, one distributed pass, gives the latent space: every task adds
up A'(A G) for a random G, and the directions come from the sum (Nystrom), items
counting together as much as all windows. Directions are added until every item
keeps ``RETAINED`` of its length in the space, so the rank grows with the items.
Windows whose cosine with an item in that space reaches ``COSINE`` are candidates; a
window longer than the item counts as long as the item, so that other terms around a
passage don't hide it. A candidate is a hit if the longest common
subsequence of its words and the item's covers the item, and the answer (the item's
last words) too; so paraphrases that drop, add or swap some words are found.

Words are runs of letters in lower case, so signs and case around them don't hide a
passage. Items are taken in blocks of bounded size, each two further scans; idf
counts, the SVD and the search cover all windows.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketgrain.llm import charlm, common
from marketgrain.llm import textarrays as ta

WINDOW = 64  # words
STEP = 32
COMMON = 0.002  # terms that more of the windows hold are left out ...
RAREST = 10  # ... unless they are among so many rarest of a probe
RANK = 192  # before directions are added for the items
RETAINED = 0.95  # of an item's length, at least, in the latent space
COSINE = 0.4
COVER = 0.6  # of an item's words in order
ANSWER = 0.5  # of the answer's words in order
ANSWER_SHARE = 0.25  # of an item, its last words
PROBE = 48  # words; longer items are looked for in parts of this size
BLOCK = 400  # probes a block; the rank grows with it
ITEM_BYTES = 1 << 20  # of item texts that are collected at once (a longer one alone)
PAIRS = 2_000_000  # pairs of terms a task holds
IMAGE = 4_000_000  # numbers of windows' images held at once
ROWS_A_SUM = 16


def lower_letters(data: np.ndarray) -> np.ndarray:
    """A-Z and the capitals U+00C0 to U+00DE in lower case."""
    out = ta.LOWER[data]
    lead = np.zeros(len(data), dtype=bool)
    lead[1:] = data[:-1] == 0xC3
    return np.where(lead & (data >= 0x80) & (data <= 0x9E) & (data != 0x97), data + 0x20, out).astype(np.uint8)


def words_of(column):
    """(row, hash) of every word of the texts."""
    data, offsets = ta.flat(column)
    _, _, row, key = ta.words(lower_letters(data), offsets, breaks=ta.NO_LETTER)
    return row, key


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows of each text, first window of each text) for word counts; a text
    without words has none."""
    n = np.where(counts > 0, np.maximum(1, -(-(counts - WINDOW) // STEP) + 1), 0)
    return n, np.cumsum(n) - n


def entries(row: np.ndarray, term: np.ndarray, texts: int):
    """(window, term, times) of the words that are terms (term >= 0), sorted; and
    the windows of each text with their first."""
    counts = np.bincount(row, minlength=texts) if len(row) else np.zeros(texts, np.int64)
    n, first = windows(counts)
    place = np.arange(len(row)) - (np.cumsum(counts) - counts)[row]
    hit = np.flatnonzero(term >= 0)
    late = np.minimum(place[hit] // STEP, n[row[hit]] - 1)
    early = late - 1
    both = (early >= 0) & (place[hit] < early * STEP + WINDOW)
    window = first[row[hit]] + late
    key = np.concatenate([window, window[both] - 1]) << 32 | np.concatenate([term[hit], term[hit][both]])
    key, times = np.unique(key, return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, times, n, first


class Items:
    """A block of benchmark items: words, terms and probes."""

    def __init__(self, ids: list, texts: list[str]):
        row, key = words_of(pa.array(texts, pa.string()))
        self.ids = ids
        self.words = [key[row == i] for i in range(len(ids))]
        self.terms = np.unique(key)
        starts = [(i, a) for i, w in enumerate(self.words) for a in range(0, max(1, len(w) - PROBE // 2), PROBE // 2 if len(w) > PROBE else len(w) or 1)]
        self.probes = [(i, self.words[i][a : a + PROBE]) for i, a in starts if len(self.words[i])]

    def blocks(self, limit: int) -> Iterator[Items]:
        """The same items by about so many probes at a time, with those probes' terms.
        Only an item of more probes than that is divided."""
        of_item: dict[int, list] = {}
        for probe in self.probes:
            of_item.setdefault(probe[0], []).append(probe)
        part: list[tuple] = []
        for i in range(len(self.words)):
            mine = of_item.get(i, [])
            if part and len(part) + len(mine) > limit:
                yield self._only(part)
                part = []
            part += mine
            while len(part) > limit:
                yield self._only(part[:limit])
                part = part[limit:]
        if part:
            yield self._only(part)

    def _only(self, probes: list[tuple]) -> Items:
        block = copy.copy(self)
        block.probes = probes
        block.terms = np.unique(np.concatenate([words for _, words in probes]))
        return block

    def searched(self) -> SimpleNamespace:
        """What the search needs: the items' words, but no matrix."""
        return SimpleNamespace(terms=self.terms, idf=self.idf, size=self.size, words=self.words, ids=self.ids, probes=[(i, None) for i, _ in self.probes])

    def vocabulary(self) -> SimpleNamespace:
        """What the windows' vectors need."""
        return SimpleNamespace(terms=self.terms, idf=self.idf)

    def chosen(self, held: np.ndarray, total: int) -> np.ndarray:
        """Which terms the vectors have, if so many of all windows hold them: those
        that few hold, and the rarest of every probe."""
        out = (held <= COMMON * total) | (held <= 4)
        for _, words in self.probes:
            at = np.unique(charlm.find(self.terms, words))
            out[at[np.argsort(held[at], kind="stable")[:RAREST]]] = True
        return out

    def keep(self, terms: np.ndarray, idf: np.ndarray) -> None:
        """Restrict the vectors to these terms (sorted hashes)."""
        self.terms, self.idf = terms, idf
        rows, cols, values = [], [], []
        for j, (_, words) in enumerate(self.probes):
            at = charlm.find(terms, words)
            found, times = np.unique(at[at >= 0], return_counts=True)
            rows += [j] * len(found)
            cols += found.tolist()
            values += weigh(times, idf[found]).tolist()
        self.matrix = np.zeros((len(self.probes), len(terms)))
        self.matrix[rows, cols] = values
        self.size = np.linalg.norm(self.matrix, axis=1)
        self.matrix /= np.maximum(self.size, 1e-12)[:, None]


def weigh(times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(times)) * idf


def window_vectors(column, items: Items):
    """(row, key, window, term, value, windows, first, size): unit TF-IDF vectors of
    the windows, as entries sorted by window, and the lengths they had."""
    row, key = words_of(column)
    window, term, times, n, first = entries(row, find(items.terms, key), len(column))
    value = weigh(times, items.idf[term])
    total = int(n.sum())
    size = np.sqrt(np.bincount(window, weights=value * value, minlength=total)) if len(window) else np.zeros(total)
    return row, key, window, term, value / np.maximum(size, 1e-12)[window], n, first, size


def times_matrix(window: np.ndarray, term: np.ndarray, value: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows that have terms, those with many terms first; their vectors times a
    matrix), summed term by term over all windows that have so many."""
    heads = np.flatnonzero(np.r_[True, window[1:] != window[:-1]]) if len(window) else window
    lengths = np.diff(np.append(heads, len(window)))
    order = np.argsort(-lengths, kind="stable")
    heads, lengths = heads[order], lengths[order]
    out = np.zeros((len(heads), matrix.shape[1]), matrix.dtype)
    value = value.astype(matrix.dtype)
    for k in range(int(lengths[0]) if len(lengths) else 0):
        at = heads[: int(np.searchsorted(-lengths, -k, "left"))] + k
        out[: len(at)] += matrix[term[at]] * value[at, None]
    return window[heads], out


def find(terms: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where each key stands in the sorted terms, or -1. Most keys are none of the
    terms, and a table of their last bits tells so at once."""
    out = np.full(len(key), -1, dtype=np.int64)
    table = np.zeros(1 << 16, dtype=bool)
    table[terms & ta.U(0xFFFF)] = True
    some = np.flatnonzero(table[key & ta.U(0xFFFF)])
    out[some] = charlm.find(terms, key[some])
    return out


def runs(window: np.ndarray, limit: int = 60_000) -> Iterator[slice]:
    """Slices of entries that keep windows whole, to bound the memory."""
    low = 0
    while low < len(window):
        high = min(len(window), low + limit)
        if high < len(window):
            high = max(int(np.searchsorted(window, window[high], "left")), int(np.searchsorted(window, window[low], "right")))
        yield slice(low, high)
        low = high


def document_frequency(docs: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """How many windows of all documents hold each term, and how many there are."""
    sent = docs.sparkSession.sparkContext.broadcast(items.terms)  # of one block

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = sent.value
        held, total = np.zeros(len(terms) + 1, dtype=np.int64), 0
        for batch in ta.slices(batches, limit=ta.SLICE // 2):
            row, key = words_of(batch.column(0))
            _, term, _, n, _ = entries(row, find(terms, key), batch.num_rows)
            held[: len(terms)] += np.bincount(term, minlength=len(terms))
            held[-1] += n.sum()
        some = np.flatnonzero(held)
        yield pa.record_batch([pa.array(some), pa.array(held[some])], names=["term", "n"])

    found = docs.select("text").mapInArrow(ta.freed(count), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(items.terms) + 1, dtype=np.int64)
    out[found["term"].to_numpy()] = found["n"].to_numpy()
    return out[:-1], int(out[-1])


def pairs_of(window: np.ndarray, term: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(i * n + j, product) for all terms i <= j of a window, window by window."""
    ends = np.searchsorted(window, window, "right")
    at = np.arange(len(window))
    first, second = np.repeat(at, ends - at), ta.gather(at, ends - at)
    return term[first] * n + term[second], value[first] * value[second]


def by_key(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and the sums of their values."""
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[heads], np.add.reduceat(value, heads)


def latent_space(docs: DataFrame, items: Items, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """Right singular vectors (terms x rank) of the windows' matrix with the items.

    A'(A G) is (A'A) G: windows hold few terms, so their products are summed by
    pair of terms first, and the few sums meet the random matrix.
    """
    n = len(items.terms)
    width = min(n, rank + 16)
    random = np.random.default_rng(seed).normal(size=(n, width))
    spark = docs.sparkSession
    slim, sent = spark.sparkContext.broadcast(items.vocabulary()), spark.sparkContext.broadcast(random.astype("<f4"))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, seen, held, kept = slim.value, 0, 0, []

        def flush():
            key, value = by_key(*(np.concatenate(c) for c in zip(*kept, strict=True)))
            return key, value

        for batch in ta.slices(batches, limit=ta.SLICE // 2):
            _, _, window, term, value, _, _, _ = window_vectors(batch.column(0), items)
            seen += len(np.unique(window))
            for part in runs(window):
                kept.append(by_key(*pairs_of(window[part], term[part], value[part], n)))
                held += len(kept[-1][0])
            if held > PAIRS:
                kept = [flush()]
                held = len(kept[0][0])
                if held > PAIRS // 2:  # pass them on and begin anew
                    yield pa.record_batch([pa.array(kept[0][0]), pa.array(kept[0][1])], names=["pair", "total"])
                    kept, held = [], 0
        if kept:
            key, value = flush()
            yield pa.record_batch([pa.array(key), pa.array(value)], names=["pair", "total"])
        if seen:
            yield pa.record_batch([pa.array([-1]), pa.array([float(seen)])], names=["pair", "total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, out, seen = sent.value, None, 0.0
        for batch in batches:
            pair, total = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            seen += float(total[pair < 0].sum())
            pair, total = pair[pair >= 0], total[pair >= 0]
            out = np.zeros(random.shape) if out is None else out
            i, j = pair // n, pair % n
            other = i != j
            for to, by, c in ((i, j, total), (j[other], i[other], total[other])):
                order = np.argsort(to, kind="stable")
                for a in range(0, len(to), 60_000):
                    rows = order[a : a + 60_000]
                    target = to[rows]
                    if len(target):
                        heads = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
                        out[target[heads]] += np.add.reduceat(random[by[rows]] * c[rows, None].astype(np.float32), heads, axis=0)
        if out is None:
            return
        for a in range(0, len(out), ROWS_A_SUM):
            part = out[a : a + ROWS_A_SUM]
            if part.any() or (a == 0 and seen):
                yield pa.record_batch([pa.array([a // ROWS_A_SUM]), pa.array([seen if a == 0 else 0.0]), pa.array([part.astype("<f4").tobytes()], pa.binary())], names=["part", "seen", "sums"])

    def total(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, sums = 0, 0.0, None
        for batch in group:
            for p, s, blob in zip(*(batch.column(i) for i in range(3)), strict=True):
                part, seen, more = p.as_py(), seen + s.as_py(), np.frombuffer(blob.as_buffer(), "<f4")
                sums = more.astype(np.float64) if sums is None else sums + more
        yield pa.record_batch([pa.array([part]), pa.array([seen]), pa.array([sums.astype("<f4").tobytes()], pa.binary())], names=["part", "seen", "sums"])

    schema = "part bigint, seen double, sums binary"
    met = docs.select("text").mapInArrow(ta.freed(products), "pair bigint, total double").groupBy("pair").agg(F.sum("total").alias("total"))
    # a task's sums are one row per few terms: at most one row a task in a group
    found = met.mapInArrow(ta.freed(add), schema).groupBy("part").applyInArrow(total, schema).toArrow()
    image = np.zeros((n, width))
    for p, blob in zip(found["part"].to_pylist(), found["sums"], strict=True):
        rows = np.frombuffer(blob.as_buffer(), "<f4").reshape(-1, width)
        image[p * ROWS_A_SUM : p * ROWS_A_SUM + len(rows)] = rows
    seen = sum(found["seen"].to_pylist())
    weight = max(seen, 1) / max(len(items.probes), 1)
    image += weight * (items.matrix.T @ (items.matrix @ random))
    shift = 1e-7 * max(np.linalg.norm(image), 1e-12)
    image = image + shift * random
    core = random.T @ image
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > values.max(initial=0) * 1e-10
    half = image @ (vectors[:, good] / np.sqrt(values[good]))
    left, _, _ = np.linalg.svd(half, full_matrices=False)
    return holding(left[:, :rank], items.matrix)


def holding(space: np.ndarray, matrix: np.ndarray, least: float = RETAINED) -> np.ndarray:
    """The space with as many more directions as let every row of the matrix keep
    ``least`` of its length: the leading ones of what the space lacks of the rows."""
    rest = matrix - (matrix @ space) @ space.T
    limit = (1 - least**2) * (matrix * matrix).sum(axis=1)
    rest = rest[(rest * rest).sum(axis=1) > limit]
    if not len(rest):
        return space
    values, vectors = np.linalg.eigh(rest @ rest.T)
    good = values > values.max() * 1e-10
    more = ((vectors[:, good] / np.sqrt(values[good])).T @ rest)[::-1]
    lost = (rest * rest).sum(axis=1)[:, None] - np.cumsum((rest @ more.T) ** 2, axis=1)
    done = (lost <= limit.max()).all(axis=0)
    return np.hstack([space, more[: int(done.argmax()) + 1 if done.any() else len(more)].T])


def common_length(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each word of b, whether a longest common subsequence of a and b (both
    hashes) uses it; bits of an integer are the places of a."""
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    full, row, rows = (1 << len(a)) - 1, (1 << len(a)) - 1, []
    for x in b.tolist():
        met = row & places.get(x, 0)
        row = ((row + met) | (row - met)) & full
        rows.append(row)
    used = np.zeros(len(b), dtype=bool)
    i, left = len(a), full
    lengths = lambda r, i: i - (r & ((1 << i) - 1)).bit_count()
    for j in range(len(b) - 1, -1, -1):
        now, before = rows[j], rows[j - 1] if j else full
        while i and lengths(now, i) == lengths(now, i - 1) and lengths(now, i) > lengths(before, i):
            i -= 1
        if i and lengths(now, i) > lengths(before, i):
            used[j] = True
            i -= 1
    del left
    return used


def check(words: np.ndarray, item: np.ndarray) -> tuple[float, float]:
    """(share of the item, share of its answer) in a longest common subsequence."""
    used = common_length(words, item)
    answer = max(1, round(ANSWER_SHARE * len(item)))
    return float(used.mean()), float(used[-answer:].mean())


def hits(docs: DataFrame, items: Items, space: np.ndarray) -> DataFrame:
    """doc_id, item_id, cosine, cover, answer, first_word of the best window of
    every document and item that pass the checks."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    latent = (items.matrix @ space).astype(np.float32)
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    # a window's image times the items' is the sum of its terms' products with them
    nearness = (space.astype(np.float32) @ latent.T).astype(np.float32)
    sent = spark.sparkContext.broadcast((items.searched(), nearness, np.abs(nearness).max(axis=1, initial=0)))
    item_type = pa.array(items.ids).type

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, nearness, most = sent.value
        for batch in ta.slices(batches, limit=ta.SLICE // 2):
            row, key, window, term, value, n, first, size = window_vectors(batch.column(1), items)
            # windows whose terms' greatest products together stay below the limit can't be near
            reach = np.bincount(window, weights=value * most[term], minlength=len(size)) * (1 + 1e-4)
            near_enough = reach * size >= COSINE * np.minimum(size, items.size[items.size > 0].min(initial=np.inf))
            stay = near_enough[window]
            window, term, value = window[stay], term[stay], value[stay]
            best: dict[tuple[int, int], tuple] = {}
            starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))])
            for part in runs(window, max(1000, IMAGE // max(nearness.shape[1], 1))):
                ids, near = times_matrix(window[part], term[part], value[part], nearness)
                # the window's length in all its terms stays, so stray terms don't pass for
                # an item; beyond the item's own length it doesn't count against a passage
                long = size[ids].astype(np.float32)[:, None]
                for w, p in zip(*np.nonzero(near * long >= COSINE * np.minimum(long, items.size.astype(np.float32))), strict=True):
                    doc = int(np.searchsorted(first + n, ids[w], "right"))
                    i = items.probes[p][0]
                    item = items.words[i]
                    middle = starts[doc] + (ids[w] - first[doc]) * STEP
                    low, high = max(starts[doc], middle - len(item)), min(starts[doc + 1], middle + WINDOW + len(item))
                    if np.isin(item, key[low:high]).mean() < COVER:  # no subsequence is longer
                        continue
                    cover, answer = check(key[low:high], item)
                    if cover >= COVER and answer >= ANSWER:
                        found = (cover, answer, float(near[w, p]), -int(low - starts[doc]))
                        best[doc, i] = max(best.get((doc, i), found), found)
            docs, found = [d for d, _ in best], list(best.values())
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(docs, pa.int64())), pa.array([items.ids[i] for _, i in best], item_type),
                    pa.array([f[2] for f in found], pa.float64()), pa.array([f[0] for f in found], pa.float64()),
                    pa.array([f[1] for f in found], pa.float64()), pa.array([-f[3] for f in found], pa.int64()),
                ],
                names=["doc_id", "item_id", "cosine", "cover", "answer", "first_word"],
            )

    name = {"int64": "bigint", "int32": "int", "string": "string"}[str(item_type)]
    schema = f"doc_id {kind}, item_id {name}, cosine double, cover double, answer double, first_word bigint"
    return docs.select("doc_id", "text").mapInArrow(ta.freed(search), schema)


def leaks(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, item_id, cosine, cover, answer, first_word: a row for every document
    row and benchmark item found in it, at its best place.

    Reads doc_id and text of ``docs``, item_id and text of ``benchmark``. Null,
    empty and wordless texts on either side match nothing. Null ids stay. Repeated
    rows and items each give their rows, except that an item of more than ``block``
    parts gives one row for all documents of one id. Empty tables give no rows. Texts
    are read whole.
    """
    spark = docs.sparkSession
    common.ship(spark)
    benchmark = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0]
    name, kind = (f.schema[c].dataType.simpleString() for f, c in ((benchmark, "item_id"), (docs, "doc_id")))
    empty = spark.createDataFrame([], f"doc_id {kind}, item_id {name}, cosine double, cover double, answer double, first_word bigint")
    blocks, found, divided = max(1, -(-int(size or 0) // ITEM_BYTES)), [], []
    for b in range(blocks):
        mine = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).toArrow()
        order = np.argsort(mine["text"].to_numpy(zero_copy_only=False), kind="stable") if mine.num_rows else []
        whole = Items([mine["item_id"][i].as_py() for i in order], [mine["text"][i].as_py() for i in order])
        parts = np.bincount([i for i, _ in whole.probes], minlength=len(whole.ids))
        divided += [whole.ids[i] for i in np.flatnonzero(parts > block)]
        for items in whole.blocks(block):
            held, total = document_frequency(docs, items)
            few = items.chosen(held, total)
            idf = np.log((total + 1) / (held[few] + 1)) + 1
            items.keep(items.terms[few], idf)
            if not len(items.terms) or not items.matrix.any():
                continue
            rows = hits(docs, items, latent_space(docs, items))
            ta.give_back()
            found.append(rows if blocks == 1 and len(whole.probes) <= block else common.stored(rows, "leaks"))
    out = empty if not found else found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    if not divided:
        return out
    best = F.max(F.struct("cover", "answer", "cosine", (-F.col("first_word")).alias("place")))
    once = out.where(F.col("item_id").isin(divided)).groupBy("doc_id", "item_id").agg(best.alias("b"))
    once = once.select("doc_id", "item_id", "b.cosine", "b.cover", "b.answer", (-F.col("b.place")).alias("first_word"))
    return out.where(~F.coalesce(F.col("item_id").isin(divided), F.lit(False))).unionAll(once)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, in which nothing was found. Hits are by
    id, so repeated ids go together; a row without an id is judged by a hash of its
    text. A null text stays. No column name is reserved."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.xxhash64("text").cast("string")))
    found = leaks(docs.select(key.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("key")).distinct()
    found = common.stored(found, "leaks")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    return rows.join(found, "key", "left_anti").select("row.*")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(common.table(spark, folder, "documents"), common.table(spark, folder, "benchmark"))
