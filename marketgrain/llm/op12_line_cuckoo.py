"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

An index holds two tables. ``counts`` has the number of documents of every line
key, exactly; ``filters`` has one cuckoo filter a shard with the keys that enough
documents share. Documents are inserted by adding their keys' counts and deleted by
taking them off again; a key that crosses the limit on the way enters its shard's
filter or leaves it, so any sequence of insertions and deletions can be undone and
ends in the index of the documents that are left.

A filter may hold a key that is not in it. All keys that can be asked are in
``counts``, so while a filter is written the rarer keys of its shard pass by and
those that it holds by mistake are listed beside it: filter and list together
answer exactly, and documents are cleaned in one scan without moving their text.
Filters and lists travel to the tasks whole while they are under ``SENT_BYTES``;
beyond, the documents' keys travel to the shards instead and meet the same filters.

A line's key is 128 bits of hash of the line without white space at its ends and
with A-Z as a-z. Only keys and counts are shuffled, combined in each task first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketgrain.llm import common
from marketgrain.llm import textarrays as ta

SHARD_BITS = 10  # 1,024 shards at any size
MIN_CHARS = 1
MIN_DOCS = 10
SLOTS = 4
FULL = 0.85  # share of a new filter's slots that may be taken
KICKS = 400
SENT_BYTES = 64 << 20
SALTS = 16
U = np.uint64
SECOND = np.random.default_rng(7041).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
KEY = "h1 bigint, h2 bigint"


# lines and their keys


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, number of lines a text): texts split at line feeds."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    return starts, ends, np.diff(np.searchsorted(breaks, offsets)) + 1


def stripped(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lines without white space at their ends; one of white space alone is empty."""
    solid = np.flatnonzero(~ta.SPACE[data])
    if not len(solid):
        return starts, starts
    first = np.searchsorted(solid, starts)
    last = np.searchsorted(solid, ends) - 1
    some = first <= last
    low = np.where(some, solid[np.minimum(first, len(solid) - 1)], starts)
    return low, np.where(some, solid[np.maximum(last, 0)] + 1, starts)


def keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(h1, h2, whether the key is long enough) of every line, hashed in runs of
    lines of about two megabytes; a longer line is a run of its own."""
    starts, ends = stripped(data, starts, ends)
    h1, h2 = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    enough, at = np.zeros(len(starts), bool), 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + ta.SLICE, "right")))
        low = starts[at]
        piece, s, e = ta.LOWER[data[low : ends[stop - 1]]], starts[at:stop] - low, ends[at:stop] - low
        h1[at:stop], h2[at:stop] = ta.spans(piece, s, e), ta.spans(piece, s, e, SECOND)
        points = np.concatenate([[0], np.cumsum((piece & 0xC0) != 0x80)])
        enough[at:stop] = points[e] - points[s] >= max(min_chars, 1)
        at = stop
    return h1, h2, enough


def distinct(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of parallel arrays, and how often each occurs."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.diff(np.append(at, len(order)))


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def line_counts(docs: DataFrame, min_chars: int) -> DataFrame:
    """h1, h2, n: in how many rows of ``docs`` a line with that key stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in ta.slices(batches):
            data, offsets = ta.flat(rows.column(0))
            starts, ends, n = lines(data, offsets)
            h1, h2, enough = keys(data, starts, ends, min_chars)
            row = np.repeat(np.arange(len(n)), n)[enough]
            (_, h1, h2), _ = distinct(row, h1[enough], h2[enough])
            (h1, h2), n = distinct(h1, h2)
            yield pa.record_batch([signed(h1), signed(h2), pa.array(n.astype(np.int64))], names=["h1", "h2", "n"])

    return docs.select("text").mapInArrow(count, f"{KEY}, n bigint").groupBy("h1", "h2").agg(F.sum("n").alias("n"))


# the filter


class Cuckoo:
    """A cuckoo filter of 16-bit prints in buckets of four, worked on in whole arrays."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @classmethod
    def of_size(cls, keys: int) -> Cuckoo:
        buckets = 1
        while buckets * SLOTS * FULL < keys:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, h1: np.ndarray, h2: np.ndarray) -> Cuckoo:
        """A new filter with these different keys, as large as it needs to be."""
        made = cls.of_size(len(h1))
        while not made.insert(h1, h2):
            made = cls(np.zeros((len(made.slots) * 2, SLOTS), np.uint16))
        return made

    @classmethod
    def read(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def places(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return prints(h2), (h1 & U(len(self.slots) - 1)).astype(np.int64)

    def other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """A print's second bucket, whose second bucket is the first."""
        return bucket ^ (ta.mix(mark.astype(np.uint64)) & U(len(self.slots) - 1)).astype(np.int64)

    def _settle(self, mark: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put prints into free slots of their buckets; those without one come back."""
        for slot in range(SLOTS):
            free = np.flatnonzero(self.slots[bucket, slot] == 0)
            _, first = np.unique(bucket[free], return_index=True)
            put = free[first]
            self.slots[bucket[put], slot] = mark[put]
            left = np.ones(len(mark), bool)
            left[put] = False
            mark, bucket = mark[left], bucket[left]
        return mark, bucket

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> bool:
        """Whether all keys found room. If not, the filter is to be made anew."""
        mark, bucket = self._settle(*self.places(h1, h2))
        bucket = self.other(mark, bucket)
        for kick in range(KICKS):
            mark, bucket = self._settle(mark, bucket)
            if not len(mark):
                return True
            # one print a bucket takes a slot there, its print moves to its other bucket
            _, first = np.unique(bucket, return_index=True)
            slot = (kick + bucket[first]) % SLOTS
            out = self.slots[bucket[first], slot].copy()
            self.slots[bucket[first], slot] = mark[first]
            mark[first] = out
            bucket = self.other(mark, bucket)
        return False

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Take out keys that were inserted."""
        mark, bucket = self.places(h1, h2)
        left = np.ones(len(mark), bool)
        for target in (bucket, self.other(mark, bucket)):
            while True:
                open_ = np.flatnonzero(left)
                hit = self.slots[target[open_]] == mark[open_, None]
                rows = np.flatnonzero(hit.any(axis=1))
                if not len(rows):
                    break
                place = target[open_[rows]] * SLOTS + hit[rows].argmax(axis=1)
                _, first = np.unique(place, return_index=True)
                self.slots.reshape(-1)[place[first]] = 0
                left[open_[rows[first]]] = False
        if left.any():
            raise ValueError("a key that was never inserted was to be deleted")

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        mark, bucket = self.places(h1, h2)
        second = self.other(mark, bucket)
        return ((self.slots[bucket] == mark[:, None]) | (self.slots[second] == mark[:, None])).any(axis=1)


def prints(h2: np.ndarray) -> np.ndarray:
    mark = (h2 >> U(48)).astype(np.uint16)
    mark[mark == 0] = 1
    return mark


class Members:
    """Exact membership in all shards: their filters as one array, and the mistakes."""

    def __init__(self, shards: list[int], slots: list[bytes], h1: np.ndarray, h2: np.ndarray):
        parts = [np.frombuffer(s, np.uint16).reshape(-1, SLOTS) for s in slots]
        empty = np.zeros((1, SLOTS), np.uint16)  # the bucket of shards without a filter
        self.slots = np.concatenate([empty, *parts])
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self.first = np.zeros(1 << SHARD_BITS, np.int64)
        self.mask = np.zeros(1 << SHARD_BITS, np.uint64)
        self.first[shards] = 1 + np.cumsum(sizes) - sizes
        self.mask[shards] = (sizes - 1).astype(np.uint64)
        order = np.lexsort((h2, h1))
        self.wrong1, self.wrong2 = h1[order], h2[order]

    def __call__(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        shard = (h1 >> U(64 - SHARD_BITS)).astype(np.int64)
        mark, mask, base = prints(h2), self.mask[shard], self.first[shard]
        one = h1 & mask
        two = one ^ (ta.mix(mark.astype(np.uint64)) & mask)
        found = np.zeros(len(h1), bool)
        for bucket in (one, two):
            found |= (self.slots[base + bucket.astype(np.int64)] == mark[:, None]).any(axis=1)
        asked = np.flatnonzero(found)
        low, high = (np.searchsorted(self.wrong1, h1[asked], side) for side in ("left", "right"))
        for i in np.flatnonzero(low < high):
            found[asked[i]] = h2[asked[i]] not in self.wrong2[low[i] : high[i]]
        return found


# the index

OLD, STAY, RISE, FALL, RARE = range(5)  # what a row tells a shard, in this order


def shard_of(h1: str = "h1"):
    return F.shiftrightunsigned(h1, 64 - SHARD_BITS).cast("int")


def _write_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (shard, kind, slots, h1, h2) to filters and their mistakes.

    The frequent keys of a shard are held; the rare ones, far more, pass by.
    """
    shard, made, old, held = None, None, None, {}

    def finish():
        stay, rise, fall = (held.get(k, (np.zeros(0, np.uint64),) * 2) for k in (STAY, RISE, FALL))
        if old is not None:
            made = Cuckoo.read(old)
            made.delete(*fall)
            if made.insert(*rise):
                return made
        return Cuckoo.of(*(np.concatenate([a, b]) for a, b in zip(stay, rise, strict=True)))

    def row(slots, h1, h2):
        n = len(h1) if slots is None else 1
        filled = [pa.array([slots] * n, pa.binary())]
        filled += [pa.nulls(1, pa.int64())] * 2 if slots is not None else [signed(h1), signed(h2)]
        return pa.record_batch([pa.array([shard] * n, pa.int32()), *filled], names=["shard", "slots", "h1", "h2"])

    for batch in batches:
        code = batch.column(0).to_numpy().astype(np.int64) * 8 + batch.column(1).to_numpy()
        edges = np.flatnonzero(np.diff(code)) + 1
        for start, stop in zip(np.append(0, edges), np.append(edges, len(code)), strict=True):
            if stop == start:
                continue
            now, kind = divmod(int(code[start]), 8)
            if now != shard:
                if shard is not None and made is None:
                    yield row(finish().slots.tobytes(), None, None)
                shard, made, old, held = now, None, None, {}
            if kind == OLD:
                old = batch.column(2)[int(start)].as_py()
                continue
            h1, h2 = (unsigned(batch.column(i).slice(start, stop - start)) for i in (3, 4))
            if kind != RARE:
                more = held.get(kind)
                held[kind] = (h1, h2) if more is None else tuple(np.concatenate([a, b]) for a, b in zip(more, (h1, h2), strict=True))
                continue
            if made is None:
                made = finish()
                yield row(made.slots.tobytes(), None, None)
            wrong = made.holds(h1, h2)
            if wrong.any():
                yield row(None, h1[wrong], h2[wrong])
    if shard is not None and made is None:
        yield row(finish().slots.tobytes(), None, None)


class LineIndex:
    """Line keys of a set of documents with exact counts; every change is a new index,
    so an earlier one stays as it was.

    Every row of the documents counts as a document, repeated rows, null and repeated
    ids too. A null text is an empty one. The empty key is never counted or dropped.
    """

    def __init__(self, counts: DataFrame, filters: DataFrame, min_docs: int, min_chars: int):
        self.counts, self.filters = counts, filters
        self.min_docs, self.min_chars = min_docs, min_chars

    @classmethod
    def empty(cls, spark: SparkSession, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> LineIndex:
        common.ship(spark)
        counts = spark.createDataFrame([], f"{KEY}, n bigint")
        return cls(counts, spark.createDataFrame([], f"shard int, slots binary, {KEY}"), min_docs, min_chars)

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._changed(line_counts(docs, self.min_chars))

    def delete(self, docs: DataFrame) -> LineIndex:
        """Without these documents, which must have been inserted."""
        return self._changed(line_counts(docs, self.min_chars).withColumn("n", -F.col("n")))

    def _changed(self, delta: DataFrame) -> LineIndex:
        rows = self.counts.select("h1", "h2", "n", F.lit(0).cast("bigint").alias("more"))
        rows = rows.unionAll(delta.select("h1", "h2", F.lit(0).cast("bigint"), "n"))
        total = rows.groupBy("h1", "h2").agg(F.sum("n").alias("before"), F.sum("more").alias("more"))
        after = F.col("before") + F.col("more")
        checked = F.when(after < 0, F.raise_error(F.lit("a document that was never inserted was to be deleted"))).otherwise(after)
        was, now = F.col("before") >= self.min_docs, F.col("n") >= self.min_docs
        kind = F.when(was & now, STAY).when(now, RISE).when(was, FALL).otherwise(RARE)
        whole = total.withColumn("n", checked).select("h1", "h2", "n", kind.alias("kind"), shard_of().alias("shard"))
        whole = common.stored(whole, "line-counts")
        tell = whole.select("shard", "kind", F.lit(None).cast("binary").alias("slots"), "h1", "h2")
        # a key that fell is rare now, and the filter may still seem to hold it
        fell = whole.where(F.col("kind") == FALL).select("shard", F.lit(RARE), F.lit(None).cast("binary"), "h1", "h2")
        old = self.filters.where("slots is not null").select("shard", F.lit(OLD), "slots", "h1", "h2")
        told = tell.unionAll(fell).unionAll(old).repartition("shard").sortWithinPartitions("shard", "kind")
        filters = common.stored(told.mapInArrow(_write_filters, f"shard int, slots binary, {KEY}"), "line-filters")
        return LineIndex(whole.where("n > 0").select("h1", "h2", "n"), filters, self.min_docs, self.min_chars)

    def size(self) -> int:
        """Bytes of all filters and mistakes."""
        size = F.sum(F.coalesce(F.length("slots"), F.lit(0)) + 16)
        return int(self.filters.agg(size.alias("b")).first()["b"] or 0)

    def report(self, docs: DataFrame, sent_bytes: int = SENT_BYTES) -> DataFrame:
        """doc_id, n_lines, n_dropped, kept_sha256 of every row of ``docs``."""
        kind = docs.schema["doc_id"].dataType.simpleString()
        return self._apply(docs.select("doc_id", "text"), _report, f"doc_id {kind}, n_lines bigint, n_dropped bigint, kept_sha256 string", sent_bytes)

    def cleaned(self, docs: DataFrame, sent_bytes: int = SENT_BYTES) -> DataFrame:
        """All columns of ``docs``, ``text`` without the lines that enough documents
        share. A null text stays null."""
        return self._apply(docs, _clean, docs.schema, sent_bytes)

    def _apply(self, docs: DataFrame, result: Callable, schema, sent_bytes: int) -> DataFrame:
        min_chars, place = self.min_chars, docs.columns.index("text")
        if self.size() <= sent_bytes:
            found = self.filters.toArrow()
            full, wrong = found.filter(found["slots"].is_valid()), found.filter(found["slots"].is_null())
            members = Members(full["shard"].to_pylist(), full["slots"].to_pylist(), unsigned(wrong["h1"].combine_chunks()), unsigned(wrong["h2"].combine_chunks()))
            sent = docs.sparkSession.sparkContext.broadcast(members)  # at most sent_bytes

            def one_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for rows in ta.slices(batches):
                    yield result(rows, place, min_chars, lambda h1, h2, n: sent.value(h1, h2))

            return docs.mapInArrow(one_scan, schema)
        return self._by_shard(docs, result, schema, place)

    def _by_shard(self, docs: DataFrame, result: Callable, schema, place: int) -> DataFrame:
        """The same with the keys of different texts sent to the filters. What a text
        loses depends on the text alone, so it is looked up by the text's SHA-256."""
        min_chars = self.min_chars
        print_of = lambda c: F.unhex(F.sha2(F.coalesce(c, F.lit("")), 256))

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in ta.slices(batches):
                data, offsets = ta.flat(rows.column(0))
                starts, ends, n = lines(data, offsets)
                h1, h2, enough = keys(data, starts, ends, min_chars)
                (row, h1, h2), _ = distinct(np.repeat(np.arange(len(n)), n)[enough], h1[enough], h2[enough])
                yield pa.record_batch([rows.column(1).take(pa.array(row)), signed(h1), signed(h2)], names=["print", "h1", "h2"])

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, members = None, None
            for batch in batches:
                code = batch.column(0).to_numpy().astype(np.int64) * SALTS + batch.column(1).to_numpy()
                edges = np.flatnonzero(np.diff(code)) + 1
                for start, stop in zip(np.append(0, edges), np.append(edges, len(code)), strict=True):
                    rows = batch.slice(start, stop - start)
                    if not rows.num_rows:
                        continue
                    if code[start] != now:
                        now, shard, slots, h1, h2 = code[start], rows.column(0)[0].as_py(), [], [], []
                        members = None
                    kinds = rows.column(2).to_numpy()
                    for i in np.flatnonzero(kinds < 2):
                        if kinds[i] == 0:
                            slots.append(rows.column(3)[int(i)].as_py())
                        else:
                            h1.append(rows.column(5)[int(i)].as_py())
                            h2.append(rows.column(6)[int(i)].as_py())
                    asked = rows.filter(pa.array(kinds == 2))
                    if asked.num_rows:
                        if members is None:
                            wrong = (np.array(h, dtype=np.int64).view(np.uint64) for h in (h1, h2))
                            members = Members([shard] * len(slots), slots, *wrong)
                        found = asked.filter(pa.array(members(unsigned(asked.column(5)), unsigned(asked.column(6)))))
                        yield pa.record_batch([found.column(i) for i in (4, 5, 6)], names=["print", "h1", "h2"])

        # copies of a text ask once; a key that a third of all texts share is spread by salt
        asked = docs.select("text", print_of(F.col("text")).alias("print")).mapInArrow(ask, f"print binary, {KEY}").distinct()
        salt = F.pmod(F.xxhash64("print"), F.lit(SALTS)).cast("int")
        nothing = F.lit(None).cast("binary")
        asked = asked.select(shard_of().alias("shard"), salt.alias("salt"), F.lit(2).alias("kind"), nothing.alias("slots"), "print", "h1", "h2")
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        kind = F.when(F.col("slots").isNotNull(), 0).otherwise(1)
        told = self.filters.select("shard", salts, kind.alias("kind"), "slots", nothing.alias("print"), "h1", "h2")
        met = told.unionAll(asked).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
        lost = met.mapInArrow(answer, f"print binary, {KEY}")
        per_text = lost.groupBy("print").agg(F.collect_list(F.struct("h1", "h2")).alias("lost"))
        per_text = common.stored(per_text, "lost-lines")
        whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), print_of(F.col("text")).alias("print"))
        joined = whole.join(per_text, "print", "left").select("row", "lost")

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                flat = pa.RecordBatch.from_struct_array(batch.column(0))
                whole = pa.record_batch([*flat.columns, batch.column(1)], names=[*map(str, range(flat.num_columns)), "lost"])
                for rows in ta.slices([whole], str(place)):
                    gone = [{(k["h1"], k["h2"]) for k in listed or []} for listed in rows.column(flat.num_columns).to_pylist()]

                    def member(h1, h2, n, gone=gone):
                        row = np.repeat(np.arange(len(n)), n).tolist()
                        pairs = zip(row, h1.view(np.int64).tolist(), h2.view(np.int64).tolist(), strict=True)
                        return np.array([(a, b) in gone[r] for r, a, b in pairs], dtype=bool)

                    named = pa.RecordBatch.from_arrays(rows.columns[:-1], names=flat.schema.names)
                    yield result(named, place, min_chars, member)

        return joined.mapInArrow(apply, schema)


def _kept(rows: pa.RecordBatch, place: int, min_chars: int, member: Callable) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Per text: its lines, those dropped, and what is left."""
    data, offsets = ta.flat(rows.column(place))
    starts, ends, n = lines(data, offsets)
    h1, h2, enough = keys(data, starts, ends, min_chars)
    gone = enough & member(h1, h2, n)
    first = np.cumsum(n) - n
    dropped = np.add.reduceat(gone.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    whole, out = data.tobytes(), []
    for i in range(len(n)):
        if dropped[i]:
            stay = np.flatnonzero(~gone[first[i] : first[i] + n[i]]) + first[i]
            out.append(b"\n".join([whole[s:e] for s, e in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)]))
        else:
            out.append(whole[offsets[i] : offsets[i + 1]])
    return n, dropped, out


def _report(rows: pa.RecordBatch, place: int, min_chars: int, member: Callable) -> pa.RecordBatch:
    n, dropped, left = _kept(rows, place, min_chars, member)
    digests = [hashlib.sha256(text).hexdigest() for text in left]
    columns = [rows.column(0), pa.array(n.astype(np.int64)), pa.array(dropped), pa.array(digests, pa.string())]
    return pa.record_batch(columns, names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def _clean(rows: pa.RecordBatch, place: int, min_chars: int, member: Callable) -> pa.RecordBatch:
    _, _, left = _kept(rows, place, min_chars, member)
    there = rows.column(place).is_valid().to_pylist()
    text = pa.array([t.decode() if v else None for t, v in zip(left, there, strict=True)], rows.column(place).type)
    columns = [text if i == place else c for i, c in enumerate(rows.columns)]
    return pa.RecordBatch.from_arrays(columns, names=rows.schema.names)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents")
    return LineIndex.empty(spark).insert(docs).report(docs)


_BARE = r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"
SQL = rf"""
with docs as (
    select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), split as (
    select r, doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as i from docs
), keyed as (
    select r, doc_id, i, line, translate({_BARE}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from split
), common_keys as (
    select key from keyed where length(key) >= {MIN_CHARS} group by key having count(distinct r) >= {MIN_DOCS}
), marked as (
    select k.r, k.doc_id, k.i, k.line, c.key is not null as gone from keyed k left join common_keys c on k.key = c.key
)
select any_value(doc_id) as doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by r
"""
