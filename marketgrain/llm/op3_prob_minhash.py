"""Near duplicates by ProbMinHash, banding and verification.

A text's shingles are runs of five words (A-Z in lower case), weighted by
1 + log2 of how often they occur. Each shingle is a Poisson process: its points
arrive in ascending order, each at another register, at a rate given by its
weight; a register keeps the shingle of its earliest point. A shingle stops as
soon as its next point is later than all registers of its text, so a long text
takes about one point a shingle. Equal registers of two texts are as likely as
their probability Jaccard similarity.

Registers are hashed in bands; texts with an equal band are candidates, and a pair
is a link if the Jaccard similarity of its shingle sets, computed exactly, is at
least ``THRESHOLD``. Equal word sequences are one node from the start; nodes go by a
number, not by their fingerprint. A pair is first judged by marks of a few bits a
shingle, which bound the sets' difference from below: only sets of pairs that the bound
leaves are sent and compared. Small
buckets give all their pairs. In a bucket of more than ``SMALL`` nodes each node
meets a leader and, in some bands (in buckets of up to ``SLICE`` nodes in all), its
neighbours in the order of the numbers; in
up to ``ROUNDS`` further rounds the leader is the node with the most links so far. So
a large group that hangs together costs a few pairs a node and band, and never all its
pairs. The nodes of large buckets that are still in different groups then meet by
their rare shingles: an exact prefix filter gives every pair of different groups that
can reach the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketgrain.llm import common, graph
from marketgrain.llm import textarrays as ta

WORDS = 5
THRESHOLD = 0.8
REGISTERS = 128
ROWS = 4  # registers a band
SMALL = 12  # nodes of a bucket that gives all its pairs
SLICE = 256  # nodes of a bucket that are put in order at once
GROUP = 64  # sets that are compared with one copy of another
MARK = 1 << 16  # bits of a mark at most
ROUNDS = 2  # further leaders of a large bucket
_C = [ta.U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = WORDS):
    """(row, hash) of every shingle, and per text two hashes of its words.

    A text of fewer words is one shingle; one without words has none."""
    n = len(offsets) - 1
    starts, ends, row, words = ta.words(data, offsets)
    count = np.bincount(row, minlength=n) if len(row) else np.zeros(n, np.int64)
    with np.errstate(over="ignore"):
        out = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
        for k in range(size):
            out += words[k : k + len(out)] * _C[k]
        whole = row[: len(out)] == row[size - 1 :] if len(out) else np.zeros(0, bool)
        keys, owner = ta.mix(out[whole]), row[: len(out)][whole]
        place = np.arange(len(words)) - (np.cumsum(count) - count)[row]
        prints = []
        for seed in (1, 2):
            step = ta.mix(words + ta.U(seed)) * ta.mix(place.astype(np.uint64) * ta.U(2 * seed + 1) + ta.U(seed)) if len(words) else words
            total = np.concatenate([[ta.U(0)], np.cumsum(step, dtype=np.uint64)])
            stops = np.cumsum(count)
            prints.append(ta.mix(total[stops] - total[stops - count] + count.astype(np.uint64)))
    short = np.flatnonzero((count > 0) & (count < size))
    keys = np.concatenate([keys, prints[0][short]])
    owner = np.concatenate([owner, short])
    return owner, keys, prints[0], prints[1], count


def sketch(owner: np.ndarray, keys: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash registers (the winning shingles) of n texts; 0 without shingles."""
    codes, first = pd.factorize(keys ^ ta.mix(owner.astype(np.uint64) + ta.U(3)))
    at = ta.firsts(codes, len(first))
    weight = 1 + np.log2(np.bincount(codes, minlength=len(first)))
    key, doc = keys[at], owner[at]
    best, won = np.full(n * registers, np.inf), np.zeros(n * registers, dtype=np.uint64)
    mixed = ta.mix(key + ta.U(11))
    jump, base = (mixed >> ta.U(40)) | ta.U(1), mixed & ta.U(0xFFFF)
    time, latest = np.zeros(len(key)), np.full(n, np.inf)
    for t in range(registers):
        with np.errstate(over="ignore"):
            draw = ta.mix(key + ta.U((t + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            place = ((jump * ta.U(t) + base) & ta.U(registers - 1)).astype(np.int64)
        uniform = ((draw >> ta.U(11)).astype(np.float64) + 0.5) * 2.0**-53
        # a register is not hit twice by a shingle: the free ones share its rate
        time = time - np.log(uniform) / weight * (registers / (registers - t))
        alive = time < latest[doc]
        if not alive.any():
            break
        key, doc, weight, time, jump, base, place = (x[alive] for x in (key, doc, weight, time, jump, base, place))
        slot = doc * registers + place
        np.minimum.at(best, slot, time)
        winner = best[slot] == time
        won[slot[winner]] = key[winner]
        latest = best.reshape(n, registers).max(axis=1)
    return won.reshape(n, registers)


def bands(registers: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash per band of each text."""
    n, k = registers.shape
    parts = registers.reshape(n, k // rows, rows)
    out = np.zeros((n, k // rows), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for r in range(rows):
            out = ta.mix(out * _C[0] + parts[:, :, r] + ta.U(1))
        return ta.mix(out + np.arange(k // rows, dtype=np.uint64) * _C[1])


def prints_column(one: np.ndarray, two: np.ndarray, some: np.ndarray) -> pa.Array:
    """16-byte fingerprints; null for texts without words."""
    raw = np.stack([one, two], axis=1).astype(">u8").tobytes()
    return pa.array([raw[16 * i : 16 * i + 16] if ok else None for i, ok in enumerate(some.tolist())], pa.binary())


def fingerprinted(docs: DataFrame) -> DataFrame:
    """The rows with ``print``, the fingerprint of the text's words."""
    names = [c for c in docs.columns if c != "print"]
    docs = docs.select(*names)
    schema = T.StructType([*docs.schema.fields, T.StructField("print", T.BinaryType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ta.slices(batches, limit=ta.SLICE // 2):
            _, _, one, two, count = shingles(*ta.flat(batch.column(batch.schema.get_field_index("text"))))
            yield pa.record_batch([*batch.columns, prints_column(one, two, count > 0)], names=[*names, "print"])

    return docs.mapInArrow(ta.freed(add), schema)


def row_keys(halves: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A hash of the first half of a row's fingerprint and the code of its id."""
    with np.errstate(over="ignore"):
        return ta.mix(halves + ta.mix(codes))


def key_list(asked: DataFrame) -> Broadcast | None:
    """The sorted keys of the listed rows (print, doc_id), sent to all tasks; None if
    they do not fit ``common.SMALL_BYTES``."""
    if asked.count() * 8 > common.SMALL_BYTES:
        return None
    half = F.conv(F.hex(F.substring("print", 1, 8)), 16, -10).cast("bigint")
    found = asked.select(half.alias("half"), F.xxhash64("doc_id").alias("code")).toArrow()
    keys = row_keys(*(found[c].to_numpy().view(np.uint64) for c in ("half", "code")))
    return asked.sparkSession.sparkContext.broadcast(np.unique(keys))


def texts_of(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """node, text: a text for each of the listed rows (node, print, doc_id).

    Most texts are not listed: while the list is small, they are left out where they are
    read, by their keys; else all meet the list. Texts of one fingerprint have the same
    words, so any of them will do."""
    keys = key_list(asked)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ta.slices(batches, limit=ta.SLICE // 2):
            _, _, one, two, count = shingles(*ta.flat(batch.column(0)))
            some = count > 0
            if keys is not None:
                own = row_keys(one, batch.column(1).to_numpy().view(np.uint64))
                some &= np.searchsorted(keys.value, own, "right") > np.searchsorted(keys.value, own)
            found = pa.record_batch([prints_column(one, two, count > 0), batch.column(0)], names=["print", "text"])
            yield found.filter(pa.array(some))

    rows = docs.select("text", F.xxhash64("doc_id").alias("code")).mapInArrow(ta.freed(add), "print binary, text string")
    # the shuffle also keeps this Python step and the next one in stages of their own, so a
    # task never holds two workers
    return rows.dropDuplicates(["print"]).join(asked.select("print", "node"), "print").select("node", "text")


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, print, bands of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ta.slices(batches, limit=ta.SLICE // 2):
            owner, keys, one, two, count = shingles(*ta.flat(batch.column(1)))
            found = bands(sketch(owner, keys, batch.num_rows)).view(np.int64)
            width = found.shape[1]
            stops = np.arange(0, found.size + 1, width, dtype=np.int32)
            yield pa.record_batch(
                [batch.column(0), prints_column(one, two, count > 0), pa.ListArray.from_arrays(pa.array(stops), pa.array(found.ravel()))],
                names=["doc_id", "print", "bands"],
            )

    return docs.select("doc_id", "text").mapInArrow(ta.freed(add), f"doc_id {kind}, print binary, bands array<bigint>")


def folded(mark: bytes, size: int) -> int:
    """A mark as one of ``size`` bytes, a divisor of its own."""
    out = 0
    for i in range(0, len(mark), size):
        out ^= int.from_bytes(mark[i : i + size])
    return out


def plausible(sets: DataFrame, pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) of nodes that sizes and marks leave: all that reach the threshold
    and some that don't.

    A shingle that both sets hold turns the same bit of both marks. So the marks differ in
    at most as many bits as there are shingles that one set alone holds."""
    marks = sets.select("node", "size", "mark")
    both = pairs.select("a", "b")
    for side in ("a", "b"):
        both = both.join(marks.withColumnsRenamed({"node": side, "size": f"size_{side}", "mark": f"mark_{side}"}), side)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            apart = np.zeros(batch.num_rows, dtype=np.int64)
            for i, (a, b) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                width = min(len(a), len(b))
                apart[i] = (folded(a, width) ^ folded(b, width)).bit_count()
            most = (sizes - apart) // 2
            good = pa.array(most >= threshold * (sizes - most))
            yield pa.record_batch([batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])

    both = both.where(F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * threshold - 1e-6)
    return both.select("a", "b", "size_a", "size_b", "mark_a", "mark_b").mapInArrow(check, "a bigint, b bigint")


def sent(sets: DataFrame, pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """a, salt, b, sets: the sets to be compared, those of ``b`` null stand for ``a``.

    Each pair takes the set of ``b`` along to the set of ``a``, which is there once for
    about ``GROUP`` pairs."""
    left = common.stored(plausible(sets, pairs, threshold), "likely")
    groups = left.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("groups"))
    spread = common.stored(left.join(groups, "a").select("a", "b", F.pmod(F.xxhash64("b"), "groups").alias("salt")), "spread")
    # sets that no pair needs stay where they are while the list of pairs is small
    few = common.small_side(spread, 32)
    own = sets.select("node", "sets")
    heads = own.withColumnRenamed("node", "a").join(few.select("a", "salt").distinct(), "a").select("a", "salt", F.lit(None).cast("bigint").alias("b"), "sets")
    rows = own.withColumnRenamed("node", "b").join(few, "b").select("a", "salt", "b", "sets")
    return heads.unionAll(rows)


def verified(sets: DataFrame, pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) of nodes whose shingle sets reach the threshold."""
    both = sent(sets, pairs, threshold).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            good = []
            for i in range(batch.num_rows):
                hashes = np.frombuffer(batch.column(3)[i].as_buffer(), "<u8")
                if b[i] is None:
                    head, own = a[i], hashes
                    continue
                assert a[i] == head
                small, large = min(len(own), len(hashes)), max(len(own), len(hashes))
                if small < threshold * large:
                    continue
                common_ones = len(np.intersect1d(own, hashes, assume_unique=True))
                if common_ones >= threshold * (len(own) + len(hashes) - common_ones):
                    good.append(i)
            yield pa.record_batch([batch.column(0).take(pa.array(good, pa.int64())), batch.column(2).take(pa.array(good, pa.int64()))], names=["a", "b"])

    return both.mapInArrow(check, "a bigint, b bigint")


def marks_of(owner: np.ndarray, keys: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Marks of sets of hashes: each turns a bit among at least twice as many, a power
    of two, up to ``MARK``."""
    bits = np.full(len(sizes), 64)
    while (more := (bits < 2 * sizes) & (bits < MARK)).any():
        bits[more] *= 2
    stops = np.cumsum(bits)
    cells = (stops - bits)[owner] + (keys & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    turned = np.packbits((np.bincount(cells, minlength=int(bits.sum())) & 1).astype(np.uint8))
    return [turned[(b - n) // 8 : b // 8].tobytes() for b, n in zip(stops.tolist(), bits.tolist(), strict=True)]


def shingle_sets(texts: DataFrame) -> DataFrame:
    """node, size, mark, sets: sorted hashes of the distinct shingles of each text, how
    many they are and their mark."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ta.slices(batches, limit=ta.SLICE // 2):
            owner, keys, _, _, _ = shingles(*ta.flat(batch.column(1)))
            order = np.lexsort((keys, owner))
            owner, keys = owner[order], keys[order]
            new = np.ones(len(keys), dtype=bool)
            new[1:] = (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])
            owner, keys = owner[new], keys[new].astype("<u8")
            sizes = np.bincount(owner, minlength=batch.num_rows)
            stops = np.r_[0, np.cumsum(sizes)]
            sets = [keys[a:b].tobytes() for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]
            marks = pa.array(marks_of(owner, keys, sizes), pa.binary())
            yield pa.record_batch([batch.column(0), pa.array(sizes), marks, pa.array(sets, pa.binary())], names=["node", "size", "mark", "sets"])

    return texts.select("node", "text").mapInArrow(ta.freed(add), "node bigint, size bigint, mark binary, sets binary")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, print, class_id, kept: the near-duplicate class of every row.

    A class is what links connect; its id is the least doc_id in it (null if it
    has none), and its row of that id is kept: one of each class, the others not.
    Texts with the same words in the same order are copies, whatever white space
    or A-Z case they have. Texts of fewer than five words match only as copies.
    Null, empty and blank texts have no words: each such row is a class of its own
    and kept. Of repeated rows (same id, same words) all have the same answer. An
    empty table gives no rows. Texts are read whole; other columns are not read.
    """
    spark = docs.sparkSession
    common.ship(spark)
    rows = common.stored(sketched(docs), "sketches")
    nodes = rows.where("print is not null").groupBy("print").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    nodes = common.stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    placed = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = common.stored(placed.join(sizes, "bucket").select("bucket", "node", "size"), "buckets")
    # one row per node that some pair needs
    asked = common.stored(members.select("node").distinct().join(nodes, "node").select("node", "print", "doc_id"), "asked")
    links, sets = linked(docs, asked, members)
    roots = graph.components(links)
    large = members.where(F.col("size") > SMALL)
    if large.limit(1).count():
        met = across(sets, large, roots)
        if met is not None:
            more = common.stored(verified(sets, met), "links")
            if more.limit(1).count():
                roots = graph.components(links.unionAll(more))
    named = asked.select("node", "print")
    roots = roots.join(named, "node").select("print", F.col("root").alias("node"))
    roots = roots.join(named.withColumnRenamed("print", "root"), "node").select("print", "root")
    own = rows.join(roots, "print", "left").select(
        "doc_id", "print", F.coalesce("root", "print").alias("root")
    )
    least = own.where("root is not null").groupBy("root").agg(
        F.min("doc_id").alias("class_id"),
        # of rows with the least id, the one with the least fingerprint
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "print")).alias("first"),
    )
    joined = own.join(least, "root", "left")
    kept = F.col("print").isNull() | (F.struct(F.col("doc_id").isNull(), "doc_id", "print") == F.col("first"))
    return joined.select("doc_id", "print", F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), kept.alias("kept"))


def exploded(nodes: DataFrame) -> DataFrame:
    """node, root, size, shingle: a row for every shingle of the sets."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys = np.frombuffer(batch.column(3)[i].as_buffer(), "<i8")
                own = pa.array(np.full(len(keys), i))
                yield pa.record_batch([*(batch.column(c).take(own) for c in range(3)), pa.array(keys)], names=["node", "root", "size", "shingle"])

    return nodes.select("node", "root", "size", "sets").mapInArrow(ta.freed(add), "node bigint, root bigint, size bigint, shingle bigint")


def across(sets: DataFrame, large: DataFrame, roots: DataFrame, threshold: float = THRESHOLD) -> DataFrame | None:
    """Pairs (a, b) of different groups, of the nodes in large buckets that hold more
    than one group: all that can reach the threshold. None if there are no such nodes.

    Shingles are ordered by how many nodes hold them, those of one group alone first.
    Two sets that reach the threshold share a shingle that is among the first of both:
    at most 1/9 of the smaller (for 0.8) and 1/5 of the larger stand before it. So what
    a template gives to all its pages comes last and makes no pairs. Of a shingle's
    nodes only those outside its largest group look for others."""
    grouped = large.select("bucket", "node").join(roots, "node", "left")
    grouped = grouped.select("bucket", "node", F.coalesce("root", "node").alias("root"))
    split = grouped.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    nodes = common.stored(grouped.join(split, "bucket").select("node", "root").distinct(), "apart")
    if nodes.limit(1).count() == 0:
        return None
    rows = common.stored(exploded(sets.join(common.small_side(nodes, 32), "node")), "apart-shingles")
    counts = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("held"), F.min("root").alias("low"), F.max("root").alias("high"))
    shared = rows.join(counts.where("low <> high").select("shingle", "held"), "shingle")
    own = Window.partitionBy("node")
    place = F.col("size") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("held", "shingle")) - 1
    heads = shared.withColumn("place", place).where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * threshold - 1e-6))
    heads = common.stored(heads.select("shingle", "node", "root", "size", "place"), "apart-heads")
    groups = heads.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("held")).groupBy("shingle")
    groups = groups.agg(F.max(F.struct("held", "root")).alias("top"), F.count(F.lit(1)).alias("groups")).where("groups > 1")
    outer = common.stored(heads.join(groups.select("shingle", F.col("top.root").alias("top")), "shingle").where("root <> top").drop("top"), "apart-outer")
    share = threshold / (1 + threshold)
    first = F.col("place") <= F.col("size") - F.ceil(F.col("size") * 2 * share - 1e-6)
    names = {c: f"{c}_b" for c in ("node", "root", "size", "place")}
    found = []
    for left, right in ((outer.where(first), heads), (heads.where(first), outer)):
        both = left.join(right.withColumnsRenamed(names), "shingle")
        both = both.where("root <> root_b and size <= size_b").where(F.col("size") >= F.col("size_b") * threshold - 1e-6)
        reach = F.least(F.col("size") - F.col("place"), F.col("size_b") - F.col("place_b"))
        found.append(both.where(reach >= (F.col("size") + F.col("size_b")) * share - 1e-6))
    pairs = found[0].unionAll(found[1]).select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b"))
    return common.stored(pairs.distinct(), "pairs")


def linked(docs: DataFrame, asked: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verified links among the members of buckets, and the members' shingle sets."""
    small = members.where(F.col("size") <= SMALL).select("bucket", "node")
    pairs = small.join(small.withColumnRenamed("node", "b"), "bucket").where("node < b").select(F.col("node").alias("a"), "b")
    large = members.where(F.col("size") > SMALL)
    star = large.join(large.groupBy("bucket").agg(F.min("node").alias("a")), "bucket").where("node <> a").select("a", F.col("node").alias("b"))
    # neighbours by number, within ranges of its hash that hold about SLICE nodes; in large
    # buckets a quarter of the bands, in those of one slice all
    ring = large.where((F.pmod("bucket", F.lit(4)) == 0) | (F.col("size") <= SLICE))
    ring = ring.withColumn("slice", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / SLICE)))
    order = Window.partitionBy("bucket", "slice").orderBy("node")
    ring = ring.select(F.col("node").alias("a"), F.lead("node").over(order).alias("b")).where("b is not null")
    tested = common.stored(pairs.unionAll(star).unionAll(ring).distinct(), "pairs")
    sets = common.stored(shingle_sets(texts_of(docs, asked)), "shingle-sets")
    links = common.stored(verified(sets, tested), "links")
    for _ in range(ROUNDS if large.limit(1).count() else 0):
        both = links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node")))
        known = large.select("bucket", "node").join(both.groupBy("node").count(), "node")
        lead = known.groupBy("bucket").agg(F.max(F.struct("count", "node")).alias("top"))
        more = large.select("bucket", "node").join(lead, "bucket").select("node", F.col("top.node").alias("other")).where("node <> other")
        more = more.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        more = common.stored(more.join(tested, ["a", "b"], "left_anti"), "pairs")
        found = common.stored(verified(sets, more), "links")
        if found.limit(1).count() == 0:
            break
        tested, links = tested.unionAll(more), links.unionAll(found)
    return links, sets


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates: of each class the
    row with the least id, and of repeated rows one. Rows without words all stay,
    those with a null text too. No column name is reserved."""
    names = docs.columns
    # other columns under names that can't clash with the working ones
    plain = [n if n in ("doc_id", "text") else f"c{i}" for i, n in enumerate(names)]
    docs = docs.toDF(*plain)
    judged = common.stored(classes(docs).where("print is not null").select("doc_id", "print", "kept"), "judged")
    others = judged.where("not kept").distinct().select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"))
    twice = judged.where("kept").groupBy("doc_id", "print").count().where("count > 1").select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"))
    others, twice = common.stored(others, "dropped"), common.stored(twice, "repeated")
    marked = fingerprinted(docs)
    blank = marked.where("print is null").select(*plain)
    said = marked.where("print is not null")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print"))
    said = said.join(common.small_side(others, 64), same, "left_anti")
    if twice.limit(1).count():  # only rows that are there more than once have to meet
        listed = common.small_side(twice, 64)
        once = said.join(listed, same, "left_semi").dropDuplicates(["doc_id", "print"])
        said = said.join(listed, same, "left_anti").unionByName(once)
    return said.select(*plain).unionAll(blank).toDF(*names)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return classes(common.table(spark, folder, "documents")).select("doc_id", "class_id", "kept")
