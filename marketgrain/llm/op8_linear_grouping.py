"""Packing documents into sequences by linear grouping.

A document longer than a sequence is cut so that only its first piece is shorter;
the full pieces are sequences of their own. The other pieces are packed from the
histogram of their lengths, which has fewer entries than a sequence has tokens,
however many documents there are:

1. large lengths, in descending order, are dealt into groups of equal cardinality
   and rounded up to the longest of their group;
2. with these few sizes, configurations (what a sequence holds) are chosen one
   after another: the largest size left, filled up as far as possible, as many
   times as the sizes last;
3. the actual documents take the places of their group, which frees the space lost
   to rounding;
4. small lengths, in descending order, go where they fit best.

Several numbers of groups and limits between large and small are tried on the
histogram and the plan with the fewest sequences is kept. The plan is a short table (length, ranks, sequence, offset);
Spark ranks the documents of each length and looks their places up.
"""

from __future__ import annotations

import bisect
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketgrain.llm import bpe, common
from marketgrain.llm import textarrays as ta

CAPACITY = 1024
END_ID = 2
GROUPS = (16, 48, 128, 384, 1024)
SMALL = (0.05, 0.15, 0.3, 0.4, 0.5)  # lengths below this share of a sequence are small


def configurations(sizes: list[int], left: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """(groups of one sequence, repetitions) until every group is used up.

    ``sizes`` descend. Reachable fills are the bits of an integer; one integer per
    group is kept to find the groups of the best fill."""
    left, out, top = list(left), [], 0
    while True:
        while top < len(sizes) and not left[top]:
            top += 1
        if top == len(sizes):
            return out
        room = capacity - sizes[top]
        mask, reach, steps = (1 << (room + 1)) - 1, 1, []
        for g in range(top, len(sizes)):
            if sizes[g] > room or not left[g]:
                continue
            steps.append((g, reach))
            for _ in range(min(left[g] - (g == top), room // sizes[g])):
                more = (reach | reach << sizes[g]) & mask
                if more == reach:
                    break
                reach = more
            if reach >> room:
                break
        fill, chosen = reach.bit_length() - 1, [top]
        for g, before in reversed(steps):
            while not before >> fill & 1:
                fill -= sizes[g]
                chosen.append(g)
        times = min(left[g] // chosen.count(g) for g in set(chosen))
        for g in chosen:
            left[g] -= times
        out.append((chosen, times))


def plan(histogram: dict[int, int], capacity: int, groups: int, small: float):
    """(sequences used, segments) for lengths with their counts.

    A segment (length, low, high, per, sequence, offset) says: documents of this
    length with ranks low..high-1 go ``per`` to a sequence, from ``sequence`` on,
    the first at ``offset``."""
    lengths = sorted((n for n, c in histogram.items() if c), reverse=True)
    large = [n for n in lengths if n >= max(1, small * capacity)]
    total = sum(histogram[n] for n in large)
    step = max(1, -(-total // groups)) if total else 1
    queues: list[deque] = []
    sizes, left, rank, room = [], [], {n: 0 for n in lengths}, 0
    for n in large:
        c = histogram[n]
        while c:
            if not room:
                queues.append(deque())
                sizes.append(n)
                left.append(0)
                room = step
            take = min(c, room)
            queues[-1].append([n, take])
            left[-1] += take
            room, c = room - take, c - take
    merged: dict[int, int] = {}  # groups of the same rounded size are one
    for g, n in enumerate(sizes):
        if n in merged:
            queues[merged[n]].extend(queues[g])
            left[merged[n]] += left[g]
            left[g] = 0
        else:
            merged[n] = g
    segments, free, used = [], {}, 0
    spaces: list[int] = []

    def add_space(space: int, first: int, count: int) -> None:
        if space not in free:
            free[space] = []
            bisect.insort(spaces, space)
        free[space].append((first, count))

    for chosen, times in configurations(sizes, left, capacity):
        todo = times
        while todo:
            heads = [queues[g] for g in chosen]
            same = [sum(1 for q in heads if q is h) for h in heads]
            # places of one group draw from one queue: each takes an equal share of its head
            run = todo
            for h, k in zip(heads, same, strict=True):
                if h[0][1] >= k:
                    run = min(run, h[0][1] // k)
                else:
                    run = 1
            offset, drawn = 0, []
            for h in heads:
                n = h[0][0]
                if run == 1:
                    h[0][1] -= 1
                    drawn.append((n, 1))
                    if not h[0][1]:
                        h.popleft()
                else:
                    h[0][1] -= run
                    drawn.append((n, run))
                    if not h[0][1]:
                        h.popleft()
            for n, count in drawn:
                segments.append((n, rank[n], rank[n] + count, 1, used, offset))
                rank[n] += count
                offset += n
            if offset < capacity:
                add_space(capacity - offset, used, run)
            used += run
            todo -= run
    for n in lengths[len(large) :]:
        c = histogram[n]
        while c:
            at = bisect.bisect_left(spaces, n)
            if at == len(spaces):
                add_space(capacity, used, -(-c // (capacity // n)))
                used += -(-c // (capacity // n))
                at = bisect.bisect_left(spaces, n)
            space = spaces[at]
            first, count = free[space].pop()
            if not free[space]:
                del free[space]
                spaces.pop(at)
            per = space // n
            whole = min(count, c // per)
            offset = capacity - space
            if whole:
                segments.append((n, rank[n], rank[n] + whole * per, per, first, offset))
                rank[n] += whole * per
                c -= whole * per
                if space - per * n:
                    add_space(space - per * n, first, whole)
            if c and whole < count:  # fewer than a sequence's worth are left
                segments.append((n, rank[n], rank[n] + c, c, first + whole, offset))
                rank[n] += c
                add_space(space - c * n, first + whole, 1) if space - c * n else None
                whole, c = whole + 1, 0
            if whole < count:
                add_space(space, first + whole, count - whole)
    return used, segments


def best_plan(histogram: dict[int, int], capacity: int):
    """The plan with the fewest sequences over the tried settings; it stops at
    the least number that the tokens need."""
    least = -(-sum(n * c for n, c in histogram.items()) // capacity)
    best = None
    for groups in GROUPS:
        for small in SMALL:
            found = plan(histogram, capacity, groups, small)
            if best is None or found[0] < best[0]:
                best = found
            if best[0] == least:
                return best
    return best


def cut(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of whole documents: doc_id, piece, start, length, ids_crc32.

    A null text is empty and has the end id alone. Every row is a document, also
    when ids are null or repeat. Longer ones than ``capacity`` are cut so that
    only the first piece may be shorter. An empty table gives no rows."""
    common.ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, offsets in bpe.encoded(batches, vocabulary, bpe.FEW):
            ids = np.insert(ids, offsets[1:], np.uint32(end_id)).astype("<u4")
            ends = offsets[1:] + np.arange(1, len(offsets))
            lengths = np.diff(offsets) + 1
            n = -(-lengths // capacity)
            first = lengths - (n - 1) * capacity
            doc = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            length = np.where(piece == 0, first[doc], capacity)
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
            low = (ends - lengths)[doc] + start
            crc = [zlib.crc32(ids[a : a + k].tobytes()) for a, k in zip(low.tolist(), length.tolist(), strict=True)]
            yield pa.record_batch(
                [batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(ta.freed(pieces), f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence_id and offset.

    ``pieces`` must be a stored table (it is read several times) with doc_id,
    piece, length. Full pieces get negative numbers, packed ones numbers from 0.
    Ranks within a length are counted per hash of the piece and then added up, so
    a length that many documents share is spread over all tasks. Only the
    histogram (fewer than ``capacity`` rows) comes to the driver."""
    spark = pieces.sparkSession
    common.ship(spark)
    full = pieces.where(F.col("length") >= capacity).withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")}
    )
    short = pieces.where(F.col("length") < capacity)
    histogram = {r["length"]: r["count"] for r in short.groupBy("length").count().collect()}
    if not histogram:
        return full
    _, segments = best_plan(histogram, capacity)
    look = np.array(sorted(segments), dtype=np.int64)
    held = spark.sparkContext.broadcast(look)  # bounded by the number of lengths and configurations
    short = short.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(common.tasks(spark))))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = short.groupBy("length", "_salt").count()
    base = base.select("length", "_salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")) - 1
    ranked = short.withColumn("_rank", rank).join(base, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_base"))
    columns = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = held.value
        span = int(seg[:, 2].max()) + 1
        key = seg[:, 0] * span + seg[:, 1]
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            length, rank = get("length"), get("_rank")
            s = seg[np.searchsorted(key, length * span + rank, "right") - 1]
            k = rank - s[:, 1]
            sequence, offset = s[:, 4] + k // s[:, 3], s[:, 5] + (k % s[:, 3]) * length
            yield pa.record_batch(
                [*(batch.column(batch.schema.get_field_index(c)) for c in columns), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*columns, "sequence_id", "offset"],
            )

    return ranked.select(*columns, "_rank").mapInArrow(place, schema + ", sequence_id bigint, offset bigint").unionByName(full)


def packed(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Documents cut and packed; see cut and pack."""
    return pack(common.stored(cut(docs, vocabulary, capacity), "pieces"), capacity)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return packed(common.table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
