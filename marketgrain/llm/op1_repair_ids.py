"""Token ids in a grammar-compressed file format (Re-Pair).

Documents are range-partitioned by id and encoded; each partition becomes a
shard of blocks. In a block, frequent adjacent id pairs are replaced by new
symbols over a few rounds. A round replaces many pairs at once: no symbol may be
the left of one chosen pair and the right of another, so the result is the same
as replacing them one after another. Pairs never span two documents, so every
document can be decoded by itself.

The file is Parquet, one row per block: shard, block, first_id, last_id,
n_tokens, base (symbols below it are ids), ``left`` and ``right`` (rule i makes
symbol base + i), ``sizes`` (ids that rule i expands to), doc_ids, ``ends`` (end
of each document in the body), ``lengths`` (ids of each document), width (bytes
per symbol) and body.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketgrain.llm import bpe, common
from marketgrain.llm import textarrays as ta

END_ID = 0
BLOCK_TOKENS = 1 << 20
ROUNDS = 4
MIN_COUNT = 12
PAIRS_A_ROUND = 2048
_BUCKETS = 20


def grammar(ids: np.ndarray, lengths: np.ndarray, rounds: int = ROUNDS, min_count: int = MIN_COUNT):
    """(base, left, right, body, ends): Re-Pair over documents laid end to end."""
    base = int(ids.max()) + 1 if len(ids) else 0
    symbol = ids.astype(np.uint32)
    last = np.zeros(len(symbol), dtype=bool)  # the last symbol of a document
    ends = np.cumsum(lengths)
    last[ends[lengths > 0] - 1] = True
    left, right = [], []
    for _ in range(rounds):
        if len(symbol) < 2:
            break
        key = (symbol[:-1].astype(np.uint64) << ta.U(32)) | symbol[1:]
        with np.errstate(over="ignore"):
            bucket = ((key * ta.U(ta.BASE)) >> ta.U(64 - _BUCKETS)).astype(np.int64)
        inner = ~last[:-1]
        counts = np.bincount(bucket[inner], minlength=1 << _BUCKETS)
        often = counts[counts >= min_count]
        if not len(often):
            break
        least = min_count
        if len(often) > 2 * PAIRS_A_ROUND:
            least = max(least, int(np.partition(often, -2 * PAIRS_A_ROUND)[-2 * PAIRS_A_ROUND]))
        at = np.flatnonzero((counts >= least)[bucket] & inner)
        codes, pairs = pd.factorize(key[at])
        used = np.bincount(codes, minlength=len(pairs))
        first = (pairs >> ta.U(32)).astype(np.int64)
        second = (pairs & ta.U(0xFFFFFFFF)).astype(np.int64)
        order = np.lexsort((pairs, -used))
        order = order[used[order] >= min_count][:PAIRS_A_ROUND]
        new = np.full(len(pairs), -1, dtype=np.int64)
        role: dict[int, int] = {}
        for i, a, b in zip(order.tolist(), first[order].tolist(), second[order].tolist(), strict=True):
            if a == b:
                if a in role:
                    continue
                role[a] = 3
            else:
                if role.get(a, 1) != 1 or role.get(b, 2) != 2:
                    continue
                role[a], role[b] = 1, 2
            new[i] = base + len(left)
            left.append(a)
            right.append(b)
        made = new[codes]
        hit = made >= 0
        at, made = at[hit], made[hit]
        if not len(at):
            break
        # only pairs of one symbol with itself overlap: of a run take the 1st, 3rd, ...
        index = np.arange(len(at))
        opens = np.r_[True, at[1:] != at[:-1] + 1]
        taken = ((index - np.maximum.accumulate(np.where(opens, index, 0))) & 1) == 0
        at, made = at[taken], made[taken]
        symbol[at] = made
        last[at] |= last[at + 1]
        keep = np.ones(len(symbol), dtype=bool)
        keep[at + 1] = False
        symbol, last = symbol[keep], last[keep]
    out = np.zeros(len(lengths), dtype=np.int64)
    out[lengths > 0] = np.flatnonzero(last) + 1
    return base, np.array(left, np.int64), np.array(right, np.int64), symbol, np.maximum.accumulate(out)


def rule_sizes(base: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many ids each rule expands to."""
    sizes = np.zeros(len(left), dtype=np.int64)
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        sizes[i] = (1 if a < base else sizes[a - base]) + (1 if b < base else sizes[b - base])
    return sizes


def expand(base: int, left: np.ndarray, right: np.ndarray, sizes: np.ndarray, body: np.ndarray) -> np.ndarray:
    """The ids of a run of symbols: any document's run decodes by itself."""
    table = np.arange(base, base + len(left), dtype=np.int64)
    while len(table):  # every rule's ids, one after another
        rule = table >= base
        if not rule.any():
            break
        out = np.repeat(table, 1 + rule)
        seconds = np.cumsum(1 + rule)[rule] - 1
        out[seconds - 1] = left[table[rule] - base]
        out[seconds] = right[table[rule] - base]
        table = out
    starts = np.cumsum(sizes) - sizes
    body = body.astype(np.int64)
    rule = body >= base
    ids = np.concatenate([table, np.zeros(len(body), dtype=np.int64)])
    ids[len(table) :] = body
    at, n = len(table) + np.arange(len(body)), np.ones(len(body), dtype=np.int64)
    at[rule], n[rule] = starts[body[rule] - base], sizes[body[rule] - base]
    return ids[ta.gather(at, n)].astype(np.uint32)


LAYOUT = (
    "shard int, block int, first_id {0}, last_id {0}, n_tokens bigint, base int, left array<int>, right array<int>,"
    " sizes array<int>, doc_ids array<{0}>, ends array<int>, lengths array<int>, width int, body binary"
)


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS, shards: int | None = None) -> None:
    """Encode whole texts and write them in ascending id order.

    A null text is empty and so holds the end id alone; null ids come first.
    Rows with equal ids all stay, ordered by a hash of the text and the text. An
    empty table writes an empty file. Only ``doc_id`` and ``text`` are read. A
    document is never cut; a block holds whole documents, about ``block_tokens``
    ids or one longer document.
    """
    spark = docs.sparkSession
    common.ship(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    order: list[Column | str] = ["doc_id", F.xxhash64("text"), "text"]
    rows = docs.select("doc_id", "text").repartitionByRange(shards or common.tasks(spark), *order[:2]).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch, ids, offsets in bpe.encoded(batches, vocabulary):
            lengths = np.diff(offsets) + 1
            ids = np.insert(ids, offsets[1:], np.uint32(end_id))
            held.append((batch.column(0), ids, lengths))
            size += len(ids)
            if size >= block_tokens:
                yield row(shard, block, held)
                block, held, size = block + 1, [], 0
        if held:
            yield row(shard, block, held)

    def row(shard: int, block: int, held: list) -> pa.RecordBatch:
        doc_ids = pa.concat_arrays([x[0] for x in held])
        ids, lengths = (np.concatenate([x[i] for x in held]) for i in (1, 2))
        base, left, right, body, ends = grammar(ids, lengths)
        width = 2 if base + len(left) <= 1 << 16 else 4
        whole = lambda values: pa.array([values.astype(np.int32)], pa.list_(pa.int32()))
        return pa.record_batch(
            [
                pa.array([shard], pa.int32()), pa.array([block], pa.int32()),
                doc_ids.slice(0, 1), doc_ids.slice(len(doc_ids) - 1, 1),
                pa.array([len(ids)], pa.int64()), pa.array([base], pa.int32()),
                whole(left), whole(right), whole(rule_sizes(base, left, right)),
                pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
                whole(ends), whole(lengths), pa.array([width], pa.int32()),
                pa.array([body.astype(f"<u{width}").tobytes()], pa.binary()),
            ],
            names=[field.split()[0] for field in LAYOUT.split(", ")],
        )

    rows.mapInArrow(write, LAYOUT.format(kind)).write.parquet(path)


def block_documents(batch: pa.RecordBatch, wanted=None) -> Iterator[tuple]:
    """(number in the block, doc_id, ids) of each document of each block row;
    ``wanted`` chooses documents by id, and only their runs are expanded."""
    column = lambda name: batch.column(batch.schema.get_field_index(name))
    for i in range(batch.num_rows):
        array = lambda name: np.asarray(column(name)[i].values, dtype=np.int64)  # noqa: B023, E731
        base, left, right, sizes = column("base")[i].as_py(), array("left"), array("right"), array("sizes")
        body = np.frombuffer(column("body")[i].as_buffer(), f"<u{column('width')[i].as_py()}")
        ends, lengths, doc_ids = array("ends"), array("lengths"), column("doc_ids")[i].as_py()
        if wanted is None:
            ids, stops = expand(base, left, right, sizes, body), np.cumsum(lengths)
            yield from ((i, k, d, ids[e - n : e]) for k, (d, e, n) in enumerate(zip(doc_ids, stops.tolist(), lengths.tolist(), strict=True)))
        else:
            starts = np.r_[0, ends[:-1]]
            yield from ((i, k, d, expand(base, left, right, sizes, body[starts[k] : ends[k]])) for k, d in enumerate(doc_ids) if d in wanted)


def read_some(spark: SparkSession, path: str, doc_ids: list[int]) -> dict[int, list[int]]:
    """Ids of a few documents. Blocks are pruned by their id span; only the runs
    of the documents asked for are expanded."""
    ship_first = spark.read.parquet(path)
    common.ship(spark)
    wanted = sorted(set(doc_ids))
    near = ship_first.where(F.exists(F.array(*map(F.lit, wanted)), lambda d: (F.col("first_id") <= d) & (d <= F.col("last_id"))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(block_documents(batch, set(wanted)))
            yield pa.record_batch([pa.array([x[2] for x in found], pa.int64()), pa.array([x[3].tolist() for x in found], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return {r["doc_id"]: r["ids"] for r in near.mapInArrow(read, "doc_id bigint, ids array<bigint>").collect()}


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, decoded from the file: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32.

    Block starts come from two short sums: blocks within their shard, and one
    row per shard over all shards."""
    common.ship(spark)
    blocks = spark.read.parquet(path)
    kind = blocks.schema["first_id"].dataType.simpleString()
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    shards = shards.select("shard", F.coalesce(F.sum("size").over(before.orderBy("shard")), F.lit(0)).alias("shard_start"))
    places = blocks.select("shard", "block", F.coalesce(F.sum("n_tokens").over(before.partitionBy("shard").orderBy("block")), F.lit(0)).alias("in_shard"))
    places = places.join(shards, "shard").select("shard", "block", (F.col("shard_start") + F.col("in_shard")).alias("start"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # one block in memory at a time
                one = batch.slice(k, 1)
                shard, block = one.column(0)[0].as_py(), one.column(1)[0].as_py()
                found = [(d, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for _, _, d, ids in block_documents(one)]
                sizes = np.array([f[1] for f in found], dtype=np.int64)
                yield pa.record_batch(
                    [
                        pa.array([shard] * len(found), pa.int32()), pa.array([block] * len(found), pa.int32()),
                        pa.array([f[0] for f in found], batch.column(2).type),
                        pa.array(np.cumsum(sizes) - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                        pa.array([f[2] for f in found], pa.int64()),
                    ],
                    names=["shard", "block", "doc_id", "in_block", "n_tokens", "ids_crc32"],
                )

    needed = ["shard", "block", "first_id", "base", "left", "right", "sizes", "doc_ids", "ends", "lengths", "width", "body"]
    read = blocks.select(*needed).mapInArrow(decode, f"shard int, block int, doc_id {kind}, in_block bigint, n_tokens bigint, ids_crc32 bigint")
    return read.join(places, ["shard", "block"]).select("doc_id", (F.col("start") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32")


def query(spark: SparkSession, folder: str) -> DataFrame:
    path = common.scratch(spark, "repair-ids")
    write_ids(common.table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_index(spark, path)
