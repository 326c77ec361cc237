"""Exact top-k by inner product with a pivot table.

The distances of all vectors to a few dozen pivots are computed once; by the
triangle inequality the largest difference of two vectors' pivot distances is a
lower bound of their distance, and so an upper bound of their inner product. Each
task orders its candidates by that bound and evaluates them until the next bound
is below the k-th best score, so nothing that could count is left out.

Queries are a stated set and go out in blocks of bounded size; each block is one
pass over all vectors. A bounded sample gives pivots and, as its rows are real
candidates, a first score that every answer must reach, so a task sends few rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketgrain.llm import common

SCALE = 1024
EVERY = 100
K = 10
PIVOTS = 32
SAMPLE = 2048
BLOCK = 4096
ROWS = 8192
NO_SCORE = -(2**62)


def sound(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def matrix(column: pa.Array, size: int, scale: float) -> np.ndarray:
    """floor(scale * component) as whole numbers; float64 while that is exact."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.floor(scale * values).reshape(len(column), size)
    top = np.abs(out).max() if out.size else 0.0
    return out if top * top * max(size, 1) < 2**52 else out.astype(np.int64)


def norms(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to pivots."""
    x, pivots = x.astype(np.float64), pivots.astype(np.float64)
    squared = norms(x)[:, None] + norms(pivots)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(squared, 0))


def choose_pivots(x: np.ndarray, count: int) -> np.ndarray:
    """Rows far from one another: each next one is farthest from those chosen."""
    x = np.unique(x, axis=0)
    if len(x) <= count:
        return x
    chosen = [int(np.argmax(distances(x, x.mean(axis=0, keepdims=True))[:, 0]))]
    near = distances(x, x[chosen])[:, 0]
    while len(chosen) < count and near.max() > 0:
        chosen.append(int(np.argmax(near)))
        near = np.minimum(near, distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


class Best:
    """The k best (score, id) of each query so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.scores = [np.zeros(0, np.int64) for _ in range(queries)]
        self.ids = [np.zeros(0, np.int64) for _ in range(queries)]

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least[q]
        if not good.any():
            return
        scores, ids = np.concatenate([self.scores[q], scores[good]]), np.concatenate([self.ids[q], ids[good]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[q], self.ids[q] = scores[order], ids[order]
        if len(order) == self.k:
            self.least[q] = max(self.least[q], scores[order[-1]])


def visit(best: Best, queries: dict, x: np.ndarray, ids: np.ndarray) -> int:
    """Offer the rows of x to every query in the order of their bounds. Returns
    how many inner products were computed."""
    table, length, done = distances(x, queries["pivots"]), norms(x).astype(np.float64), 0
    for q in range(len(queries["id"])):
        gap = np.abs(table - queries["table"][q]).max(axis=1) if table.shape[1] else np.zeros(len(x))
        gap = np.maximum(gap - 1e-9 * (1 + queries["table"][q].max(initial=0.0) + gap), 0)
        both = queries["norm"][q] + length
        bound = (both - gap * gap) / 2 + 1e-6 * both + 1e-6
        own = ids == queries["id"][q]
        alive = np.flatnonzero((bound >= best.least[q]) & ~own)
        order = alive[np.argsort(-bound[alive], kind="stable")]
        step, at = 256, 0
        while at < len(order) and bound[order[at]] >= best.least[q]:
            rows = order[at : at + step]
            best.add(q, (x[rows] @ queries["x"][q]).astype(np.int64), ids[rows])
            done, at, step = done + len(rows), at + step, step * 4
    return done


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: float = SCALE, block: int = BLOCK, sample: int = SAMPLE, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products of
    whole-number vectors floor(scale * component), ties to the smaller vec_id.

    Both frames have ``vec_id`` and ``embedding``; other columns are not read.
    Vectors that are null or hold a null or non-finite component take no part,
    nor do rows with a null vec_id. A row with the query's vec_id is its own and
    no candidate. Vectors of different sizes have no inner product and are
    searched apart. Of repeated query rows one stays. Fewer candidates than k give
    fewer rows, no queries or no vectors none. Equal vectors are candidates each.
    """
    spark = vectors.sparkSession
    common.ship(spark)
    part = lambda frame: frame.where(F.col("vec_id").isNotNull() & sound(F.col("embedding"))).select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    vectors, queries = part(vectors), part(queries).dropDuplicates(["vec_id"])
    found = []
    for size, count in queries.groupBy(F.size("embedding").alias("n")).count().collect():
        same, asked = (f.where(F.size("embedding") == size) for f in (vectors, queries))
        pick = same.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
        blocks = -(-count // block)
        for b in range(blocks):
            mine = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow() if blocks > 1 else asked.toArrow()
            if mine.num_rows:
                rows = one_block(spark, same, mine, pick, size, k, scale, pivots)
                found.append(common.stored(rows, "topk") if blocks > 1 else rows)
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def one_block(spark, vectors: DataFrame, asked: pa.Table, pick: pa.Table, size: int, k: int, scale: float, pivots: int) -> DataFrame:
    column = lambda t, name: t[name].combine_chunks()
    x, seen = matrix(column(asked, "embedding"), size, scale), matrix(column(pick, "embedding"), size, scale)
    chosen = choose_pivots(seen, pivots)
    queries = {"id": column(asked, "vec_id").to_numpy(), "x": x, "norm": norms(x).astype(np.float64), "pivots": chosen, "table": distances(x, chosen)}
    start = Best(len(x), k, np.full(len(x), NO_SCORE))
    visit(start, queries, seen, column(pick, "vec_id").to_numpy())
    sent = spark.sparkContext.broadcast((queries, start.least))  # at most BLOCK queries

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, least = sent.value
        best = Best(len(queries["id"]), k, least)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                visit(best, queries, matrix(rows.column(1), size, scale), rows.column(0).to_numpy())
        n = np.array([len(s) for s in best.scores], dtype=np.int64)
        if n.sum():
            yield pa.record_batch(
                [pa.array(np.repeat(queries["id"], n)), pa.array(np.concatenate(best.ids)), pa.array(np.concatenate(best.scores))],
                names=["query_id", "vec_id", "score"],
            )

    rows = vectors.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, folder: str) -> DataFrame:
    vectors = common.table(spark, folder, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id as vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
    from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
    where q.vec_id % 100 = 0
), ranked as (
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
    from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""
