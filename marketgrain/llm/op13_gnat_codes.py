"""Vector codes: each part of a vector becomes the number of its nearest codebook
entry, found in a geometric near-neighbour access tree over the entries.

A node of the tree has split points among its entries; every other entry belongs to
the nearest of them. For each pair (split point, subtree) the node knows the least
and the greatest distance from the point to the subtree. By the triangle inequality
a query's distances to the split points then bound its distance to every subtree
from below, and a subtree whose bound is above the best distance so far is left out
whole. Bounds are rounded down and compared strictly, and whatever they leave is
decided by squared distances in whole numbers, ties to the lower entry, so the
answer is that of a full search.

All queries of a batch go through a node together. Codebooks are 256 entries a
part, whatever the table, and travel to the tasks and back whole; vectors never move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketgrain.llm import common

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
DEGREE = 12  # split points of a node
LEAF = 24  # entries that are simply compared
ROWS = 4096
EXACT = 2.0**51  # whole numbers below are exact in float64, with room for sums


def sound(vector: Column) -> Column:
    """Whether a vector is kept: not null, no null or non-finite component."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def whole(values: np.ndarray, size: int) -> np.ndarray:
    """floor(1024 * component), a row a vector: float64 while sums of squares of
    differences are exact in it, Python's whole numbers otherwise."""
    out = np.floor(SCALE * values.astype(np.float64)).reshape(-1, size)
    return out if exact(out, size) else as_integers(out)


def exact(x: np.ndarray, size: int) -> bool:
    top = float(np.abs(x).max()) if x.size else 0.0
    return 4 * top * top * max(size, 1) < EXACT


def as_integers(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of x to rows of y."""
    if x.dtype != object and y.dtype != object:
        return (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    out = np.empty((len(x), len(y)), dtype=object)
    for i, row in enumerate(y.astype(object)):
        out[:, i] = ((x.astype(object) - row) ** 2).sum(axis=1) if x.shape[1] else 0
    return out


@dataclass
class Node:
    splits: np.ndarray  # entry numbers
    low: np.ndarray  # least distance from split point i to subtree j
    high: np.ndarray  # greatest distance
    below: list  # subtree j: a Node, or entry numbers


def build(x: np.ndarray, members: np.ndarray, degree: int = DEGREE, leaf: int = LEAF):
    """The tree of some entries: their numbers if few, else a node."""
    if len(members) <= leaf:
        return members
    far = np.sqrt(squared(x[members], x[members]).astype(np.float64))
    chosen = [0]
    nearest = far[0].copy()
    while len(chosen) < degree and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, far[chosen[-1]])
    chosen.sort()  # entry numbers rise everywhere, so the first of equal distances is the lowest
    if len(chosen) == 1:  # all entries are equal
        return members
    owner = far[chosen].argmin(axis=0)
    low, high = (np.zeros((len(chosen), len(chosen))) for _ in range(2))
    below = []
    for j in range(len(chosen)):
        own = np.flatnonzero(owner == j)
        own = own[own != chosen[j]]
        reach = far[chosen][:, own]
        if len(own):
            low[:, j], high[:, j] = reach.min(axis=1), reach.max(axis=1)
        below.append(build(x, members[own], degree, leaf))
    return Node(members[chosen], low, high, below)


class Search:
    """The nearest entry of each query: its number and the squared distance."""

    def __init__(self, x: np.ndarray, tree):
        self.x, self.tree, self.compared = x, tree, 0

    def __call__(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        exactly = queries.dtype != object and self.x.dtype != object
        # within the tasks the numbers of both sides together decide what is exact
        exactly = exactly and exact(queries, queries.shape[1]) and exact(self.x, queries.shape[1])
        self.q = queries if exactly else queries.astype(object) if queries.dtype == object else as_integers(queries)
        self.entries = self.x if exactly or self.x.dtype == object else as_integers(self.x)
        self.exactly = exactly
        if exactly:
            self.twice, self.norms, self.own = 2 * self.x, (self.x * self.x).sum(axis=1), (queries * queries).sum(axis=1)
        self.best = np.full(len(queries), np.inf if exactly else None, dtype=np.float64 if exactly else object)
        if not exactly:
            self.best[:] = [1 << 4000] * len(queries)
        self.entry = np.full(len(queries), len(self.x), dtype=np.int64)
        if len(queries):
            self._visit(self.tree, np.arange(len(queries)))
        return self.entry, self.best

    def _compare(self, rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Offer the entries to these queries; their squared distances."""
        if self.exactly:
            found = self.q[rows] @ self.twice[entries].T
            np.subtract(self.norms[entries][None, :], found, out=found)
            found += self.own[rows][:, None]
        else:
            found = squared(self.q[rows], self.entries[entries])
        self.compared += found.size
        at = found.argmin(axis=1)
        near, entry = found[np.arange(len(rows)), at], entries[at]
        better = (near < self.best[rows]) | ((near == self.best[rows]) & (entry < self.entry[rows]))
        better = better.astype(bool)
        self.best[rows[better]], self.entry[rows[better]] = near[better], entry[better]
        return found

    def _visit(self, node, rows: np.ndarray) -> None:
        if not isinstance(node, Node):
            if len(node):
                self._compare(rows, node)
            return
        far = np.sqrt(self._compare(rows, node.splits).astype(np.float64))
        bound = np.zeros((len(rows), len(node.below)))
        for i in range(len(node.splits)):
            d = far[:, i : i + 1]
            slack = 1e-9 * (1 + d + node.high[i])
            np.maximum(bound, np.maximum(d - node.high[i], node.low[i] - d) - slack, out=bound)
        # each query's likeliest subtree first, then every subtree once for all that need it
        first = far.argmin(axis=1)
        for likely in (True, False):
            for j, child in enumerate(node.below):
                reach = np.sqrt(self.best[rows].astype(np.float64)) * (1 + 1e-9) + 1e-9
                wanted = rows[((first == j) == likely) & (bound[:, j] <= reach)]
                if len(wanted):
                    self._visit(child, wanted)


def cuts(size: int) -> list[slice]:
    """The parts of a vector, equal where its size allows it, else the first ones longer by one."""
    lengths = [size // PARTS + (p < size % PARTS) for p in range(PARTS)]
    ends = np.cumsum(lengths).tolist()
    return [slice(e - n, e) for e, n in zip(ends, lengths, strict=True)]


class Books:
    """The codebooks of all part positions with their trees."""

    def __init__(self, books: list[np.ndarray]):
        self.books = books
        self.searches = [Search(b, build(b, np.arange(len(b)))) for b in books]

    @classmethod
    def of_rows(cls, x: np.ndarray) -> Books:
        return cls([x[:, part] for part in cuts(x.shape[1])])

    def sha256(self) -> str:
        numbers = ",".join(str(int(v)) for book in self.books for v in book.reshape(-1))
        return hashlib.sha256(numbers.encode()).hexdigest()

    def moved(self, totals: list[tuple]) -> Books:
        """With every used entry at the componentwise floor of the mean of its parts,
        from (part, entry, position, total, number) rows."""
        made = [[[int(v) for v in row] for row in book] for book in self.books]
        for part, entry, position, total, n in totals:
            made[part][entry][position] = int(total) // int(n)
        out = []
        for new, book in zip(made, self.books, strict=True):
            x = np.array(new, dtype=object).reshape(book.shape)
            close = x.astype(np.float64)
            out.append(close if exact(close, x.shape[1]) else x)
        return Books(out)


def vectors_of(batch: pa.RecordBatch, column: int, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, batch.num_rows, ROWS):
        rows = batch.slice(at, ROWS)
        values = rows.column(column).flatten().to_numpy(zero_copy_only=False)
        yield rows, whole(values, size) if size else np.zeros((rows.num_rows, 0))


def summed(vectors: DataFrame, books: Books, size: int) -> DataFrame:
    """part, entry, position, total, n: a task sends one sum for each."""
    sent = vectors.sparkSession.sparkContext.broadcast(books)  # ENTRIES vectors

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, total = sent.value, {}
        for batch in batches:
            for _, x in vectors_of(batch, 0, size):
                for p, part in enumerate(cuts(size)):
                    entry, _ = books.searches[p](x[:, part])
                    kind = object if x.dtype == object else np.int64
                    sums = np.zeros((ENTRIES, part.stop - part.start), kind)
                    np.add.at(sums, entry, x[:, part].astype(kind))
                    n = np.bincount(entry, minlength=ENTRIES)
                    before = total.get(p)
                    total[p] = (sums, n) if before is None else (before[0] + sums, before[1] + n)
        for p, (sums, n) in total.items():
            used = np.flatnonzero(n)
            width = sums.shape[1]
            if width:
                numbers = [Decimal(int(v)) for v in sums[used].reshape(-1)]
                columns = [np.full(len(used) * width, p), np.repeat(used, width), np.tile(np.arange(width), len(used))]
                columns = [pa.array(c.astype(np.int32)) for c in columns]
                columns += [pa.array(numbers, pa.decimal128(38, 0)), pa.array(np.repeat(n[used], width).astype(np.int64))]
                yield pa.record_batch(columns, names=["part", "entry", "position", "total", "n"])

    rows = vectors.select("embedding").mapInArrow(assign, "part int, entry int, position int, total decimal(38,0), n bigint")
    return rows.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def trained(vectors: DataFrame, size: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> Books:
    """Codebooks that start as the parts of the least vec_ids and move ``rounds`` times."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").toArrow()
    start = np.concatenate([x for batch in first.to_batches() for _, x in vectors_of(batch, 0, size)])
    books = Books.of_rows(start)
    for _ in range(rounds):
        books = books.moved([tuple(r) for r in summed(vectors, books, size).collect()])  # entries x size numbers
    return books


def coded(vectors: DataFrame, books: Books, size: int) -> DataFrame:
    """vec_id, label, code, error of every vector."""
    kinds = [vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    sent = vectors.sparkSession.sparkContext.broadcast(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        for batch in batches:
            for rows, x in vectors_of(batch, 2, size):
                error, codes = 0, []
                for p, part in enumerate(cuts(size)):
                    entry, near = books.searches[p](x[:, part])
                    error = error + near
                    codes.append(entry)
                code = [bytes(c).hex() for c in np.stack(codes, axis=1).astype(np.uint8)]
                errors = pa.array([int(e) for e in error], pa.int64())
                yield pa.record_batch([rows.column(0), rows.column(1), pa.array(code, pa.string()), errors], names=["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "label", "embedding").mapInArrow(assign, f"vec_id {kinds[0]}, label {kinds[1]}, code string, error bigint")


def codes(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector kept.

    ``vectors`` has ``vec_id``, ``embedding`` and ``label``; other columns are not
    read. Vectors that are null or hold a null or non-finite component are dropped.
    Rows with a null vec_id stay and come last among the first codebook's rows; of
    rows with one vec_id the lesser vector comes first, and each counts. Null labels
    are one label. Vectors of different sizes have codebooks of their own. Fewer
    vectors than entries give fewer entries, none give no rows. An error beyond a
    long ends the job with an overflow.
    """
    if not 0 < entries <= ENTRIES:
        raise ValueError("a code has two hexadecimal digits, so a codebook has 1 to 256 entries")
    spark = vectors.sparkSession
    common.ship(spark)
    vectors = vectors.where(sound(F.col("embedding"))).select("vec_id", "label", "embedding")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    found = []
    sizes = sorted(r[0] for r in vectors.select(F.size("embedding")).distinct().collect())
    for size in sizes:
        same = vectors.where(F.size("embedding") == size)
        books = trained(same, size, entries, rounds)
        found.append(common.stored(coded(same, books, size).withColumn("codebooks_sha256", F.lit(books.sha256())), "codes"))
    if not found:
        return spark.createDataFrame([], f"vec_id {kind}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    totals = out.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    totals = common.stored(totals, "label-errors")  # a plain table, so that a hot label's join can be split
    joined = out.join(totals, out["label"].eqNullSafe(totals["of"]))
    return joined.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return codes(common.table(spark, folder, "embeddings"))


def _sql() -> str:
    """The same in SQL, one pair of steps a round."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
near{r} as materialized (
    select r, part, min({{'d': n + m - 2 * list_dot_product(v, w), 'e': entry}}) as best
    from parts join book{r} using (part) group by r, part
)""")
        if r < ROUNDS:
            steps.append(f"""
mean{r} as (
    select part, entry, position, cast(sum(x) as bigint) as total, count(*) as rows
    from (select n.part, n.best.e as entry, unnest(v) as x, generate_subscripts(v, 1) as position from near{r} n join parts using (r, part))
    group by part, entry, position
), moved{r} as (
    select part, entry, list(cast((total - ((total % rows) + rows) % rows) // rows as double) order by position) as w
    from mean{r} group by part, entry
), book{r + 1} as materialized (
    select part, entry, w, list_dot_product(w, w) as m
    from (select b.part, b.entry, coalesce(k.w, b.w) as w from book{r} b left join moved{r} k on b.part = k.part and b.entry = k.entry)
)""")
    size = "(len(v) // 4)"
    return f"""
with kept as (
    select row_number() over (order by vec_id) as r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), cut as (
    select r, unnest([0, 1, 2, 3]) as part, v from kept
), parts as materialized (
    select r, part, v, list_dot_product(v, v) as n
    from (select r, part, list_slice(v, part * {size} + 1, (part + 1) * {size}) as v from cut)
), book0 as materialized (
    select part, r - 1 as entry, v as w, n as m from parts where r <= {ENTRIES}
),{",".join(steps)}
, digest as (
    select sha256(string_agg(list_aggregate(list_transform(w, lambda x: cast(cast(x as bigint) as varchar)), 'string_agg', ',') , ',' order by part, entry)) as h
    from book{ROUNDS}
), coded as (
    select r, string_agg(lower(lpad(to_hex(best.e), 2, '0')), '' order by part) as code, cast(sum(best.d) as bigint) as error
    from near{ROUNDS} group by r
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, h as codebooks_sha256
from coded join kept using (r), digest
"""


SQL = _sql()
