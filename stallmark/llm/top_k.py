"""Exact top-k inner products over vectors taken by descending length.

Vectors are dealt out by length, longest first, and rotated by the right singular vectors
of a bounded sample, so that few coordinates hold most of each product. A query's k-th best score
among the longest vectors is a floor. Then each task goes through its vectors in blocks, longest
first: a block is left out for a query once length times length is below the query's floor;
otherwise the product of the leading coordinates plus the Cauchy-Schwarz bound of the rest
(product of the residual lengths) decides which pairs get an exact integer product. Every
found score raises the floor.

Queries lie in blocks of about `query_block`, which tasks write to the shared folder with their floors and
memory-map: one pass over the vectors meets all of them, and nothing that is broadcast (the rotation and the
`FLOOR_ROWS` longest vectors) grows with the data.

Defined cases: vectors that are null, or hold null or non-finite components take no part, nor
do rows without an id; shorter vectors, empty ones included, count as padded with zeros; ties go to the smaller vec_id; rows
are told apart by themselves, so each row of a repeated vec_id is a candidate and, where its id is
asked for, a query with ranks of its own, which never meets itself; scores beyond a long are held at
its limits; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import shared_folder, written
from .hash_arrays import Arrays, by_bucket, save

K = 10
SCALE = 1024
QUERY_BLOCK = 4096
SAMPLE_ROWS = 10_000
FLOOR_ROWS = 4096
BLOCK = 1024
#: The leading rotated coordinates hold at least this share of the sample's squared length.
LEADING = 0.6
_LIMIT = np.iinfo(np.int64)


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of whole numbers as double), length: the rows that take part, repeated ones too."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    own = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(~bad)
    # F.floor of a double gives a long; huge values stay whole doubles.
    v = F.transform(x, lambda c: F.when(F.abs(c) < 2.0**40, F.floor(c * scale).cast("double")).otherwise(c * scale))
    own = own.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return own.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list array, padded with zeros to dim."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
    n = len(column)
    out = np.zeros((n, dim))
    if n:
        sizes = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy(zero_copy_only=False)
        out[np.repeat(np.arange(n), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def exact_products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row by row inner products of whole numbers, exact, held within a long."""
    if not len(x):
        return np.zeros(0, np.int64)
    big = np.abs(x).max() * np.abs(q).max() * x.shape[1]
    if big < 2.0**53:
        return np.einsum("ij,ij->i", x, q).astype(np.int64)
    sums = [sum(int(a) * int(b) for a, b in zip(r, s)) for r, s in zip(x, q)]
    return np.array([min(max(s, _LIMIT.min), _LIMIT.max) for s in sums], np.int64)


class Queries:
    """A block of queries with their rotated forms and floors."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, rotation: np.ndarray, lead: int, floors: np.ndarray):
        self.rows, self.vectors, self.rotation, self.lead, self.floors = rows, vectors, rotation, lead, floors
        turned = vectors @ rotation
        self.head = turned[:, :lead]
        self.lengths = np.sqrt((vectors**2).sum(1))
        self.rest = np.sqrt(np.maximum(self.lengths**2 - (self.head**2).sum(1), 0))

    def search(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> dict[int, list[tuple[int, int]]]:
        """For each query (by place) its best k among these rows at least as good as its floor: (-score, vec_id). Raises the floors."""
        lengths = np.sqrt((x**2).sum(1))
        order = np.argsort(-lengths, kind="stable")
        floors = self.floors
        best: dict[int, list[tuple[int, int]]] = {}
        for lo in range(0, len(order), BLOCK):
            at = order[lo : lo + BLOCK]
            slack = 1e-9 * self.lengths * lengths[at[0]] + 1e-6  # of rounding; bounds stay safe
            live = np.flatnonzero(self.lengths * lengths[at[0]] + slack >= floors)
            if not len(live):
                break  # every later block is shorter still
            xb = x[at]
            head = xb @ self.rotation[:, : self.lead]
            rest = np.sqrt(np.maximum(lengths[at] ** 2 - (head**2).sum(1), 0))
            bound = self.head[live] @ head.T + self.rest[live][:, None] * rest[None, :] + slack[live][:, None]
            near = bound >= floors[live][:, None]
            for q in np.flatnonzero(near.any(1)):
                own, place = np.flatnonzero(near[q]), live[q]
                own = own[rows[at[own]] != self.rows[place]]
                score = exact_products(xb[own], np.broadcast_to(self.vectors[place], (len(own), x.shape[1])))
                keep = score >= floors[place]
                if keep.any():
                    top = sorted([*best.get(place, ()), *zip((-score[keep]).tolist(), ids[at[own[keep]]].tolist())])[:k]
                    best[place] = top
                    if len(top) == k:
                        floors[place] = max(floors[place], -top[-1][0])
        return best


def top_k(vectors: DataFrame, every: int = 100, k: int = K, scale: int = SCALE, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for each row whose vec_id is divisible by `every`."""
    spark = vectors.sparkSession
    # Dealt out by length; a number for each row parts rows of one length and tells repeated ones apart.
    q = quantised(vectors, scale).repartitionByRange(F.col("length").desc(), F.xxhash64("vec_id")).withColumn("row", F.monotonically_increasing_id())
    q = written(q, "vectors")
    asked = q.where(F.col("vec_id") % every == 0)
    told = q.agg(F.max(F.size("v")).alias("dim"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("asked")).first()
    dim, blocks = told.dim or 1, max(1, -(-told.asked // query_block))
    sample = _matrix(q.orderBy(F.xxhash64("row")).limit(SAMPLE_ROWS).select("v").toArrow().column("v"), dim)
    rotation = np.linalg.svd(sample.T @ sample)[0]
    energy = ((sample @ rotation) ** 2).sum(0)
    lead = int(min(dim, 1 + np.searchsorted(np.cumsum(energy), LEADING * energy.sum()))) if len(sample) else 1
    longest = q.orderBy(F.col("length").desc(), "vec_id").limit(FLOOR_ROWS).select("row", "vec_id", "v").toArrow()
    first = spark.sparkContext.broadcast((longest.column("row").to_numpy(), longest.column("vec_id").to_numpy(), _matrix(longest.column("v"), dim)))
    folder = shared_folder(spark, "queries")

    def write_block(got: pa.Table) -> pa.Table:
        block, rows, v = got.column("bucket")[0].as_py(), got.column("row").to_numpy(), _matrix(got.column("v"), dim)
        queries = Queries(rows, v, rotation, lead, np.full(len(rows), -np.inf))
        queries.search(*first.value, k)
        save(folder, str(block), row=rows, vec_id=got.column("vec_id").to_numpy(), v=v.ravel(), floor=queries.floors)
        return pa.table([pa.array([block])], names=["n"])

    dealt = asked.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("bucket"), "row", "vec_id", "v")
    stored = Arrays(folder, blocks, [r.n for r in by_bucket(dealt, blocks, write_block, "n long").collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raised: dict[int, np.ndarray] = {}
        for batch in batches:
            rows, ids, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), dim)
            for block in sorted(stored.written):
                own = stored.columns(block)
                queries = Queries(own["row"], own["v"].reshape(-1, dim), rotation, lead, raised.setdefault(block, own["floor"].copy()))
                out = [(int(own["row"][i]), int(own["vec_id"][i]), v, -s) for i, top in queries.search(rows, ids, x, k).items() for s, v in top]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(4)], names=["row", "query_id", "vec_id", "score"])

    found = q.select("row", "vec_id", "v").mapInArrow(run, "row long, query_id long, vec_id long, score long")
    w = W.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH q AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.r AS r, a.vec_id AS query_id, b.vec_id AS vec_id, CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.r <> b.r
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
